"""The registered text queries against SQL, and the pipeline against its parts done plainly."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline
from llm_data import edge_rows, rows
from test_pairs_and_repeats import classes, without_runs
from test_scans import hits

from tarmac.llm.queries import QUERIES
from tarmac.llm.sql import SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    yield con
    con.close()


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = database.execute(SQL[name])
    order = [d[0] for d in result.description]
    assert columns == sorted(order)
    want = [tuple(r[order.index(c)] for c in columns) for r in result.fetchall()]
    assert rows(df, *columns) == sorted(want, key=repr)


def test_names_of_queries():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "line_dedup", "near_duplicates", "decontamination", "packing",
    ]


def test_stages_equal_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    columns = docs.columns
    before = None
    for name, function in corpus_pipeline.STAGES:
        function(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "packing":
            break
        assert docs.columns == columns
        found = sorted((r.doc_id, r.text) for r in docs.collect())
        if name == "line_dedup":
            assert found == sorted((d, t) for d, t, _ in without_runs(before))
        elif name == "near_duplicates":
            keep = {d for d, n, c in classes(before) if d == c}
            assert found == [(d, t) for d, t in before if d in keep]
        elif name == "decontamination":
            keep = {x[0] for x in hits(before, items) if not x[5]}
            assert found == [(d, t) for d, t in before if d in keep]
        before = found
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == {d for d, _ in before}


def test_stages_cope_with_odd_rows(spark, edges, tmp_path):
    docs = edges
    for name, function in corpus_pipeline.STAGES:
        function(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.count() > 0
    nothing = edges.limit(0)
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, nothing, SF_DIR).count() == 0, name
    assert len(edge_rows()) > 0
