import pytest
from base_helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.plans import Dashboard
from tarmac.schemas import CURATED, SchemaError, conform
from tarmac.sources.curated import export_csv, read_curated, register_views, write_curated
from tarmac.sources.datasets import MissingDatasetError, read_datasets, read_frame
from tarmac.sources.staging import replace_folder


@pytest.fixture(scope="module")
def curated(spark, tmp_path_factory):
    import datetime

    data = {
        "fact_flights": [("AI100", "r", "a", 20260420, 60.5, False, True, "ORIGINAL"), ("AI101", None, None, 0, None, True, False, "DERIVED")],
        "fact_bookings": [("B1", "P1", "AI100", "r", "a", 20260420, 'say "hi", ok', "1A", 10.25, 1)],
        "fact_payments": [("Y1", "B1", 10.25, "CARD", "VALID"), ("Y2", "B1", None, "CARD", "MARKED_INVALID")],
        "dim_passengers": [("P1", 30, "F"), ("P2", None, None)],
        "dim_airline": [("Air India", "a")],
        "dim_route": [("DEL", "BOM", "DEL-BOM", "r")],
        "dim_date": [(datetime.date(2026, 4, 20), 20260420, 2026, 4, "April", 20)],
    }
    tables = {n: spark.createDataFrame(data[n], CURATED[n]) for n in CURATED}
    root = str(tmp_path_factory.mktemp("curated"))
    write_curated(tables, root)
    return root, tables


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_round_trip(spark, curated, fmt):
    root, tables = curated
    back = read_curated(spark, root, fmt)
    for name, df in tables.items():
        assert [(f.name, f.dataType) for f in back[name].schema] == [(f.name, f.dataType) for f in CURATED[name]]
        assert rows(back[name]) == rows(df)


def test_missing_table_is_named(spark, curated, tmp_path):
    write_curated({"dim_route": curated[1]["dim_route"]}, str(tmp_path))
    with pytest.raises(MissingDatasetError, match="dim_airline"):
        read_curated(spark, str(tmp_path), "parquet", ["dim_route", "dim_airline"])
    with pytest.raises(MissingDatasetError, match="fact_flights"):
        Dashboard.load(spark, str(tmp_path))


def test_contract_is_checked_on_reading(spark, curated, tmp_path):
    dim = curated[1]["dim_route"]
    dim.drop("route_key").write.parquet(f"{tmp_path}/dim_route.parquet")
    with pytest.raises(SchemaError, match="route_key"):
        read_curated(spark, str(tmp_path), "parquet", ["dim_route"])
    curated[1]["dim_passengers"].withColumn("age", F.col("age").cast("string")).write.parquet(
        f"{tmp_path}/dim_passengers.parquet"
    )
    with pytest.raises(SchemaError, match="age"):
        read_curated(spark, str(tmp_path), "parquet", ["dim_passengers"])


def test_views(spark, curated):
    root, tables = curated
    assert len(register_views(spark, root, prefix="t_")) == 7
    assert rows(spark.table("t_dim_route")) == rows(tables["dim_route"])
    assert spark.table("t_fact_flights").columns == CURATED["fact_flights"].names


def test_views_in_a_namespace(spark, curated, tmp_path):
    root, _ = curated
    spark.sql(f"CREATE DATABASE IF NOT EXISTS air LOCATION '{tmp_path}/air'")
    register_views(spark, root, database="air")
    got = spark.sql(
        "SELECT r.route_name, COUNT(f.flight_id) AS n FROM air.fact_flights f"
        " JOIN air.dim_route r ON f.route_key = r.route_key GROUP BY r.route_name"
    )
    assert rows(got) == [("DEL-BOM", 1)]
    spark.sql("DROP DATABASE air CASCADE")


def test_raw_datasets_from_csv(spark, tmp_path):
    files = {
        "flights": "flight_id,airline,source,destination,departure_time,arrival_time,duration\nAI100,,DEL,BOM,2026-04-20 10:00:00,later,1h\n",
        "bookings": "booking_id,passenger_id,flight_id,booking_date,status,extra\nB1,P1,AI100,2026-04-01,,7\n",
        "passengers": "gender,age,passenger_id,first_name,last_name\nF,thirty,P1,Ann,\n",
        "payments": "payment_id,booking_id,amount,payment_method\nY1,B1,INVALID,CARD\n",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    places = {n: f"{tmp_path}/{n}.csv" for n in files}
    frames = read_datasets(spark, places, "csv")
    assert frames["bookings"].columns[-1] == "extra"
    assert dict(frames["bookings"].dtypes)["booking_date"] == "string"
    assert rows(frames["passengers"]) == [("F", None, "P1", "Ann", None)]
    assert rows(frames["flights"], "airline", "arrival_time") == [(None, "later")]
    (tmp_path / "payments.csv").write_text("payment_id,booking_id\nY1,B1\n")
    with pytest.raises(SchemaError, match=r"payments missing \['amount', 'payment_method'\]"):
        read_datasets(spark, places, "csv")
    with pytest.raises(MissingDatasetError, match="nowhere"):
        read_datasets(spark, {**places, "flights": f"{tmp_path}/nowhere"}, "parquet")


ODD = [(" AI10 ", "x\ny"), ('say "hi"', ""), (None, "a,b"), ("\t", "\r\nend "), ("", None)]


def test_csv_keeps_values_as_they_are(spark, tmp_path):
    path = str(tmp_path / "odd.csv")
    export_csv(spark.createDataFrame(ODD, "a string, b string"), path)
    assert rows(read_frame(spark, path, "csv")) == sorted(ODD, key=repr)


def test_malformed_csv_rows_do_not_pass_unseen(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n3\n4,5,6\n")
    path = str(tmp_path / "bad.csv")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_frame(spark, path, "csv").collect()
    marked = read_frame(spark, path, "csv", malformed="mark")
    assert [r.malformed_row for r in marked.orderBy("a").collect()] == [None, "3", "4,5,6"]
    with pytest.raises(ValueError):
        read_frame(spark, path, "csv", malformed="ignore")


def test_numbers_with_a_fraction_are_no_whole_numbers(spark):
    df = spark.createDataFrame([("30.7",), ("30.0",), ("31",), ("x",), ("9999999999",)], "age string")
    found = conform(df, T.StructType([T.StructField("age", T.IntegerType())]))
    assert [r.age for r in found.collect()] == [None, 30, 31, None, None]


def test_a_folder_is_replaced_whole(spark, tmp_path):
    for name, k in (("new", 2), ("old", 1)):
        spark.range(k).write.parquet(str(tmp_path / name))
    replace_folder(spark, str(tmp_path / "new"), str(tmp_path / "old"))
    assert spark.read.parquet(str(tmp_path / "old")).count() == 2
    assert not (tmp_path / "new").exists()
    replace_folder(spark, str(tmp_path / "old"), str(tmp_path / "deep" / "first"))
    assert spark.read.parquet(str(tmp_path / "deep" / "first")).count() == 2


def test_exported_csv_files_are_bounded(spark, tmp_path, monkeypatch):
    """A file is read by one task, as its values may hold line breaks."""
    monkeypatch.setattr("tarmac.sources.curated.CSV_FILE_ROWS", 10, raising=False)
    df = spark.range(95).selectExpr("concat('a', id, chr(10), 'b') as k", "id % 2 as half").coalesce(1)
    export_csv(df, f"{tmp_path}/whole")
    files = list((tmp_path / "whole").glob("part-*"))
    assert len(files) == 10 and all(f.read_text().startswith("k,half\n") for f in files)
    assert rows(read_frame(spark, f"{tmp_path}/whole", "csv")) == rows(df.select("k", df.half.cast("string")))
    export_csv(df, f"{tmp_path}/halves", ["half"])
    assert [len(list(h.glob("part-*"))) for h in (tmp_path / "halves").glob("half=*")] == [5, 5]
    assert read_frame(spark, f"{tmp_path}/halves", "csv").count() == 95
