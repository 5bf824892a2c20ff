"""The shape of the physical plans: what is read, shuffled, broadcast and generated."""

import re
import tempfile

import pytest
from base_helpers import final_plan
from pyspark.sql import functions as F

from contract.inputs import FLIGHT_IDS, raw_tables
from contract.queries import all_queries, plan
from tarmac.operators import explore as D
from tarmac.operators import kpi as K
from tarmac.operators.quantiles import frequencies, iqr_upper_bounds
from tarmac.plans import Dashboard, run
from tarmac.rules import AirlineRules
from tarmac.sources import curated
from tarmac.sources.curated import on_days, read_curated, write_curated
from tarmac.sources.staging import StagedTables

SF_DIR = "/root/testdata/sf0.001"


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def airline(spark):
    return plan(spark, SF_DIR)


@pytest.fixture(scope="module")
def dash(airline):
    return Dashboard.of(airline.tables())


@pytest.mark.parametrize("name", all_queries())
def test_no_python_and_no_cross_product(spark, name):
    text = executed(all_queries()[name](spark, SF_DIR))
    assert not re.search(r"Python|Pandas|Cartesian|NestedLoop", text)


def test_dimensions_are_broadcast_because_they_are_small(spark, airline, dash, conf):
    assert executed(dash.flights).count("BroadcastHashJoin") == 2
    conf("spark.sql.autoBroadcastJoinThreshold", "10")
    assert "BroadcastHashJoin" not in executed(Dashboard.of(airline.tables()).flights)


def test_filters_and_columns_reach_the_scan(dash):
    chosen = dash.select(D.CrossFilter(overnight_only=True)).flights
    text = executed(chosen.groupBy("airline").agg(F.count("flight_id")))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "is_overnight" in line)
    assert "EqualTo(is_overnight,true)" in scan
    assert re.search(r"ReadSchema: struct<flight_id:string,route_key:string,airline_key:string,is_overnight:boolean>", scan)


def test_facts_are_aggregated_before_the_join(airline):
    text = executed(K.route_traffic(airline.table("dim_route"), airline.table("fact_flights"), airline.table("fact_bookings")))
    assert "ReadSchema: struct<booking_id:string,route_key:string>" in text
    assert "ReadSchema: struct<flight_id:string,route_key:string>" in text
    # Below the join: partial counts of each fact, so one row per route is joined.
    join = text.index("Join")
    assert text.index("partial_count") > join


def test_keys_are_resolved_by_hash_aggregation(airline):
    for resolved in (airline._resolve_flights(), airline._compare_passengers()):
        text = final_plan(resolved)
        assert "SortAggregate" not in text and "HashAggregate" in text
        # Only the numbers per key are shuffled; the rows of keys with several variants are few.
        assert "partial_count" in text


def test_distinct_rows_stay_where_they_are_to_be_resolved(airline):
    for build in (airline._resolve_flights_watched, airline._resolve_passengers):
        text = executed(_building(airline, build))
        # The keys of several rows, counted once and stored, are few; only their rows are moved.
        assert "several_" in text and "partial_count" not in text and "SortMergeJoin" not in text
        assert text.count("Exchange hashpartitioning") == text.count("Window [") == 1


def test_raw_rows_are_shuffled_once(airline):
    text = executed(_building(airline, airline._flight_variants))
    assert text.count("Exchange") == 1 and "partial_count" in text and "SortAggregate" not in text


def _building(airline, build):
    """The frame of a build, taken while a table is built, as builds may watch theirs."""
    found = []

    def keep():
        found.append(build())
        return found[0]

    airline.stage.table(f"test/{build.__name__}", keep)
    return found[0]


def test_each_raw_dataset_is_read_twice_in_a_run(spark, monkeypatch):
    """Once to be processed and once to be counted."""
    raw = {}
    root = tempfile.mkdtemp()  # a short path, as plans cut long ones
    for name, df in raw_tables(spark, SF_DIR).items():
        df.write.parquet(f"{root}/raw_{name}.parquet")
        raw[name] = spark.read.parquet(f"{root}/raw_{name}.parquet")
    texts = []
    whole = StagedTables.table

    def recorded(self, name, build, partition_by=()):
        def kept():
            df = build()
            texts.append(executed(df))
            return df

        return whole(self, name, kept, partition_by)

    monkeypatch.setattr(StagedTables, "table", recorded)
    written, write = [], curated.write_parquet

    def also_recorded(df, path, partition_by=()):
        written.append(executed(df))
        write(df, path, partition_by)

    monkeypatch.setattr(curated, "write_parquet", also_recorded)
    finished = run(spark, raw, f"{root}/out", "t", AirlineRules(flight_id_pattern=FLIGHT_IDS))
    counted = set(finished._counted)
    assert counted == {"passengers", "bookings", "payments"}
    for name in raw:
        reads = sum(t.count(f"raw_{name}.parquet]") for t in texts + written)
        assert reads + (name in counted) == 2, name


def test_accounting_reads_no_table(airline):
    for report in (airline.reconciliation(), airline.payment_reconciliation(), airline.airline_reconciliation()):
        assert "FileScan" not in executed(report)


def test_the_audit_reads_each_table_once(airline):
    airline.audit()
    audit = _building(airline, airline._audit)
    folders = {file.rsplit("/", 1)[0] for file in audit.inputFiles()}
    assert executed(audit).count("FileScan") == len(folders) == 8


def test_selections_need_no_join(airline):
    kept = Dashboard.of(airline.tables(), airline.stage)
    chosen = kept.select(D.CrossFilter(airlines=("IndiGo",), sources=("DEL",), overnight_only=True))
    for df in (chosen.flights, chosen.bookings, chosen.payments, chosen.explore("payments")):
        text = executed(df)
        assert "Join" not in text and "Exchange" not in text
    assert "Join" not in executed(D.kpi_cards(chosen.flights, chosen.bookings, chosen.payments))
    assert "EqualTo(airline,IndiGo)" in executed(chosen.flights)


def test_days_prune_months(spark, airline, tmp_path):
    write_curated(airline.tables(), str(tmp_path))
    tables = read_curated(spark, str(tmp_path), months=True)
    days = tables["dim_date"].where("year = 1995 and month = 3")
    for fact in ("fact_flights", "fact_bookings"):
        text = final_plan(on_days(tables[fact], days).agg(F.count("date_key")))
        assert re.search(r"PartitionFilters: \[.*dynamicpruning", text)
    flights = on_days(tables["fact_flights"], days)
    whole = airline.table("fact_flights").where("date_key between 19950301 and 19950331")
    assert 0 < flights.count() == whole.count()
    parts = [p.name for p in (tmp_path / "fact_flights.parquet").iterdir() if p.name.startswith("date_month")]
    assert "date_month=199503" in parts and len(parts) > 50
    # Without the folders' column days are found as well.
    assert on_days(tables["fact_flights"].drop("date_month"), days).count() == flights.count()


def test_tagged_rows_stay_in_generated_code(spark, airline):
    text = final_plan(airline._resolve_flights().select("flight_id", "dq"))
    tagging = next(line for line in text.splitlines() if "F-03" in line)
    assert re.search(r"\*\(\d+\) Project", tagging)


def test_a_hot_route_is_reduced_before_it_is_shuffled(spark):
    """What is dealt to ranges are counted values, never the rows of a group."""
    df = spark.range(0, 100000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('r', id % 40)) AS route", "cast(id % 300 AS double) AS minutes"
    )
    text = executed(frequencies(df, ["route"], "minutes"))
    assert text.index("Exchange hashpartitioning(route") < text.index("partial_count")
    bounds = final_plan(iqr_upper_bounds(df, ["route"], "minutes"))
    assert "scratch" in bounds and "partial_count" not in bounds


def test_hot_flight_is_split_in_the_booking_check(spark, airline, conf):
    """Bookings of one flight that dwarf all others are divided among tasks."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    from tarmac.operators.references import match_parent

    flights = airline.table("fact_flights")
    popular = flights.agg(F.min("flight_id")).first()[0]
    bookings = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, popular).otherwise(F.concat(F.lit("X"), F.col("id"))).alias("flight_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    matched = match_parent(bookings, flights, "flight_id", "found", ["route_key"])
    counted = matched.groupBy("found").agg(F.count("payload").alias("n"))
    assert "skew=true" in final_plan(counted)
    assert {r.found: r.n for r in counted.collect()} == {True: 20000, False: 40000}


def test_box_and_histogram_come_from_one_count_of_the_fact(airline):
    kept = Dashboard.of(airline.tables(), airline.stage)
    kept.duration_box(), kept.duration_histogram()
    for df in (kept.duration_box(), kept.duration_histogram()):
        assert df.inputFiles() and all("/serving/duration" in file for file in df.inputFiles())
    text = executed(Dashboard.of(airline.tables()).durations())
    assert len(re.findall(r"FileScan parquet \[[^\]]*calculated_duration_mins", text)) == 1
