"""The airline plan on hand-made rows: every rule, the cascade, and row accounting."""

import hashlib
import json
from types import SimpleNamespace

import pytest
from base_helpers import rows
from pyspark.sql import functions as F

from tarmac.__main__ import main
from tarmac.operators.reconcile import ReconciliationError, assert_reconciled, reconcile
from tarmac.plans import Airline, run
from tarmac.rules import AirlineRules
from tarmac.schemas import CURATED, RAW, SchemaError
from tarmac.sources.staging import StagedTables, clear_scratch, scratch, shared_folder

FLIGHTS = "flight_id string, airline string, source string, destination string, departure_time string, arrival_time string, duration string"


def flight(fid, airline="Air India", src="DEL", dst="BOM", dep="2026-04-20 10:00:00", arr="2026-04-20 11:00:00"):
    return (fid, airline, src, dst, dep, arr, "x")


def raw(spark):
    flights = [
        flight("AI100"), flight("AI100"),                       # exact duplicate
        flight(" AI101 ", airline=None), flight("AI101", airline=None),  # equal once trimmed
        flight("6F250"), flight("6F250", dst="CCU"),            # conflict
        flight("6F251", airline="UNKNOWN"),                     # derived
        flight("ZZ100", airline=None),                          # nothing to derive from
        flight("ZZ101", airline="UNKNOWN"),
        flight("UK200", airline="Vistara", dep="2026-04-20 22:00:00", arr="2026-04-20 01:30:00"),
        flight("UK201", airline="Vistara", dep="2026-04-20 10:00:00", arr="2026-04-20 06:00:00"),
        flight("SJ300", airline="SpiceJet", dep="soon"),
        flight("SJ301", airline="SpiceJet", dst=None),
        flight("bad-1"), flight(None), flight("  "),
    ]
    bookings = [
        ("B1", "P1", "AI100", "2026-04-01", "CONFIRMED", "1A", "N1", "kin", "1"),
        ("B1", "P1", "AI100", "2026-04-01", "CONFIRMED", "1A", "N1", "kin", "1"),  # exact duplicate
        ("B2", "P1", "AI101", "2026-04-02", None, "1B", None, "kin", "1"),
        ("B3", "P1", "6F250", "2026-04-03", "CONFIRMED", "1C", "N3", "kin", "1"),  # flight conflicts
        ("B4", "P9", "AI100", "2026-04-04", "INVALID", "1D", "N4", "kin", "1"),    # no such passenger
        ("B5", "P3", "AI100", "2026-04-05", "CONFIRMED", "1E", "N5", "kin", "1"),  # passenger conflicts
        ("B6", "P2", "UK200", None, "CONFIRMED", "1F", "N6", "kin", "1"),          # no date
        ("B7", "P2", "AI100", "2026-04-06", "CONFIRMED", "2A", "N7", "kin", "1"),
        ("B7", "P2", "XX999", "2026-04-06", "CONFIRMED", "2A", "N7", "kin", "1"),  # drags the other B7 along
        ("B8", None, "AI100", "2026-04-07", "CONFIRMED", "2B", "N8", "kin", "1"),
    ]
    passengers = [
        ("P1", "Ann", None, 30, "F", "A1", "ann@x.com", "d"),
        ("P2", "Bob", "B", 40, "M", "A2", "bob@x.com", "d"),
        ("P2", "Bob", "B", 40, "M", "A2", "alt@x.com", "d"),    # agrees analytically
        ("P2", "Bob", "B", 40, "M", "A2", "alt@x.com", "d"),    # exact duplicate
        ("P3", "Cid", "C", 50, "M", "A3", "cid@x.com", "d"),
        ("P3", "Cid", "C", 51, "M", "A3", None, "d"),           # conflicting age
    ]
    payments = [
        ("Y1", "B1", "100.10", "CARD"),
        ("Y2", "B1", "50", "CARD"),
        ("Y2", "B1", "50", "CARD"),        # exact duplicate
        ("Y3", "B1", "INVALID", "CARD"),
        ("Y4", "B2", None, "CASH"),
        ("Y5", "B3", "10", "CASH"),        # booking is an orphan
        ("Y6", "B99", "10", "CASH"),       # no booking
        ("Y7", "B7", "10", "CASH"),
        ("Y8", None, "10", "CASH"),
        ("Y1", "B99", "5", "CARD"),        # shares its id with a good row
    ]
    text = {
        "bookings": ", ".join(f"{c} string" for c in RAW["bookings"].names),
        "passengers": RAW["passengers"],
        "payments": RAW["payments"],
    }
    frames = {
        "flights": spark.createDataFrame(flights, FLIGHTS),
        "bookings": spark.createDataFrame(bookings, text["bookings"]),
        "passengers": spark.createDataFrame(passengers, text["passengers"]),
        "payments": spark.createDataFrame(payments, text["payments"]),
    }
    frames["bookings"] = frames["bookings"].withColumn(
        "booking_date", F.col("booking_date").cast("timestamp_ntz")
    )
    return frames


@pytest.fixture(scope="module")
def plan(spark):
    built = Airline(spark, raw(spark), run_ts="2026-05-01T00:00:00")
    built.tables()
    return built


def test_fact_flights(plan):
    fact = plan.table("fact_flights")
    assert fact.schema.names == CURATED["fact_flights"].names
    assert [f.dataType for f in fact.schema] == [f.dataType for f in CURATED["fact_flights"]]
    got = {r.flight_id: r for r in fact.collect()}
    assert sorted(got) == ["6F251", "AI100", "AI101", "SJ300", "SJ301", "UK200", "UK201", "ZZ100", "ZZ101"]
    assert got["AI101"].airline_source == got["6F251"].airline_source == "DERIVED"
    assert got["ZZ100"].airline_key is None and got["ZZ101"].airline_source == "ORIGINAL"
    assert (got["UK200"].calculated_duration_mins, got["UK200"].is_overnight) == (210.0, True)
    assert (got["UK201"].calculated_duration_mins, got["UK201"].is_overnight) == (None, True)
    assert (got["SJ300"].date_key, got["SJ300"].is_overnight) == (0, False)
    assert got["SJ301"].route_key is None and got["SJ301"].is_statistical_outlier is False
    assert got["UK200"].is_statistical_outlier and not got["AI100"].is_statistical_outlier


def test_fact_bookings(plan):
    fact = plan.table("fact_bookings")
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in CURATED["fact_bookings"]]
    assert rows(fact, "booking_id", "status", "date_key", "total_paid_amount", "payment_count") == [
        ("B1", "CONFIRMED", 20260401, 150.1, 2),
        ("B2", "UNKNOWN", 20260402, 0.0, 0),
        ("B6", "CONFIRMED", 0, 0.0, 0),
    ]
    assert fact.where("route_key is null or airline_key is null").count() == 0


def test_orphans_take_their_booking_id_and_payments_along(plan):
    assert rows(plan.orphan_bookings(), "booking_id", "flight_id") == [
        ("B3", "6F250"), ("B4", "AI100"), ("B5", "AI100"), ("B7", "AI100"), ("B7", "XX999"), ("B8", "AI100"),
    ]
    assert rows(plan.orphan_payments(), "payment_id", "booking_id") == [
        ("Y1", "B99"), ("Y5", "B3"), ("Y6", "B99"), ("Y7", "B7"), ("Y8", None),
    ]
    assert rows(plan.table("fact_payments"), "payment_id", "amount_parsed", "amount_status") == [
        ("Y1", 100.1, "VALID"), ("Y2", 50.0, "VALID"), ("Y3", None, "MARKED_INVALID"),
    ]


def test_dimensions(plan):
    assert rows(plan.table("dim_passengers")) == [("P1", 30, "F"), ("P2", 40, "M")]
    assert rows(plan.table("dim_airline"), "airline") == [
        ("Air India",), ("IndiGo",), ("SpiceJet",), ("UNKNOWN",), ("Vistara",),
    ]
    assert rows(plan.table("dim_route"), "route_name", "route_key") == [
        ("DEL-BOM", hashlib.md5(b"DEL-BOM").hexdigest())
    ]
    assert rows(plan.table("dim_date"), "date_key", "year", "month", "month_name", "day") == [
        (20260401, 2026, 4, "April", 1), (20260402, 2026, 4, "April", 2), (20260420, 2026, 4, "April", 20),
    ]


def test_every_fact_key_has_a_member(plan):
    for fact in ("fact_flights", "fact_bookings"):
        keyed = plan.table(fact)
        for key, dim in (("route_key", "dim_route"), ("airline_key", "dim_airline")):
            lost = keyed.where(F.col(key).isNotNull()).join(plan.table(dim), key, "left_anti")
            assert lost.count() == 0
        assert keyed.where("date_key > 0").join(plan.table("dim_date"), "date_key", "left_anti").count() == 0


def test_rows_are_accounted_for(plan):
    assert rows(plan.reconciliation()) == [
        ("bookings", 10, 1, 6, 3, "PASS"),
        ("flights", 16, 2, 5, 9, "PASS"),
        ("passengers", 6, 3, 1, 2, "PASS"),
        ("payments", 10, 1, 6, 3, "PASS"),
    ]
    assert plan.payment_reconciliation().collect()[0].asDict() == {
        "raw_rows": 10, "removed_rows": 1, "null_amount_rows": 1, "source_invalid_rows": 1,
        "downstream_excluded_rows": 5, "final_rows": 3, "final_marked_invalid_rows": 1, "status": "PASS",
    }
    assert plan.airline_reconciliation().collect()[0].asDict() == {
        "source_missing_rows": 5, "derived_rows": 2, "lost_before_derivation": 1,
        "final_null_key_rows": 1, "final_literal_unknown_rows": 1,
    }


def test_a_lost_row_raises(plan):
    counted = {"raw_rows": plan.raw["flights"].count(), "final_rows": plan.table("fact_flights").count()}
    recon = reconcile(plan.spark, {"flights": counted})
    with pytest.raises(ReconciliationError, match="flights"):
        assert_reconciled(recon, "flights")
    assert_reconciled(recon, "payments")


def test_audit(plan):
    audit = plan.audit()
    got = sorted((r.dataset, r.rule_id, r.record_id, r.severity, r.action) for r in audit.collect())
    assert got == sorted([
        ("bookings", "B-01", "B2", "Medium", "STANDARDIZE"),
        ("bookings", "B-DUP", "Multiple", "Medium", "REMOVE"),
        *[("bookings", "REF-01/02", b, "High", "QUARANTINE") for b in ("B3", "B4", "B5", "B7", "B8")],
        *[("flights", "F-00", i, "High", "QUARANTINE") for i in ("bad-1", "nan", "  ")],
        ("flights", "F-01", "Multiple", "Medium", "REMOVE"),
        *[("flights", "F-02", "6F250", "Critical", "QUARANTINE")] * 2,
        *[("flights", "F-03", i, "Medium", "CORRECT") for i in ("AI101", "6F251")],
        ("flights", "F-04", "UK200", "Low", "CORRECT"),
        ("flights", "F-04", "UK201", "High", "FLAG"),
        ("passengers", "P-DUP", "Multiple", "Medium", "REMOVE"),
        ("passengers", "P-01", "P2", "Low", "REMOVE (Keep First)"),
        ("passengers", "P-01", "P3", "High", "QUARANTINE"),
        ("payments", "PAY-DUP", "Multiple", "Medium", "REMOVE"),
        ("payments", "PAY-01", "Y4", "High", "QUARANTINE"),
        ("payments", "PAY-02", "Y3", "Medium", "FLAG (MARKED_INVALID)"),
        *[("payments", "REF-03", i, "High", "QUARANTINE") for i in ("Y1", "Y5", "Y6", "Y7", "Y8")],
    ])
    assert audit.select("processed_timestamp").distinct().collect()[0][0] == "2026-05-01T00:00:00"
    derived = audit.where("rule_id = 'F-03' and record_id = '6F251'").collect()[0]
    assert derived.issue == "Derived airline from 6F"


def test_protection(plan):
    people = {r.passenger_id: r for r in plan.protected_passengers().collect()}
    assert sorted(people) == ["P1", "P2"]
    assert people["P1"].last_name == "Not Provided" and people["P1"].email == "a****@x.com"
    assert people["P1"].aadhaar_id == hashlib.sha256(b"A1").hexdigest()
    assert "date_of_birth" not in plan.protected_passengers().columns
    bookings = {r.booking_id: r for r in plan.protected_bookings().collect()}
    assert bookings["B1"].passport_number == hashlib.sha256(b"N1").hexdigest()
    assert bookings["B2"].passport_number is None
    assert not {"emergency_contact_name", "emergency_contact_phone"} & set(plan.protected_bookings().columns)


def test_quarantine_is_protected_and_complete(plan):
    quarantine = plan.quarantine()
    counts = {
        name: dict(df.groupBy("rule_id").count().collect()) for name, df in quarantine.items()
    }
    assert counts == {
        "flights": {"F-00": 3, "F-02": 2},
        "passengers": {"P-01": 2},
        "bookings": {"REF-01/02": 6},
        "payments": {"PAY-01": 1, "REF-03": 5},
    }
    text = repr([df.collect() for df in quarantine.values()])
    for secret in ("A3'", "cid@", "N3", "'kin'"):
        assert secret not in text


def test_conflicting_booking_and_payment_ids_can_be_quarantined(spark):
    plan = Airline(spark, raw(spark), AirlineRules(quarantine_conflicting_keys=True))
    assert rows(plan.table("fact_bookings"), "booking_id") == [("B1",), ("B2",), ("B6",)]
    assert rows(plan.table("fact_payments"), "payment_id") == [("Y2",), ("Y3",)]
    assert {r.status for r in plan.reconciliation().collect()} == {"PASS"}
    rules = {(r.rule_id, r.record_id) for r in plan.audit().collect()}
    assert {("B-02", "B7"), ("PAY-03", "Y1")} <= rules
    assert rows(plan.quarantine()["payments"].where("rule_id = 'PAY-03'"), "booking_id") == [("B1",), ("B99",)]


def test_optional_columns_may_be_missing(spark):
    frames = raw(spark)
    frames["bookings"] = frames["bookings"].drop("seat_number", "passport_number", "emergency_contact_name")
    frames["passengers"] = frames["passengers"].drop("aadhaar_id", "email", "date_of_birth")
    plan = Airline(spark, frames)
    assert rows(plan.table("fact_bookings"), "booking_id", "seat_number") == [("B1", None), ("B2", None), ("B6", None)]
    assert plan.protected_passengers().columns == ["passenger_id", "first_name", "last_name", "age", "gender"]


def test_columns_of_the_plan_are_reserved(spark):
    frames = raw(spark)
    frames["payments"] = frames["payments"].withColumn("copies", F.lit(1))
    with pytest.raises(SchemaError, match="payments uses reserved names"):
        Airline(spark, frames)


def test_empty_inputs(spark):
    frames = {n: spark.createDataFrame([], s) for n, s in RAW.items()}
    plan = Airline(spark, frames)
    assert all(df.isEmpty() for df in plan.tables().values())
    assert rows(plan.reconciliation()) == [
        (n, 0, 0, 0, 0, "PASS") for n in ("bookings", "flights", "passengers", "payments")
    ]
    assert plan.audit().isEmpty()


def test_run_writes_everything(spark, tmp_path):
    out = str(tmp_path / "out")
    run(spark, raw(spark), out, "2026-05-01T00:00:00")
    curated = tmp_path / "out" / "curated"
    assert {p.name for p in curated.iterdir()} == {f"{n}.{e}" for n in CURATED for e in ("parquet", "csv")}
    quarantine = spark.read.option("mergeSchema", True).parquet(f"{out}/quarantine")
    assert dict(quarantine.groupBy("dataset").count().collect()) == {
        "flights": 5, "passengers": 2, "bookings": 6, "payments": 6,
    }
    audit = spark.read.option("header", True).csv(f"{out}/audit")
    assert audit.where("dataset = 'flights' and rule_id = 'F-02'").count() == 2
    stored = b"".join(p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file() and p.suffix == ".csv")
    for secret in (b"ann@", b",kin,", b"N1,"):
        assert secret not in stored


def test_quarantine_lets_no_unknown_or_clear_column_out(spark):
    frames = raw(spark)
    frames["passengers"] = frames["passengers"].withColumns(
        {"phone": F.lit("0123456789"), "home_address": F.lit("1 Long Street")}
    )
    rejected = Airline(spark, frames).quarantine()["passengers"]
    assert "home_address" not in rejected.columns
    found = [r.asDict() for r in rejected.collect()]
    assert len(found) == 2 and {r["phone"] for r in found} == {"012345****"}
    clear = {"Cid", "C", "A3", "cid@x.com", "1 Long Street", "0123456789"}
    assert not clear & {v for r in found for v in r.values()}


def test_a_payment_lost_before_deduplication_fails_the_reconciliation(spark, monkeypatch):
    plan = Airline(spark, raw(spark))
    whole = plan._distinct

    def losing(dataset, key):
        df = whole(dataset, key)
        return df.where("payment_id <> 'Y2'") if dataset == "payments" else df

    monkeypatch.setattr(plan, "_distinct", losing)
    assert plan.payment_reconciliation().first().status == "FAIL"
    with pytest.raises(ReconciliationError):
        assert_reconciled(plan.reconciliation())


def test_a_failing_run_publishes_nothing(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    run(spark, raw(spark), out, "t1").close()
    before = spark.read.parquet(f"{out}/curated/fact_payments.parquet").count()
    whole = Airline._distinct

    def losing(self, dataset, key):
        df = whole(self, dataset, key)
        return df.where("payment_id <> 'Y2'") if dataset == "payments" else df

    monkeypatch.setattr(Airline, "_distinct", losing)
    with pytest.raises(ReconciliationError):
        run(spark, raw(spark), out, "t2")
    assert spark.read.parquet(f"{out}/curated/fact_payments.parquet").count() == before


def test_text_times_in_other_formats(spark):
    frames = raw(spark)
    frames["bookings"] = frames["bookings"].withColumn(
        "booking_date", F.date_format("booking_date", "dd/MM/yyyy HH:mm")
    )
    plan = Airline(spark, frames, AirlineRules(timestamp_formats=("dd/MM/yyyy HH:mm",)))
    keys = {r.booking_id: r.date_key for r in plan.table("fact_bookings").collect()}
    assert keys["B1"] == 20260401


def test_staged_tables_are_built_once_and_again_if_lost(spark, tmp_path):
    stage = StagedTables(spark, str(tmp_path / "a"))
    builds = []

    def build():
        builds.append(1)
        return spark.range(3)

    assert stage.table("t", build).count() == stage.table("t", build).count() == 3
    assert len(builds) == 1
    (tmp_path / "a" / "t").rename(tmp_path / "gone")
    assert stage.table("t", build).count() == 3
    assert len(builds) == 2


def test_figures_are_observed_while_a_table_is_written(spark, tmp_path):
    stage = StagedTables(spark, str(tmp_path / "a"))

    def inner():
        return stage.watched(spark.range(5), "inner", rows=F.count(F.lit(1)))

    def outer():
        below = stage.table("inner", inner)
        kept = stage.watched(spark.range(100).unionAll(below), "read", rows=F.count(F.lit(1)))
        few = kept.where("id < 10").withColumn("part", F.col("id") % 3)
        return stage.watched(few, "outer", most=F.max("id"), none=F.sum(F.lit(None).cast("int")))

    stage.table("outer", outer, ["part"])
    assert stage.tallies == {"inner": {"rows": 5}, "read": {"rows": 105}, "outer": {"most": 9, "none": 0}}
    assert json.loads((tmp_path / "a" / "tallies" / "read.json").read_text()) == {"rows": 105}
    assert len(list((tmp_path / "a" / "outer").glob("part=*"))) == 3
    with pytest.raises(RuntimeError, match="only while a table is built"):
        stage.watched(spark.range(1), "outside", rows=F.count(F.lit(1)))


def test_scratch_is_deleted_when_cleared(spark):
    kept = scratch(spark.range(3))
    assert kept.count() == 3
    clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST"):
        kept.collect()


MARKED = {"flights": 2, "passengers": 1, "payments": 0}


def with_malformed_rows(spark):
    """Raw rows as a marking reader gives them: some are only text."""
    frames = raw(spark)
    for name, count in MARKED.items():
        df = frames[name].withColumn("malformed_row", F.lit(None).cast("string"))
        broken = spark.range(count).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in frames[name].schema],
            F.format_string("broken,%s,cid@x.com", F.col("id")).alias("malformed_row"),
        )
        frames[name] = df.unionAll(broken)
    return frames


def test_malformed_rows_are_quarantined_audited_and_counted(spark, plan):
    marked = Airline(spark, with_malformed_rows(spark), run_ts="2026-05-01T00:00:00")
    for name, df in plan.tables().items():
        assert rows(marked.table(name)) == rows(df)
    before = {r.dataset: r for r in plan.reconciliation().collect()}
    for r in marked.reconciliation().collect():
        more = MARKED.get(r.dataset, 0)
        assert (r.raw_rows, r.quarantined_rows, r.status) == (
            before[r.dataset].raw_rows + more, before[r.dataset].quarantined_rows + more, "PASS",
        )
    ids = {i: hashlib.sha256(f"broken,{i},cid@x.com".encode()).hexdigest() for i in range(2)}
    events = marked.audit().where("rule_id = 'S-01'")
    assert rows(events, "dataset", "record_id", "action") == sorted(
        [("flights", ids[0], "QUARANTINE"), ("flights", ids[1], "QUARANTINE"), ("passengers", ids[0], "QUARANTINE")]
    )
    rejected = marked.quarantine()
    assert rows(rejected["flights"].where("rule_id = 'S-01'"), "record_id", "malformed_row") == sorted(
        (ids[i], f"broken,{i},cid@x.com") for i in range(2)
    )
    # The text of a passenger is personal: only its hash is kept.
    assert rows(rejected["passengers"].where("rule_id = 'S-01'"), "record_id", "malformed_row") == [(ids[0], None)]
    assert "malformed_row" not in rejected["bookings"].columns
    assert marked.payment_reconciliation().first().status == "PASS"


def test_shared_folder_comes_from_the_session():
    def session(master, folder=None):
        known = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "hdfs://warehouse/"}
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: known[key] or default),
            sparkContext=SimpleNamespace(master=master),
        )

    for master in ("yarn", "local[2]"):
        assert shared_folder(session(master, "hdfs://shared/work/")) == "hdfs://shared/work"
        assert shared_folder(session(master)) == "hdfs://warehouse/staging"


def test_command_line(spark, tmp_path, capsys):
    for name, df in raw(spark).items():
        df.write.parquet(f"{tmp_path}/raw/{name}.parquet")
    main(["--raw", f"{tmp_path}/raw", "--out", f"{tmp_path}/out"])
    printed = capsys.readouterr().out
    assert "|flights   |16      |2           |5               |9         |PASS  |" in printed
    assert "DEL-BOM" in printed and "IndiGo" in printed
    assert spark.read.parquet(f"{tmp_path}/out/curated/fact_bookings.parquet").count() == 3
