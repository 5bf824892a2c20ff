"""Inputs with a known number of each defect; every reported count must follow from them."""

from datetime import datetime, timedelta
from itertools import permutations

import pytest
from base_helpers import rows
from pyspark.sql import functions as F

from tarmac.operators import audit as A
from tarmac.operators import kpi as K
from tarmac.operators import reconcile as C
from tarmac.plans import Airline
from tarmac.schemas import RAW

ROUTES = list(permutations(["BLR", "BOM", "CCU", "DEL", "HYD", "MAA"], 2))
AIRLINES = [("6F", "IndiGo", 271), ("AI", "Air India", 255), ("SJ", "SpiceJet", 239), ("UK", "Vistara", 238)]
START = datetime(2026, 4, 17, 6)


def flights():
    """1003 flights, 67 of them without airline, one over night; 15 copies and one conflicting pair."""
    good = []
    for prefix, airline, count in AIRLINES:
        for i in range(count):
            n = len(good)
            source, destination = ROUTES[n % len(ROUTES)]
            dep = START + timedelta(minutes=n % 600)
            arr = dep + timedelta(minutes=90 + n % 7)
            name = (None if n % 2 else "UNKNOWN") if n < 67 else airline
            good.append((f"{prefix}{1000 + i}", name, source, destination, dep, arr, "x"))
    fid, name, source, destination, _, _, text = good[900]
    good[900] = (fid, name, source, destination, datetime(2026, 4, 17, 23), datetime(2026, 4, 17, 0, 30), text)
    copies = good[:5] + good[500:510]
    pair = [("6F250", "IndiGo", "DEL", d, START, START + timedelta(hours=1), "x") for d in ("BOM", "CCU")]
    return good + copies + pair


def passengers():
    """1000 passengers; 36 of them 39 times again with other personal data."""
    people = [
        (f"P{1000 + i}", "n", None if i % 9 == 0 else "l", 1 + i % 89, "F" if i < 473 else "M", f"A{i}", f"p{i}@x.com", "d")
        for i in range(1000)
    ]
    again = [(*people[i][:6], f"alt{k}@x.com", "d") for k, i in enumerate([*range(36), 0, 1, 2])]
    return people + again


def bookings():
    """1000 bookings, 45 without status and 30 INVALID; two on the conflicting flight."""
    ids = [f[0] for f in flights()[:1003]]
    out = []
    for i in range(1000):
        status = None if i < 45 else "INVALID" if i < 75 else "CONFIRMED"
        flight = "6F250" if i in (500, 501) else ids[i]
        out.append((f"B{i}", f"P{1000 + i}", flight, START - timedelta(days=i % 300), status, "1A", f"N{i}", "k", "1"))
    return out


def payments():
    """1000 payments, 48 without and 30 with an invalid amount; 267 bookings have two; two are orphans."""
    booked = [*range(733), *range(267)]
    out = []
    for i, booking in enumerate(booked):
        amount = None if i < 48 else "INVALID" if i < 78 else "100.25"
        out.append((f"Y{i}", f"B{booking}", amount, "CARD"))
    return out


@pytest.fixture(scope="module")
def plan(spark):
    data = {"flights": flights(), "bookings": bookings(), "passengers": passengers(), "payments": payments()}
    return Airline(spark, {n: spark.createDataFrame(data[n], RAW[n]) for n in RAW})


def test_inputs_are_as_described(plan):
    assert rows(C.raw_counts(plan.raw)) == [
        ("bookings", 1000), ("flights", 1020), ("passengers", 1039), ("payments", 1000),
    ]
    several = plan.raw["payments"].groupBy("booking_id").count().where("count > 1").count()
    assert several == 267


def test_rows(plan):
    assert rows(plan.reconciliation()) == [
        ("bookings", 1000, 0, 2, 998, "PASS"),
        ("flights", 1020, 15, 2, 1003, "PASS"),
        ("passengers", 1039, 39, 0, 1000, "PASS"),
        ("payments", 1000, 0, 50, 950, "PASS"),
    ]


def test_airlines(plan):
    got = plan.airline_reconciliation().collect()[0]
    assert (got.source_missing_rows, got.derived_rows, got.lost_before_derivation) == (72, 67, 5)
    assert (got.final_null_key_rows, got.final_literal_unknown_rows) == (0, 0)
    counts = K.flights_by_airline(plan.table("fact_flights"), plan.table("dim_airline")).collect()
    assert [(r.airline, r.total_flights) for r in counts] == [(a, n) for _, a, n in AIRLINES]


def test_payments(plan):
    got = plan.payment_reconciliation().collect()[0]
    assert (got.null_amount_rows, got.source_invalid_rows, got.downstream_excluded_rows) == (48, 30, 2)
    assert (got.final_rows, got.status) == (950, "PASS")


def test_events(plan):
    events = {(r.dataset, r.rule_id, r.action): r.events for r in A.audit_by_rule(plan.audit()).collect()}
    assert events == {
        ("flights", "F-01", "REMOVE"): 1,
        ("flights", "F-02", "QUARANTINE"): 2,
        ("flights", "F-03", "CORRECT"): 67,
        ("flights", "F-04", "CORRECT"): 1,
        ("bookings", "B-01", "STANDARDIZE"): 45,
        ("bookings", "REF-01/02", "QUARANTINE"): 2,
        ("passengers", "P-01", "REMOVE (Keep First)"): 36,
        ("payments", "PAY-01", "QUARANTINE"): 48,
        ("payments", "PAY-02", "FLAG (MARKED_INVALID)"): 30,
        ("payments", "REF-03", "QUARANTINE"): 2,
    }


def test_figures(plan):
    got = K.kpi_scalars(plan.table("fact_flights"), plan.table("fact_bookings")).collect()[0]
    assert (got.total_flights, got.total_bookings) == (1003, 998)
    assert (got.overnight_flights, got.flight_anomalies) == (1, 0)
    assert plan.table("dim_airline").count() == 4 and plan.table("dim_route").count() == 30
    assert plan.table("dim_passengers").groupBy().agg(F.count_if(F.col("gender") == "F")).first()[0] == 473
    statuses = {r.status: r.total_bookings for r in C.booking_status(plan.table("fact_bookings")).collect()}
    assert (statuses["UNKNOWN"], statuses["INVALID"]) == (45, 30)
