import datetime

from base_helpers import rows

from tarmac.operators import model as M
from tarmac.schemas import CURATED


def test_dimension_of_complete_combinations(spark):
    df = spark.createDataFrame(
        [("CCU", "MAA"), ("CCU", "MAA"), ("CCU", None), (None, "MAA")], "source string, destination string"
    )
    dim = M.build_dim(df, ["source", "destination"], "route_key", "route_name")
    assert rows(dim) == [("CCU", "MAA", "CCU-MAA", "edec40d16277592f865f6f96d12c6237")]
    assert dim.columns == CURATED["dim_route"].names


def test_only_observed_days(spark):
    a = spark.createDataFrame([(datetime.datetime(2026, 4, 20, 23, 59),), (None,)], "t timestamp_ntz")
    b = spark.createDataFrame([(datetime.date(2026, 4, 20),), (datetime.date(2026, 1, 2),)], "d date")
    dim = M.build_dim_date(a, b)
    assert dim.schema.names == CURATED["dim_date"].names
    assert rows(dim) == [
        (datetime.date(2026, 1, 2), 20260102, 2026, 1, "January", 2),
        (datetime.date(2026, 4, 20), 20260420, 2026, 4, "April", 20),
    ]


def test_days_behind_keys(spark):
    fact = spark.createDataFrame([(20260420,), (0,), (20260420,)], "date_key int")
    assert rows(M.build_dim_date(M.observed_days(fact)), "date_key") == [(20260420,)]


def payments(spark):
    return spark.createDataFrame(
        [
            ("Y1", "B1", 10.0, "VALID"), ("Y2", "B1", 5.5, "VALID"), ("Y3", "B1", None, "MARKED_INVALID"),
            ("Y4", "B2", None, "MARKED_INVALID"), ("Y5", None, 1.0, "VALID"), ("Y6", "B9", 2.0, "VALID"),
        ],
        "payment_id string, booking_id string, amount_parsed double, amount_status string",
    )


def test_rollup_of_valid_payments(spark):
    assert rows(M.payment_rollup(payments(spark))) == [("B1", 15.5, 2), ("B9", 2.0, 1)]


def test_ledger_agrees_with_the_rollup(spark):
    bookings = spark.createDataFrame(
        [("B1", False), ("B2", False), ("B2", True), (None, True)], "booking_id string, is_orphan boolean"
    )
    ledger = M.booking_ledger(bookings, payments(spark))
    assert rows(ledger) == [
        ("B1", True, False, 15.5, 2), ("B2", True, True, None, 0), ("B9", False, False, 2.0, 1),
        (None, True, True, None, 0),
    ]


def test_curated_bookings(spark):
    bookings = spark.createDataFrame(
        [
            ("B1", "P1", "F1", datetime.datetime(2026, 4, 20), "OK", "1A"),
            ("B2", "P1", "F9", None, "OK", None),
        ],
        "booking_id string, passenger_id string, flight_id string, booking_date timestamp_ntz, status string, seat_number string",
    )
    flights = spark.createDataFrame(
        [("F1", "r", "a", 1, 1.0, False, False, "ORIGINAL")], CURATED["fact_flights"]
    )
    keys = flights.select("flight_id", "route_key", "airline_key")
    rollup = M.payment_rollup(payments(spark))
    joined = bookings.join(keys, "flight_id", "left").join(rollup, "booking_id", "left")
    fact = M.curated_bookings(joined)
    assert rows(fact) == [
        ("B1", "P1", "F1", "r", "a", 20260420, "OK", "1A", 15.5, 2),
        ("B2", "P1", "F9", None, None, 0, "OK", None, 0.0, 0),
    ]
