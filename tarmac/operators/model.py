"""Dimensions, facts and the per-booking ledger that connects bookings with payments."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import exact_sum
from ..functions.temporal import date_key
from ..functions.text import surrogate_key
from ..schemas import CURATED
from .quality import VALID


def build_dim(df: DataFrame, cols: Sequence[str], key: str, name: str | None = None) -> DataFrame:
    """Distinct, complete combinations of ``cols`` with their surrogate ``key``.

    With ``name``, the parts joined by '-' are added as the member's name.
    """
    members = df.select(*cols).distinct().dropna()
    if name is not None:
        members = members.withColumn(name, F.concat_ws("-", *cols))
    return members.withColumn(key, surrogate_key(*cols))


def build_dim_date(*dates: DataFrame) -> DataFrame:
    """The calendar days that occur in any of the one-column frames."""
    columns = [d.select(F.to_date(d.columns[0]).alias("date")) for d in dates]
    days = reduce(DataFrame.unionAll, columns).distinct().dropna()
    return days.select(
        "date",
        date_key(F.col("date")).alias("date_key"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.day("date").alias("day"),
    )


def observed_days(fact: DataFrame) -> DataFrame:
    """The dates behind a fact's date keys; key 0 stands for no date."""
    text = F.when(F.col("date_key") > 0, F.lpad(F.col("date_key").cast("string"), 8, "0"))
    return fact.select(F.to_date(text, "yyyyMMdd").alias("date"))


def fact_flights(flights: DataFrame) -> DataFrame:
    """Cleaned flights with outlier flag to the curated columns."""
    return flights.withColumns(
        {
            "route_key": surrogate_key("source", "destination"),
            "airline_key": surrogate_key("airline"),
            "date_key": date_key(F.col("departure_time")),
            "is_overnight": F.col("overnight_flag"),
        }
    ).select(*CURATED["fact_flights"].names)


def payment_rollup(payments: DataFrame) -> DataFrame:
    """Sum and number of the VALID payments of each booking."""
    valid = payments.where((F.col("amount_status") == VALID) & F.col("booking_id").isNotNull())
    return valid.groupBy("booking_id").agg(
        exact_sum(F.col("amount_parsed")).alias("total_paid_amount"),
        F.count("payment_id").cast("int").alias("payment_count"),
    )


def booking_ledger(bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per booking id: is there a booking, is any of them an orphan, what was paid.

    Both referential checks on booking ids (all bookings that share an orphan's id, payments
    without a surviving booking) and the payment rollup need facts per booking id. One
    aggregation over the union of the two tables gives them, so each table is later joined to a
    side with unique keys. ``bookings`` has a boolean ``is_orphan``.
    """
    booked = bookings.select(
        "booking_id",
        F.lit(True).alias("is_booked"),
        "is_orphan",
        F.lit(None).cast("double").alias("amount"),
        F.lit(None).cast("string").alias("payment_id"),
    )
    paid = payments.where(
        (F.col("amount_status") == VALID) & F.col("booking_id").isNotNull()
    ).select(
        "booking_id",
        F.lit(False).alias("is_booked"),
        F.lit(False).alias("is_orphan"),
        F.col("amount_parsed").alias("amount"),
        "payment_id",
    )
    return (
        booked.unionByName(paid)
        .groupBy("booking_id")
        .agg(
            F.max("is_booked").alias("has_booking"),
            F.max("is_orphan").alias("has_orphan"),
            exact_sum(F.col("amount")).alias("total_paid_amount"),
            F.count("payment_id").cast("int").alias("payment_count"),
        )
    )


def curated_bookings(bookings: DataFrame) -> DataFrame:
    """Bookings that already carry flight keys and payment totals, to the curated columns."""
    return bookings.withColumns(
        {
            "date_key": date_key(F.col("booking_date")),
            "total_paid_amount": F.coalesce("total_paid_amount", F.lit(0.0)),
            "payment_count": F.coalesce("payment_count", F.lit(0)),
        }
    ).select(*CURATED["fact_bookings"].names)


def fact_payments(payments: DataFrame) -> DataFrame:
    """Retained payments to the curated columns."""
    return payments.select(*CURATED["fact_payments"].names)
