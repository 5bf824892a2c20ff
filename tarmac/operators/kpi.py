"""Headline figures over the curated star schema.

Facts are aggregated by surrogate key before they meet a dimension: what is joined and shuffled
has one row per key, however large or skewed the fact is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import exact_sum
from .quality import DERIVED

DURATION = "calculated_duration_mins"


def avg_duration_by_route(ff: DataFrame, dr: DataFrame) -> DataFrame:
    """Flights per route, their mean duration, and the mean without outliers."""
    normal = F.when(~F.col("is_statistical_outlier"), F.col(DURATION))
    per_key = ff.groupBy("route_key").agg(
        F.count("flight_id").alias("flights"),
        F.sum(DURATION).alias("minutes"),
        F.count(DURATION).alias("timed"),
        F.sum(normal).alias("normal_minutes"),
        F.count(normal).alias("normal_timed"),
    )
    return (
        dr.join(per_key, "route_key")
        .groupBy("route_name")
        .agg(
            F.sum("flights").alias("total_flights"),
            F.try_divide(F.sum("minutes"), F.sum("timed")).alias("avg_duration_mins"),
            F.try_divide(F.sum("normal_minutes"), F.sum("normal_timed")).alias(
                "avg_normal_duration_mins"
            ),
        )
        .orderBy(F.desc("total_flights"), "route_name")
    )


def route_traffic(dr: DataFrame, ff: DataFrame, fb: DataFrame) -> DataFrame:
    """Flights and distinct bookings per route; routes without any show 0.

    Flight ids are unique in their fact, so a plain count combines before the shuffle; booking ids
    may repeat.
    """
    flights = ff.groupBy("route_key").agg(F.count("flight_id").alias("flights"))
    bookings = fb.groupBy("route_key").agg(F.count_distinct("booking_id").alias("bookings"))
    return (
        dr.select("route_key", "route_name")
        .join(flights, "route_key", "left")
        .join(bookings, "route_key", "left")
        .select(
            "route_name",
            F.coalesce("flights", F.lit(0)).alias("total_flights_operated"),
            F.coalesce("bookings", F.lit(0)).alias("total_passenger_bookings"),
        )
        .orderBy(F.desc("total_passenger_bookings"), "route_name")
    )


def anomaly_rate_by_route(ff: DataFrame, dr: DataFrame) -> DataFrame:
    """Duration outliers per route, as count and as percentage of its flights."""
    per_key = ff.groupBy("route_key").agg(
        F.count("flight_id").alias("flights"),
        F.count_if("is_statistical_outlier").alias("anomalies"),
    )
    counted = (
        dr.join(per_key, "route_key")
        .groupBy("route_name")
        .agg(
            F.sum("flights").alias("total_flights"), F.sum("anomalies").alias("total_anomalies")
        )
    )
    share = F.try_divide(F.col("total_anomalies").cast("double"), F.col("total_flights"))
    return counted.withColumn("anomaly_percentage", share * F.lit(100)).orderBy(
        F.desc("anomaly_percentage"), "route_name"
    )


def flights_by_airline(ff: DataFrame, da: DataFrame) -> DataFrame:
    """Flights per airline, and how many of them got their airline from the flight id."""
    per_key = ff.groupBy("airline_key").agg(
        F.count("flight_id").alias("flights"),
        F.count_if(F.col("airline_source") == DERIVED).alias("derived"),
    )
    return (
        da.join(per_key, "airline_key")
        .groupBy("airline")
        .agg(
            F.sum("flights").alias("total_flights"),
            F.sum("derived").alias("derived_airline_count"),
        )
        .orderBy(F.desc("total_flights"), "airline")
    )


def kpi_scalars(ff: DataFrame, fb: DataFrame) -> DataFrame:
    """The headline numbers in one row."""
    bookings = fb.agg(
        F.struct(F.count(F.lit(1)).alias("n"), exact_sum(F.col("total_paid_amount")).alias("paid"))
    ).scalar()
    return (
        ff.agg(
            F.count(F.lit(1)).alias("total_flights"),
            F.avg(DURATION).alias("avg_duration_mins"),
            F.count_if("is_statistical_outlier").alias("flight_anomalies"),
            F.count_if("is_overnight").alias("overnight_flights"),
        )
        .withColumn("bookings", bookings)
        .select(
            "total_flights",
            "avg_duration_mins",
            "flight_anomalies",
            "overnight_flights",
            F.col("bookings.n").alias("total_bookings"),
            F.col("bookings.paid").alias("total_paid_amount"),
        )
    )


def top_route(fact: DataFrame, dr: DataFrame) -> DataFrame:
    """The route with most rows in the fact; among equals, the smallest route key."""
    top = (
        fact.where(F.col("route_key").isNotNull())
        .groupBy("route_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "route_key")
        .limit(1)
    )
    return top.join(dr.select("route_key", "route_name").distinct(), "route_key")
