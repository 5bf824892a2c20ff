"""Interactive exploration: cross-filters and the aggregates behind every dashboard element.

``ff`` and ``fb`` are facts enriched with the airline and route attributes, ``fp`` the payments.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import exact_sum
from .kpi import DURATION
from .quality import VALID


def enrich(fact: DataFrame, da: DataFrame, dr: DataFrame) -> DataFrame:
    """Add airline, source, destination and route name; facts without a member keep NULLs."""
    return fact.join(da, "airline_key", "left").join(dr, "route_key", "left")


#: The columns that selections act on, and where payments carry them.
FILTERED = ["airline", "route_name", "source", "destination"]
BOOKED = "booked"


def carry_filters(fp: DataFrame, fb: DataFrame) -> DataFrame:
    """Payments with the distinct filter columns of the bookings they are for, as a list.

    Booking ids may repeat, so a payment can be for several; the list is never longer than the
    airlines and routes there are. Done once, a selection needs no join from payments to bookings.
    """
    of_booking = fb.where(F.col("booking_id").isNotNull()).groupBy("booking_id").agg(
        F.collect_set(F.struct(*FILTERED)).alias(BOOKED)
    )
    return fp.join(of_booking, "booking_id", "left").select(*fp.columns, BOOKED)


def filter_domains(ff: DataFrame) -> DataFrame:
    """What each filter offers: the values of every filter column, sorted, in one pass over ``ff``."""
    combinations = ff.select(*FILTERED).distinct()
    return (
        combinations.unpivot([], FILTERED, "domain", "value")
        .dropna()
        .distinct()
        .orderBy("domain", "value")
    )


@dataclass(frozen=True)
class CrossFilter:
    """A selection shared by all views; an empty selection does not filter."""

    airlines: tuple[str, ...] = ()
    routes: tuple[str, ...] = ()
    sources: tuple[str, ...] = ()
    destinations: tuple[str, ...] = ()
    overnight_only: bool = False
    anomaly_only: bool = False

    def _wanted(self, column: Callable[[str], Column]) -> list[Column]:
        chosen = zip(FILTERED, (self.airlines, self.routes, self.sources, self.destinations))
        return [column(c).isin(*values) for c, values in chosen if values]

    def shared(self, df: DataFrame) -> DataFrame:
        """The selections that reach flights and bookings alike."""
        wanted = self._wanted(F.col)
        return df.where(reduce(Column.__and__, wanted)) if wanted else df

    def flights(self, ff: DataFrame) -> DataFrame:
        """Selected flights; the overnight and anomaly switches act here only."""
        ff = self.shared(ff)
        if self.overnight_only:
            ff = ff.where("is_overnight")
        if self.anomaly_only:
            ff = ff.where("is_statistical_outlier")
        return ff

    def payments(self, fp: DataFrame) -> DataFrame:
        """Payments, with what ``carry_filters`` added, of which any booking is selected."""
        if not self._wanted(F.col):
            return fp
        return fp.where(
            F.exists(BOOKED, lambda b: reduce(Column.__and__, self._wanted(b.getField)))
        )

    def apply(
        self, ff: DataFrame, fb: DataFrame, fp: DataFrame
    ) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Selected flights, selected bookings, and the payments of those bookings.

        Every curated payment has a curated booking, so a selection that reaches no booking
        leaves the payments as they are.
        """
        return self.flights(ff), self.shared(fb), self.payments(fp)


def is_empty(ff: DataFrame, fb: DataFrame) -> bool:
    """Does the selection leave neither flights nor bookings?"""
    return ff.isEmpty() and fb.isEmpty()


def kpi_cards(ff: DataFrame, fb: DataFrame, fp: DataFrame) -> DataFrame:
    """The six cards in one row; the mean duration of no flights is shown as 0."""
    bookings = fb.agg(F.count(F.lit(1))).scalar()
    paid = fp.where(F.col("amount_status") == VALID).agg(exact_sum(F.col("amount_parsed"))).scalar()
    flights = F.count(F.lit(1))
    return ff.agg(
        flights.alias("total_flights"),
        F.when(flights == 0, F.lit(0.0)).otherwise(F.avg(DURATION)).alias("avg_duration_mins"),
        F.count_if("is_overnight").alias("overnight_flights"),
        F.count_if("is_statistical_outlier").alias("anomalies"),
    ).withColumns(
        {"total_bookings": bookings, "total_paid_amount": F.coalesce(paid, F.lit(0.0))}
    )


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Rows per value, most frequent first; NULLs are not a value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), col)


def top_k(df: DataFrame, col: str, k: int, name: str = "n") -> DataFrame:
    """The ``k`` most frequent values; equals in order of the value."""
    return value_counts(df, col, name).limit(k)


def busiest(df: DataFrame, col: str) -> DataFrame:
    """The most frequent value."""
    return top_k(df, col, 1)


def _per_route(df: DataFrame, *aggregates: Column) -> DataFrame:
    return df.where(F.col("route_name").isNotNull()).groupBy("route_name").agg(*aggregates)


def rank_routes(ff: DataFrame, fb: DataFrame, metric: str, k: int = 15) -> DataFrame:
    """The ``k`` top routes by ``volume`` (flights), ``demand`` (bookings) or mean ``duration``."""
    rows = F.count(F.lit(1))
    sources = {"volume": (ff, rows), "demand": (fb, rows), "duration": (ff, F.avg(DURATION))}
    if metric not in sources:
        raise ValueError(f"unknown metric {metric!r}; expected one of {sorted(sources)}")
    df, value = sources[metric]
    ranked = _per_route(df, value.alias("metric_value"))
    return ranked.orderBy(F.desc("metric_value"), "route_name").limit(k)


def volume_vs_demand(ff: DataFrame, fb: DataFrame) -> DataFrame:
    """Flights, bookings and mean duration of the routes that have both flights and bookings."""
    flights = _per_route(
        ff, F.count(F.lit(1)).alias("flights"), F.avg(DURATION).alias("avg_duration_mins")
    )
    bookings = _per_route(fb, F.count(F.lit(1)).alias("bookings"))
    return flights.join(bookings, "route_name").orderBy("route_name")


def duration_view(ff: DataFrame, view: str) -> DataFrame:
    """Flights of a view: ``all``, ``normal``, ``anomaly`` or ``overnight``."""
    conditions = {
        "all": F.lit(True),
        "normal": ~F.col("is_statistical_outlier"),
        "anomaly": F.col("is_statistical_outlier"),
        "overnight": F.col("is_overnight"),
    }
    if view not in conditions:
        raise ValueError(f"unknown view {view!r}; expected one of {sorted(conditions)}")
    return ff.where(conditions[view])


def anomaly_detail(ff: DataFrame) -> DataFrame:
    """The outlying flights."""
    return duration_view(ff, "anomaly").select(
        "flight_id", "airline", "route_name", DURATION, "is_overnight"
    )


def airline_focus(ff: DataFrame, fb: DataFrame, airline: str) -> DataFrame:
    """Cards of a single airline."""
    chosen = F.col("airline") == airline
    flights = F.count(F.lit(1))
    return ff.where(chosen).agg(
        F.lit(airline).alias("airline"),
        flights.alias("flights"),
        F.when(flights == 0, F.lit(0.0)).otherwise(F.avg(DURATION)).alias("avg_duration_mins"),
        F.count_if("is_statistical_outlier").alias("anomalies"),
    ).withColumn("bookings", fb.where(chosen).agg(F.count(F.lit(1))).scalar())
