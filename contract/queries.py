"""The registered queries, each over the whole of its raw tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import audit as A
from tarmac.operators import explore as D
from tarmac.operators import kpi as K
from tarmac.operators import model as M
from tarmac.operators import reconcile as C
from tarmac.operators.dedup import CONFLICT
from tarmac.plans import Airline, Dashboard
from tarmac.rules import AirlineRules
from tarmac.schemas import REQUIRED, require_columns
from tarmac.sources.curated import (
    MONTH,
    on_days,
    read_curated,
    register_views,
    write_audit,
    write_curated,
    write_quarantine,
)

from tarmac.sources.datasets import READ_OPTIONS, read_datasets

from .inputs import CSV_ROWS, CSV_TIME_FORMAT, FLIGHT_IDS, raw_tables, write_raw_csv

Query = Callable[[SparkSession, str], DataFrame]

FOCUS = "IndiGo"
# The fixed selection of the filtered dashboard queries.
SELECTION = D.CrossFilter(airlines=(FOCUS,), sources=("DEL",), overnight_only=True)

#: The rules of the checked and the measured plan.
CHECKED = AirlineRules(flight_id_pattern=FLIGHT_IDS)

#: The year and month that the query on facts by month asks for.
MONTH_SHOWN = (1995, 3)

_csv_plans: dict[str, Airline] = {}
_plans: dict[tuple[str, str, str], Airline] = {}


def plan(spark: SparkSession, sf_dir: str, rules: AirlineRules | None = None) -> Airline:
    """The airline plan over ``sf_dir``; queries of one session share its staged tables."""
    rules = rules or CHECKED
    key = (spark.sparkContext.applicationId, sf_dir, json.dumps(asdict(rules), sort_keys=True))
    known = _plans.get(key)
    if known is None or known.spark is not spark:
        known = _plans[key] = Airline(spark, raw_tables(spark, sf_dir), rules)
    return known


def _dash(a: Airline) -> Dashboard:
    names = ("fact_flights", "fact_bookings", "fact_payments", "dim_airline", "dim_route")
    return Dashboard.of({n: a.table(n) for n in names}, a.stage)


def _facts(a: Airline) -> tuple[DataFrame, DataFrame]:
    return a.table("fact_flights"), a.table("fact_bookings")


def _required_columns(a: Airline) -> DataFrame:
    """Column check of the real inputs, and the number of rows that passed through it."""
    checked = require_columns(a.raw, REQUIRED)
    return C.raw_counts(checked)


def _quarantined(a: Airline, dataset: str) -> DataFrame:
    return a.quarantine()[dataset]


def _top_routes(a: Airline) -> DataFrame:
    ff, fb = _facts(a)
    dr = a.table("dim_route")
    flights = K.top_route(ff, dr).withColumn("measure", F.lit("flights"))
    return flights.unionByName(K.top_route(fb, dr).withColumn("measure", F.lit("bookings")))


def _through_views(a: Airline) -> DataFrame:
    """The curated layer served as SQL views, and a report written in SQL on them."""
    a.tables()
    register_views(a.spark, a.stage.path("curated"), prefix="served_")
    return a.spark.sql(
        """
        SELECT r.route_name, f.is_overnight, d.month_name,
               count(*) AS flights, avg(f.calculated_duration_mins) AS avg_duration_mins
        FROM served_fact_flights f
        JOIN served_dim_route r USING (route_key)
        JOIN served_dim_date d USING (date_key)
        GROUP BY r.route_name, f.is_overnight, d.month_name
        """
    )



def _frames(d: Dashboard) -> tuple[DataFrame, DataFrame, DataFrame]:
    return d.flights, d.bookings, d.payments


def _ranking(a: Airline, metric: str) -> DataFrame:
    d = _dash(a)
    return D.rank_routes(d.flights, d.bookings, metric)


def _box(a: Airline) -> DataFrame:
    box = _dash(a).duration_box()
    return box.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


def _emptiness(a: Airline) -> DataFrame:
    """The guard on a selection that has rows, and on one that has none."""
    nowhere = D.CrossFilter(sources=("nowhere",))
    found = [
        (what, D.is_empty(d.flights, d.bookings))
        for what, d in (("chosen", _dash(a).select(SELECTION)), ("nowhere", _dash(a).select(nowhere)))
    ]
    return a.spark.createDataFrame(found, "selection string, is_empty boolean")


def _through_namespace(a: Airline) -> DataFrame:
    """The same in a catalog namespace, as a reporting tool would address it."""
    a.tables()
    register_views(
        a.spark, a.stage.path("curated"), database="served", location=a.stage.path("served")
    )
    return a.spark.sql(
        """
        SELECT p.gender, b.status, count(*) AS bookings, count(DISTINCT b.passenger_id) AS passengers
        FROM served.fact_bookings b JOIN served.dim_passengers p USING (passenger_id)
        GROUP BY p.gender, b.status
        """
    )


def _through_csv(a: Airline) -> DataFrame:
    """All curated tables written as Parquet and CSV, loaded from the CSV files, and enriched."""
    root = a.stage.path("exchange")
    write_curated(a.tables(), root)
    loaded = read_curated(a.spark, root, "csv")
    return Dashboard.of(loaded).flights.join(
        loaded["dim_date"].select("date_key", "date"), "date_key", "left"
    )


def _through_quarantine(a: Airline) -> DataFrame:
    """The quarantine layer written and read back whole, all datasets with the columns of all."""
    root = a.stage.path("quarantine")
    rejected = a.quarantine()
    write_quarantine(rejected, root)
    return a.spark.read.option("mergeSchema", True).parquet(root)


def _through_audit(a: Airline) -> DataFrame:
    """The audit trail written as CSV and read back."""
    root = a.stage.path("audit")
    write_audit(a.audit(), root)
    return a.spark.read.options(**READ_OPTIONS).csv(root).drop("processed_timestamp")


def _through_export(a: Airline) -> DataFrame:
    """The selected bookings downloaded as CSV."""
    path = a.stage.path("download")
    chosen = _dash(a).select(SELECTION)
    chosen.export("bookings", path)
    return a.spark.read.options(**READ_OPTIONS).schema(chosen.bookings.schema).csv(path)


def _from_csv(a: Airline) -> Airline:
    """The plan over flights and bookings read from CSV files with broken rows and text times."""
    if a.stage.root not in _csv_plans:
        places = {name: a.stage.path(f"csv/{name}.csv") for name in CSV_ROWS}
        for name, path in places.items():
            write_raw_csv(a.raw, name, path)
        for name in set(a.raw) - set(CSV_ROWS):
            places[name] = a.stage.path(f"csv/{name}.parquet")
            a.raw[name].write.mode("overwrite").parquet(places[name])
        formats = {name: path.rsplit(".", 1)[1] for name, path in places.items()}
        read = read_datasets(a.spark, places, formats, malformed="mark")
        rules = replace(a.rules, timestamp_formats=(CSV_TIME_FORMAT,))
        _csv_plans[a.stage.root] = Airline(a.spark, read, rules)
    return _csv_plans[a.stage.root]


def _month(a: Airline) -> DataFrame:
    """Flights and mean duration by airline in one month, of facts published by month."""
    root = a.stage.path("published")
    write_curated(a.tables(), root)
    tables = read_curated(a.spark, root, months=True)
    days = tables["dim_date"].where((F.col("year") == MONTH_SHOWN[0]) & (F.col("month") == MONTH_SHOWN[1]))
    flights = on_days(tables["fact_flights"], days).drop(MONTH)
    return K.flights_by_airline(flights, tables["dim_airline"])


_ON_PLAN: dict[str, Callable[[Airline], DataFrame]] = {
    # sources and validation
    "require_columns_ok": _required_columns,
    "raw_counts": lambda a: a.raw_counts(),
    "csv_malformed_rows": lambda a: _from_csv(a).malformed_rows().select(
        "dataset", "record_id", "text"
    ),
    "csv_flights": lambda a: _from_csv(a).clean_flights().select(
        "flight_id", "airline", "source", "destination", "departure_time",
        "adjusted_arrival_time", "calculated_duration_mins", "copies",
    ),
    "csv_bookings": lambda a: _from_csv(a).standardised_bookings().select(
        "booking_id", "passenger_id", "flight_id", "booking_date", "status", "seat_number", "copies"
    ),
    "csv_reconciliation": lambda a: _from_csv(a).reconciliation(),
    "csv_audit": lambda a: A.audit_by_rule(_from_csv(a).audit()),
    # flights
    "flights_bad_format": lambda a: a.malformed_flights(),
    "flights_four_digits": lambda a: Airline(a.spark, a.raw, AirlineRules()).malformed_flights(),
    "flights_exact_dedup": lambda a: a.deduplicated_flights(),
    "flights_conflicts": lambda a: a.conflicting_flights(),
    "flights_airline_derived": lambda a: a.clean_flights().select(
        "flight_id", "airline", "airline_source"
    ),
    "flights_overnight": lambda a: a.clean_flights()
    .where("overnight_flag")
    .select("flight_id", "departure_time", "arrival_time", "adjusted_arrival_time"),
    "flights_duration": lambda a: a.clean_flights().select(
        "flight_id", "overnight_flag", "calculated_duration_mins"
    ),
    "flights_iqr_bounds": lambda a: a.route_bounds().select(
        "source", "destination", F.round("upper_bound", 6).alias("upper_bound")
    ),
    "flights_iqr_outliers": lambda a: a.flagged_flights()
    .where("is_statistical_outlier")
    .select("flight_id", "source", "destination", "calculated_duration_mins"),
    # bookings
    "bookings_standardised": lambda a: a.standardised_bookings().select(
        "booking_id", "passenger_id", "flight_id", "booking_date", "status", "seat_number"
    ),
    "bookings_protected": lambda a: a.protected_bookings(),
    "bookings_orphans": lambda a: a.orphan_bookings().select(
        "booking_id", "passenger_id", "flight_id", "has_flight", "has_passenger"
    ),
    # passengers
    "passengers_conflicts": lambda a: a.conflicting_passengers(),
    "passengers_resolved": lambda a: a.resolved_passengers().select(
        "passenger_id", "age", "gender", "copies", "duplicated", "conflict"
    ).where(~F.col(CONFLICT)),
    "passengers_protected": lambda a: a.protected_passengers(),
    # payments
    "payments_parsed": lambda a: a.parsed_payments().select(
        "payment_id", "booking_id", "amount", "amount_parsed", "amount_status"
    ),
    "payments_quarantine": lambda a: _quarantined(a, "payments"),
    "payments_orphans": lambda a: a.orphan_payments().select(
        "payment_id", "booking_id", "amount_parsed", "amount_status"
    ),
    "payment_rollup": lambda a: M.payment_rollup(a.parsed_payments()),
    "booking_ledger": lambda a: a.booking_ledger(),
    "bookings_quarantine": lambda a: _quarantined(a, "bookings"),
    "passengers_quarantine": lambda a: _quarantined(a, "passengers"),
    "flights_quarantine": lambda a: _quarantined(a, "flights"),
    # star schema
    "dim_airline": lambda a: a.table("dim_airline"),
    "dim_route": lambda a: a.table("dim_route"),
    "dim_date": lambda a: a.table("dim_date"),
    "dim_passengers": lambda a: a.table("dim_passengers"),
    "fact_flights": lambda a: a.table("fact_flights"),
    "fact_bookings": lambda a: a.table("fact_bookings"),
    "fact_payments": lambda a: a.table("fact_payments"),
    # audit and reconciliation
    "audit_by_rule": lambda a: A.audit_by_rule(a.audit()),
    "audit_events": lambda a: a.audit().drop("processed_timestamp"),
    "recon_datasets": lambda a: a.reconciliation(),
    "recon_payments": lambda a: a.payment_reconciliation(),
    "recon_airline": lambda a: a.airline_reconciliation(),
    "quality_summary": lambda a: a.quality_summary(),
    "dq_booking_status": lambda a: C.booking_status(_facts(a)[1]),
    "dq_payment_status": lambda a: C.payment_status(a.table("fact_payments")),
    # headline figures
    "k1_avg_duration_by_route": lambda a: K.avg_duration_by_route(
        a.table("fact_flights"), a.table("dim_route")
    ),
    "k2_route_traffic": lambda a: K.route_traffic(a.table("dim_route"), *_facts(a)),
    "k3_anomaly_rate_by_route": lambda a: K.anomaly_rate_by_route(
        a.table("fact_flights"), a.table("dim_route")
    ),
    "k4_flights_by_airline": lambda a: K.flights_by_airline(
        a.table("fact_flights"), a.table("dim_airline")
    ),
    "kpi_scalars": lambda a: K.kpi_scalars(*_facts(a)),
    "kpi_top_routes": _top_routes,
    "kpi_flights_by_airline": lambda a: K.flights_by_airline(
        a.table("fact_flights"), a.table("dim_airline")
    ).select("airline", "total_flights"),
    # dashboard
    "dash_enriched": lambda a: _dash(a).flights,
    "dash_enriched_bookings": lambda a: _dash(a).bookings,
    "dash_domains": lambda a: D.filter_domains(_dash(a).flights),
    "dash_cards": lambda a: D.kpi_cards(*_frames(_dash(a))),
    "dash_cards_filtered": lambda a: D.kpi_cards(*_frames(_dash(a).select(SELECTION))),
    "dash_is_empty": lambda a: _emptiness(a),
    "dash_busiest": lambda a: D.busiest(_dash(a).flights, "airline")
    .select(F.lit("airline").alias("what"), F.col("airline").alias("value"), "n")
    .unionByName(
        D.busiest(_dash(a).flights, "route_name").select(
            F.lit("route").alias("what"), F.col("route_name").alias("value"), "n"
        )
    ),
    "dash_airline_counts": lambda a: D.value_counts(_dash(a).flights, "airline", "flights"),
    "dash_status_counts": lambda a: D.value_counts(_dash(a).bookings, "status", "bookings"),
    "dash_payment_quality": lambda a: D.value_counts(_dash(a).payments, "amount_status", "n"),
    "dash_top10_routes": lambda a: D.top_k(_dash(a).flights, "route_name", 10, "flights"),
    "dash_route_ranking_volume": lambda a: _ranking(a, "volume"),
    "dash_route_ranking_demand": lambda a: _ranking(a, "demand"),
    "dash_route_ranking_duration": lambda a: _ranking(a, "duration"),
    "dash_volume_vs_demand": lambda a: D.volume_vs_demand(_dash(a).flights, _dash(a).bookings),
    "dash_duration_view_normal": lambda a: D.duration_view(_dash(a).flights, "normal"),
    "dash_duration_view_anomaly": lambda a: D.duration_view(_dash(a).flights, "anomaly"),
    "dash_duration_view_overnight": lambda a: D.duration_view(_dash(a).flights, "overnight"),
    "dash_duration_hist": lambda a: _dash(a).duration_histogram().select("bin", "n"),
    "dash_duration_box": lambda a: _box(a),
    "dash_anomaly_detail": lambda a: D.anomaly_detail(_dash(a).flights),
    "dash_airline_focus": lambda a: D.airline_focus(_dash(a).flights, _dash(a).bookings, FOCUS),
    "dash_airline_sources": lambda a: D.value_counts(
        _dash(a).flights.where(F.col("airline") == FOCUS), "airline_source", "n"
    ),
    "dash_airline_routes": lambda a: D.top_k(
        _dash(a).flights.where(F.col("airline") == FOCUS), "route_name", 10, "flights"
    ),
    "dash_explorer_flights": lambda a: _dash(a).select(SELECTION).explore("flights"),
    "dash_explorer_bookings": lambda a: _dash(a).select(SELECTION).explore("bookings"),
    "dash_explorer_payments": lambda a: _dash(a).select(SELECTION).explore("payments"),
    # serving
    "views_roundtrip": _through_views,
    "views_namespace": _through_namespace,
    "month_by_airline": _month,
    "curated_csv_roundtrip": _through_csv,
    "quarantine_roundtrip": _through_quarantine,
    "audit_roundtrip": _through_audit,
    "export_roundtrip": _through_export,
}


def all_queries(rules: AirlineRules | None = None) -> dict[str, Query]:
    def on_plan(build: Callable[[Airline], DataFrame]) -> Query:
        return lambda spark, sf_dir: build(plan(spark, sf_dir, rules))

    return {name: on_plan(build) for name, build in _ON_PLAN.items()}
