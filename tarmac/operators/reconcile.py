"""Row accounting: every raw row is removed, quarantined or in the curated output."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import exact_sum

MEASURES = ["raw_rows", "removed_rows", "quarantined_rows", "final_rows"]


class ReconciliationError(ValueError):
    """Rows got lost or were counted twice."""


def raw_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows per dataset."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("raw_rows")).select(F.lit(name).alias("dataset"), "raw_rows")
        for name, df in datasets.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def reconcile(spark: SparkSession, tallies: dict[str, dict[str, int]]) -> DataFrame:
    """Compare raw - removed - quarantined with final rows of each dataset; absent figures are 0."""
    rows = [(name, *(tally.get(m, 0) for m in MEASURES)) for name, tally in tallies.items()]
    totals = spark.createDataFrame(
        rows, "dataset string, " + ", ".join(f"{m} long" for m in MEASURES)
    )
    expected = F.col("raw_rows") - F.col("removed_rows") - F.col("quarantined_rows")
    status = F.when(expected == F.col("final_rows"), "PASS").otherwise("FAIL")
    return totals.withColumn("status", status)


def assert_reconciled(recon: DataFrame, *datasets: str) -> None:
    """Raise if one of the datasets (default: any) does not add up. ``recon`` has a row per dataset."""
    failed = recon.where(F.col("status") != "PASS")
    if datasets:
        failed = failed.where(F.col("dataset").isin(*datasets))
    rows = failed.collect()
    if rows:
        raise ReconciliationError(f"Reconciliation failed: {[r.asDict() for r in rows]}")


def reconcile_payments(
    spark: SparkSession,
    raw_rows: int,
    removed_rows: int,
    null_amount_rows: int,
    source_invalid_rows: int,
    downstream_excluded_rows: int,
    final_rows: int,
    final_marked_invalid_rows: int,
) -> DataFrame:
    """How raw payments became final ones.

    Raw rows are counted by themselves, so rows lost before or during deduplication show.
    """
    expected = raw_rows - removed_rows - null_amount_rows - downstream_excluded_rows
    figures = {
        "raw_rows": raw_rows,
        "removed_rows": removed_rows,
        "null_amount_rows": null_amount_rows,
        "source_invalid_rows": source_invalid_rows,
        "downstream_excluded_rows": downstream_excluded_rows,
        "final_rows": final_rows,
        "final_marked_invalid_rows": final_marked_invalid_rows,
    }
    status = "PASS" if expected == final_rows else "FAIL"
    return spark.createDataFrame(
        [(*figures.values(), status)], ", ".join(f"{f} long" for f in figures) + ", status string"
    )


def reconcile_derivation(
    spark: SparkSession,
    source_missing_rows: int,
    derived_rows: int,
    handled_rows: int,
    final_null_key_rows: int,
    final_literal_unknown_rows: int,
) -> DataFrame:
    """What became of flights without a usable airline.

    ``handled_rows`` are surviving flights whose airline was derived or is still missing.
    """
    figures = {
        "source_missing_rows": source_missing_rows,
        "derived_rows": derived_rows,
        "lost_before_derivation": source_missing_rows - handled_rows,
        "final_null_key_rows": final_null_key_rows,
        "final_literal_unknown_rows": final_literal_unknown_rows,
    }
    return spark.createDataFrame([tuple(figures.values())], ", ".join(f"{f} long" for f in figures))


def booking_status(fb: DataFrame) -> DataFrame:
    """Bookings and revenue by status."""
    return fb.groupBy("status").agg(
        F.count("booking_id").alias("total_bookings"),
        exact_sum(F.col("total_paid_amount")).alias("total_revenue"),
    )


def payment_status(fp: DataFrame) -> DataFrame:
    """Payments and their sum by amount status; the sum of unparseable amounts is NULL."""
    return fp.groupBy("amount_status").agg(
        F.count("payment_id").alias("total_transactions"),
        exact_sum(F.col("amount_parsed")).alias("valid_revenue"),
    )


def quality_summary(recon: DataFrame, audit_counts: DataFrame) -> DataFrame:
    """Row accounting and audit counts as one list of (section, dataset, item, value)."""
    accounting = recon.unpivot(
        "dataset", MEASURES, "item", "value"
    ).select(F.lit("rows").alias("section"), "dataset", "item", "value")
    actions = audit_counts.select(
        F.lit("audit").alias("section"),
        "dataset",
        F.concat_ws(" ", "rule_id", "severity", "action").alias("item"),
        F.col("events").alias("value"),
    )
    return accounting.unionByName(actions)
