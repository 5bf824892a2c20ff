"""Findings travel with the rows in one array column and become audit events at the end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import Rule

FINDINGS = "dq"
AUDIT_COLUMNS = [
    "record_id",
    "dataset",
    "rule_id",
    "issue",
    "severity",
    "action",
    "processed_timestamp",
]


def finding(rule: Rule, when: Column, **parts: Column) -> Column:
    """A list with the rule where ``when`` holds, else an empty one.

    ``parts`` fill ``{name}`` in the rule's issue text from columns of the row.
    """
    issue = F.lit(rule.issue)
    for name, value in parts.items():
        issue = F.replace(issue, F.lit("{" + name + "}"), value)
    event = F.struct(
        F.lit(rule.rule_id).alias("rule_id"),
        issue.alias("issue"),
        F.lit(rule.severity).alias("severity"),
        F.lit(rule.action).alias("action"),
    )
    return F.when(when, F.array(event)).otherwise(F.array())


def tag(df: DataFrame, *findings: Column) -> DataFrame:
    """Append the findings that apply to the row's list."""
    known = [F.col(FINDINGS)] if FINDINGS in df.columns else []
    return df.withColumn(FINDINGS, F.concat(*known, *findings))


def audit_log(tagged: DataFrame, record_id: str, dataset: str | Column, run_ts: str) -> DataFrame:
    """One audit event per finding; the run's timestamp is the same for all of them."""
    name = F.lit(dataset) if isinstance(dataset, str) else dataset
    events = tagged.where(F.size(FINDINGS) > 0).select(
        F.col(record_id).cast("string").alias("record_id"),
        name.alias("dataset"),
        F.explode(FINDINGS).alias("event"),
    )
    return events.select(
        F.coalesce("record_id", F.lit("nan")).alias("record_id"),
        "dataset",
        "event.*",
        F.lit(run_ts).alias("processed_timestamp"),
    )


def duplicates_summary(
    spark: SparkSession, duplicated: Sequence[tuple[str, Rule]], run_ts: str
) -> DataFrame:
    """One event for all exact duplicates of each dataset that had some."""
    events = [("Multiple", dataset, *rule, run_ts) for dataset, rule in duplicated]
    return spark.createDataFrame(events, ", ".join(f"{c} string" for c in AUDIT_COLUMNS))


def audit_by_rule(audit: DataFrame) -> DataFrame:
    """Number of events by dataset, rule, issue class and action."""
    return audit.groupBy("dataset", "rule_id", "severity", "action").agg(
        F.count(F.lit(1)).alias("events")
    )
