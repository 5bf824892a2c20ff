"""The curated layer on storage: Parquet and CSV copies, quarantine, audit, and SQL views."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CURATED, SchemaError, conform, require_types
from .datasets import CSV_OPTIONS, MissingDatasetError, read_frame


#: The folder column of facts with a date: year and month of their date key.
MONTH = "date_month"
DATED_FACTS = ("fact_flights", "fact_bookings")
#: Most rows of a CSV file. As values hold line breaks, whoever reads a file reads it in one task.
CSV_FILE_ROWS = 200_000


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def export_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the CSV files (with header) at ``path``; text keeps its blanks and line breaks."""
    writer = df.write.mode("overwrite").options(**CSV_OPTIONS, maxRecordsPerFile=CSV_FILE_ROWS)
    writer.partitionBy(*partition_by).csv(path)


def month_of(date_key: str) -> Column:
    """The year and month of a date key, 0 for no date."""
    return F.floor(F.col(date_key) / 100).cast("int")


def by_month(fact: DataFrame) -> DataFrame:
    """A fact with its month, whose rows are dealt for a folder per month.

    Rebalancing puts the rows of a month together, so there are few files, but splits a month
    with very many rows, and joins months with few.
    """
    return fact.withColumn(MONTH, month_of("date_key")).hint("rebalance", MONTH)


def write_curated(tables: dict[str, DataFrame], root: str) -> None:
    """Write each curated table as ``<name>.parquet`` and ``<name>.csv`` below ``root``.

    Parquet facts with a date are in folders by month, which readers that ask for days skip.
    """
    for name, df in tables.items():
        table = df.select(*CURATED[name].names)
        if name in DATED_FACTS:
            write_parquet(by_month(table), f"{root}/{name}.parquet", [MONTH])
        else:
            write_parquet(table, f"{root}/{name}.parquet")
        export_csv(table, f"{root}/{name}.csv")


def write_quarantine(rejected: dict[str, DataFrame], root: str) -> None:
    """Write the rejected rows of each dataset, partitioned by the rule that rejected them."""
    for dataset, df in rejected.items():
        write_parquet(df, f"{root}/dataset={dataset}", ["rule_id"])


def write_audit(audit: DataFrame, root: str, fmt: str = "csv") -> None:
    """Write the audit trail, partitioned by dataset."""
    if fmt == "csv":
        export_csv(audit, root, ["dataset"])
    else:
        write_parquet(audit, root, ["dataset"])


def read_curated(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    names: Iterable[str] = CURATED,
    months: bool = False,
) -> dict[str, DataFrame]:
    """Load curated tables, after checking that every one is there and has its columns.

    With ``months`` facts in folders by month keep ``date_month``, by which ``on_days`` prunes.
    """
    tables = {}
    for name in names:
        location = f"{root}/{name}.{fmt}"
        try:
            df = read_frame(spark, location, fmt)
        except MissingDatasetError as error:
            raise MissingDatasetError(f"Required curated table missing: {location}") from error
        missing = [c for c in CURATED[name].names if c not in df.columns]
        if missing:
            raise SchemaError(f"Schema Error: {name} missing {missing}")
        df = conform(df, CURATED[name]) if fmt == "csv" else require_types(df, name, CURATED[name])
        kept = [MONTH] if months and MONTH in df.columns else []
        tables[name] = df.select(*CURATED[name].names, *kept)
    return tables


def on_days(fact: DataFrame, days: DataFrame) -> DataFrame:
    """The facts of some members of ``dim_date``.

    Of a fact that has kept its ``date_month``, Spark reads only the folders of these days' months,
    which it learns from ``days`` while the query runs.
    """
    keys = ["date_key"]
    if MONTH in fact.columns:
        days, keys = days.withColumn(MONTH, month_of("date_key")), [MONTH, "date_key"]
    return fact.join(days.select(*keys), keys, "left_semi").select(*fact.columns)


def register_views(
    spark: SparkSession,
    root: str,
    database: str | None = None,
    names: Iterable[str] = CURATED,
    prefix: str = "",
    location: str | None = None,
) -> list[str]:
    """Serve curated Parquet tables as SQL views with exactly the contract's columns.

    With ``database`` the views are catalog views in that (created) namespace, so that SQL can say
    ``<database>.fact_flights``; without, they are temporary views of the session. ``location``
    is where a new namespace would keep tables of its own, else the warehouse folder.
    """
    if database is not None:
        at = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
    views = []
    for name in names:
        columns = ", ".join(f"`{c}`" for c in CURATED[name].names)
        query = f"SELECT {columns} FROM parquet.`{root}/{name}.parquet`"
        if database is None:
            view, kind = f"`{prefix}{name}`", "TEMPORARY VIEW"
        else:
            view, kind = f"`{database}`.`{prefix}{name}`", "VIEW"
        spark.sql(f"CREATE OR REPLACE {kind} {view} AS {query}")
        views.append(view)
    return views
