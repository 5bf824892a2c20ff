"""The four raw datasets."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import RAW, conform, require_columns

FORMATS = ("parquet", "csv", "table")

#: CSV as written and read here: a header, doubled quotes, and values as they are.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
#: On reading, a quoted empty value is empty text and an unquoted one is NULL; for this, NULL must
#: have a text of its own that no file holds.
READ_OPTIONS = {**CSV_OPTIONS, "nullValue": "\x00"}
#: Where ``malformed="mark"`` puts the text of a row that has too many or too few fields.
MALFORMED = "malformed_row"


class MissingDatasetError(FileNotFoundError):
    """An expected dataset is not there."""


def _read_csv(spark: SparkSession, location: str, multi_line: bool, malformed: str) -> DataFrame:
    options = {**READ_OPTIONS, "multiLine": multi_line}
    schema = spark.read.options(**options).csv(location).schema
    # All fields are parsed, whichever are asked for, so that no bad row passes unseen.
    options["columnPruning"] = False
    if malformed == "fail":
        return spark.read.options(**options, mode="FAILFAST").schema(schema).csv(location)
    schema = T.StructType([*schema, T.StructField(MALFORMED, T.StringType())])
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    return spark.read.options(**options).schema(schema).csv(location)


def read_frame(
    spark: SparkSession,
    location: str,
    fmt: str,
    multi_line: bool = True,
    malformed: str = "fail",
) -> DataFrame:
    """One dataset as it is stored; CSV columns come as text, named by the header.

    CSV values may hold line breaks, so a file is read by one task; turn ``multi_line`` off for
    large files that are known to have a row per line, which are split. A CSV row with another
    number of fields than the header fails the read, or with ``malformed="mark"`` stays, with its
    text in the column ``malformed_row``.
    """
    if malformed not in ("fail", "mark"):
        raise ValueError(f"unknown treatment of malformed rows {malformed!r}")
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
    try:
        if fmt == "table":
            return spark.read.table(location)
        if fmt == "csv":
            return _read_csv(spark, location, multi_line, malformed)
        return spark.read.parquet(location)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            raise MissingDatasetError(f"Required dataset missing: {location}") from error
        raise


def read_datasets(
    spark: SparkSession,
    locations: dict[str, str],
    fmt: str | dict[str, str] = "parquet",
    multi_line: bool = True,
    malformed: str = "fail",
) -> dict[str, DataFrame]:
    """Read flights, bookings, passengers and payments, check and type their columns.

    ``fmt`` is the format of all, or of each dataset. Times are left as stored: reading them
    leniently is part of the cleaning rules. So are rows with too many or too few fields, if they
    are marked: the plan puts them into quarantine and audit.
    """
    frames = {
        name: read_frame(
            spark, at, fmt if isinstance(fmt, str) else fmt[name], multi_line, malformed
        )
        for name, at in locations.items()
    }
    require_columns(frames)
    times = {"departure_time", "arrival_time", "booking_date"}
    return {
        name: conform(df, type(RAW[name])([f for f in RAW[name] if f.name not in times]))
        if name in RAW
        else df
        for name, df in frames.items()
    }
