"""Row-level validation, standardisation and derivation rules. All are narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import fitting
from ..functions.text import finite, plain_number, strip

ORIGINAL = "ORIGINAL"
DERIVED = "DERIVED"
VALID = "VALID"
MARKED_INVALID = "MARKED_INVALID"

_NUMBER = "__number"


def validate_key_format(df: DataFrame, key: str, pattern: str) -> tuple[DataFrame, DataFrame]:
    """Split into rows whose trimmed key matches ``pattern``, and the rest (NULL and blank too).

    The stored value is left as it is.
    """
    valid = F.coalesce(strip(key).rlike(pattern), F.lit(False))
    return df.where(valid), df.where(~valid)


def derive_from_prefix(
    df: DataFrame,
    key: str,
    target: str,
    mapping: dict[str, str],
    width: int = 2,
    missing: Sequence[str] = ("UNKNOWN",),
    source_col: str = "airline_source",
) -> DataFrame:
    """Fill a missing ``target`` from the first ``width`` characters of ``key``.

    Missing means NULL or one of ``missing``. ``source_col`` says DERIVED where a value was
    filled in, else ORIGINAL; a prefix outside ``mapping`` leaves the row as it is.
    """
    lookup = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    candidate = F.try_element_at(lookup, F.substring(key, 1, width))
    absent = F.col(target).isNull() | F.col(target).isin(*missing)
    derived = absent & candidate.isNotNull()
    return df.withColumns(
        {
            target: F.when(derived, candidate).otherwise(F.col(target)),
            source_col: F.when(derived, DERIVED).otherwise(ORIGINAL),
        }
    )


def standardise_null(df: DataFrame, col: str, value: str) -> DataFrame:
    """Replace NULL by ``value``; other values, also odd ones, stay."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))


def parse_amount(
    df: DataFrame, col: str, parsed: str = "amount_parsed", status: str = "amount_status"
) -> DataFrame:
    """Add the number in ``col`` and its status: VALID, MARKED_INVALID, or NULL for no amount.

    A number that the type of amounts cannot hold exactly is marked invalid, not rounded.
    """
    # A column of its own for each step: a nested expression is evaluated for each use of it.
    number = F.col(_NUMBER)
    df = df.withColumn(_NUMBER, strip(F.col(col).cast("string")))
    df = df.withColumn(_NUMBER, plain_number(number)).withColumn(_NUMBER, fitting(finite(number)))
    return df.withColumns(
        {
            parsed: number,
            status: F.when(F.col(col).isNotNull(), F.when(number.isNull(), MARKED_INVALID).otherwise(VALID)),
        }
    ).drop(_NUMBER)
