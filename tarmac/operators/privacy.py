"""Pseudonymisation, masking and column minimisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.text import hash_text, masked_email, masked_tail


def pseudonymise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace the columns by their SHA-256."""
    return df.withColumns({c: hash_text(c) for c in cols})


def mask_email(df: DataFrame, col: str = "email") -> DataFrame:
    """Keep the first character and the domain of an e-mail address."""
    return df.withColumn(col, masked_email(col))


def mask_tail(df: DataFrame, cols: Sequence[str], n: int = 4) -> DataFrame:
    """Hide the last ``n`` characters, as for phone numbers."""
    return df.withColumns({c: masked_tail(c, n) for c in cols})


def suppress(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the columns that are present."""
    return df.drop(*cols)


def allowlist(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Let only the named columns out."""
    return df.select(*cols)
