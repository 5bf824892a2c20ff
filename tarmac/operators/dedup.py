"""Exact duplicates and rows that share a key.

Everything here is a hash aggregation with map-side combining, so a row (or key) that makes up a
large share of the input is reduced before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COPIES = "copies"
DUPLICATED = "duplicated"
CONFLICT = "conflict"

Write = Callable[[DataFrame], DataFrame]


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One row of each set of identical rows; NULLs compare equal."""
    return df.dropDuplicates()


def count_copies(df: DataFrame) -> DataFrame:
    """``drop_exact_duplicates`` that also reports how many identical rows there were."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def fingerprint(cols: Sequence[str]) -> list[Column]:
    """Two numbers of 64 bits that stand for the values of ``cols``; NULL is a value of its own."""
    absent = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in cols])
    return [F.xxhash64(F.lit(seed), absent, *cols) for seed in (1, 2)]


def resolve_by_key(
    df: DataFrame,
    key: str,
    compare_cols: Sequence[str] | None = None,
    order_col: str | None = None,
    write: Write | None = None,
) -> DataFrame:
    """One row per key plus what happened to it: ``resolve_variants`` of the distinct rows."""
    return resolve_variants(count_copies(df), key, compare_cols, order_col, write)


def resolve_variants(
    variants: DataFrame,
    key: str,
    compare_cols: Sequence[str] | None = None,
    order_col: str | None = None,
    write: Write | None = None,
) -> DataFrame:
    """One row per key of distinct rows with ``copies``, as ``count_copies`` returns them.

    The row kept is the smallest by ``order_col`` where given, then by all columns, so that a
    rerun keeps the same one. Added or changed columns: ``copies`` (input rows with the key),
    ``duplicated`` (these rows are not all identical) and ``conflict`` (they differ in
    ``compare_cols``; by default in any column). Rows that differ under a NULL key cannot be told
    to be the same entity and count as a conflict.

    Keys are counted by hash aggregation over numbers: variants, copies, and the extremes of a
    fingerprint (of 128 bits) of ``compare_cols``, which are equal if all variants agree. Only keys
    with several variants come out of it, mostly few, and only their rows are compared column by
    column; a window keeps one per key, and Spark applies it on the map side too, so a key with
    very many variants reaches its task as one row of each map task. All other rows pass by an
    anti join.

    ``write``, if given, stores the keys with several variants. They are then counted once for both
    joins, whose plans know how few they are: all rows stay where they are unless there are too
    many keys to broadcast.
    """
    rest = [c for c in variants.columns if c not in (key, COPIES)]
    extremes = []
    if compare_cols is not None:
        for place, mark in enumerate(fingerprint(compare_cols)):
            extremes += [F.min(mark).alias(f"low_{place}"), F.max(mark).alias(f"high_{place}")]
    keys = (
        variants.groupBy(F.col(key).alias("several_key"))
        .agg(F.count(F.lit(1)).alias("variants"), F.sum(COPIES).alias("all_copies"), *extremes)
        .where(F.col("variants") > 1)
    )
    differs = F.lit(True)
    if compare_cols is not None:
        differs = (F.col("low_0") != F.col("high_0")) | (F.col("low_1") != F.col("high_1"))
    keys = keys.select(
        "several_key", "all_copies", (differs | F.col("several_key").isNull()).alias(CONFLICT)
    )
    if write is not None:
        keys = write(keys)
    same = F.col(key).eqNullSafe(F.col("several_key"))
    single = variants.join(keys.select("several_key"), same, "left_anti").select(
        key, *rest, COPIES, F.lit(False).alias(DUPLICATED), F.lit(False).alias(CONFLICT)
    )
    order = [order_col] if order_col is not None else []
    first = Window.partitionBy(key).orderBy(*order, *(c for c in rest if c not in order))
    several = (
        variants.drop(COPIES)
        .join(keys, same)
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") == 1)
    )
    return single.unionAll(
        several.select(
            key, *rest, F.col("all_copies").alias(COPIES), F.lit(True).alias(DUPLICATED), CONFLICT
        )
    )


def rows_with_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The distinct rows of ``df`` whose key is in ``keys``, with their number of copies."""
    return count_copies(with_keys(df, keys, key))


def with_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key is in ``keys``; NULL is a key as well."""
    wanted = keys.select(F.col(key).alias("wanted_key"))
    return df.join(wanted, F.col(key).eqNullSafe(F.col("wanted_key")), "left_semi")


def quarantine_conflicts(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Split into keys with one distinct row, and all distinct rows of the other keys."""
    resolved = resolve_by_key(df, key)
    kept = resolved.where(~F.col(CONFLICT)).select(*df.columns)
    conflicts = rows_with_keys(df, resolved.where(CONFLICT), key).select(*df.columns)
    return kept, conflicts


def resolve_duplicates(
    df: DataFrame, key: str, compare_cols: Sequence[str], order_col: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Keep the first row of each key whose rows agree in ``compare_cols``; return the others.

    The second frame holds every distinct row of the keys that disagree.
    """
    resolved = resolve_by_key(df, key, compare_cols, order_col)
    kept = resolved.where(~F.col(CONFLICT)).select(*df.columns)
    conflicts = rows_with_keys(df, resolved.where(CONFLICT), key).select(*df.columns)
    return kept, conflicts
