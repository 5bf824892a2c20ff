"""Referential integrity between a child table and its parents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The distinct values of ``key``, laid out so that a join on it shuffles them once more.

    A join that found them already partitioned by ``key`` would read them in place, and adaptive
    execution splits a hot key of the other side only where both sides come from a shuffle made
    for the join. The keys are narrow, the other side is not.
    """
    hashed = df.select(key, F.xxhash64(key).alias("key_hash"))
    return hashed.distinct().select(key)


def match_parent(
    child: DataFrame, parent: DataFrame, key: str, found: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Add ``found`` (is the key in ``parent``?) and the parent columns named in ``carry``.

    ``parent`` must hold each key at most once, so no child row is multiplied. All skew is then on
    the child, the preserved side of a left join, whose large partitions adaptive execution
    splits. A NULL key is never found.
    """
    right = parent.select(key, *carry, F.lit(True).alias(found))
    return child.join(right, key, "left").withColumn(found, F.coalesce(found, F.lit(False)))


def split_orphans(
    child: DataFrame, parents: Sequence[tuple[DataFrame, str]]
) -> tuple[DataFrame, DataFrame]:
    """Split ``child`` into rows whose key is in every parent, and the orphans."""
    checked = child
    flags = []
    for i, (parent, key) in enumerate(parents):
        flag = f"has_parent_{i}"
        checked = match_parent(checked, distinct_keys(parent, key), key, flag)
        flags.append(F.col(flag))
    complete = flags[0]
    for flag in flags[1:]:
        complete = complete & flag
    return (
        checked.where(complete).select(*child.columns),
        checked.where(~complete).select(*child.columns),
    )
