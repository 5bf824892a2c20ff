"""Exact per-group quantiles, and the outlier, box and histogram figures built on them.

``percentile`` keeps all distinct values of a group in one aggregation buffer, and a running sum
over a group puts them into one task. Here a group may hold a large share of all rows and its
values may be continuous, so a running sum over ranges takes their place: equal values are counted
first, the counts are dealt by ranges of (group, value) to partitions of equal size, whatever the
distribution, and written once; sums of whole partitions tell which of them hold a wanted rank,
and single values are looked at in these only. No task sees more than one partition's values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import scratch

#: Which partition of (group, value) ranges a row is in.
PART = "part"
Write = Callable[[DataFrame], DataFrame]


def frequencies(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """How often (``n``) each value occurs in each group; NULL is a group, but no value.

    Small enough to keep where values repeat: quantiles, box and histogram come from it.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value)
    return counted.agg(F.count(F.lit(1)).alias("n"))


def in_ranges(
    freq: DataFrame, by: Sequence[str], value: str, write: Write = scratch
) -> DataFrame:
    """A ``frequencies`` table of complete groups in partitions of consecutive (group, value).

    ``write`` must store the rows: ranges are drawn from a sample, so the partition numbers of a
    second evaluation would be others. A partition has about the advisory size of adaptive
    execution, and a row belongs to one (group, value), so none is much larger than the rest.
    """
    complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in by])
    dealt = freq.where(complete).repartitionByRange(*by, value)
    return write(dealt.withColumn(PART, F.spark_partition_id()).sortWithinPartitions(*by, value))


def quantiles(
    ranges: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Linearly interpolated quantiles of an ``in_ranges`` table: one column per name in ``probs``.

    The windows see (a) one row for each partition that a group is in, and (b) the values of a
    group in one partition, of the few partitions that hold a wanted rank.
    """
    by = list(by)
    group = Window.partitionBy(*by)
    upwards = group.orderBy(PART).rowsBetween(Window.unboundedPreceding, 0)
    parts = (
        ranges.groupBy(*by, PART)
        .agg(F.sum("n").alias("part_n"))
        .select(
            *by,
            PART,
            (F.sum("part_n").over(upwards) - F.col("part_n")).alias("rank_from"),
            F.sum("part_n").over(upwards).alias("rank_to"),
            F.sum("part_n").over(group).alias("total"),
        )
    )

    def position(p: float) -> Column:
        return F.lit(p) * (F.col("total") - F.lit(1))

    def holds(rank: Column) -> Column:
        return (rank >= F.col("rank_from")) & (rank < F.col("rank_to"))

    wanted = [f(position(p)) for p in probs.values() for f in (F.floor, F.ceil)]
    hits = parts.where(reduce(Column.__or__, map(holds, wanted))).select(
        *by, PART, F.col("rank_from").alias("part_from"), "total"
    )

    within = (
        Window.partitionBy(*by, PART).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    )
    seen = F.col("part_from") + F.sum("n").over(within)
    values = ranges.join(hits, [*by, PART]).select(
        *by, value, "total", (seen - F.col("n")).alias("rank_from"), seen.alias("rank_to")
    )
    picked = []
    for name, p in probs.items():
        for end, f in (("low", F.floor), ("high", F.ceil)):
            picked.append(F.max(F.when(holds(f(position(p))), F.col(value))).alias(f"{name}_{end}"))
    ends = values.groupBy(*by).agg(F.max("total").alias("total"), *picked)
    return ends.select(
        *by,
        *[
            (
                F.col(f"{name}_low")
                + (F.col(f"{name}_high") - F.col(f"{name}_low"))
                * (position(p) - F.floor(position(p)))
            ).alias(name)
            for name, p in probs.items()
        ],
    )


def iqr_upper_bounds(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    k: float = 1.5,
    bound: str = "upper_bound",
    write: Write = scratch,
) -> DataFrame:
    """Q3 + k * (Q3 - Q1) of ``value`` in each group."""
    ranges = in_ranges(frequencies(df, by, value), by, value, write)
    q = quantiles(ranges, by, value, {"q1": 0.25, "q3": 0.75})
    return q.select(
        *by, (F.col("q3") + F.lit(k) * (F.col("q3") - F.col("q1"))).alias(bound)
    )


def flag_above(
    df: DataFrame,
    bounds: DataFrame,
    by: Sequence[str],
    value: str,
    bound: str = "upper_bound",
    flag: str = "is_statistical_outlier",
) -> DataFrame:
    """Flag rows strictly above their group's bound; no group or no value means False.

    One join instead of a window over the group: a frequent group is spread over all tasks.
    """
    joined = df.join(bounds, list(by), "left")
    above = F.coalesce(F.col(value) > F.col(bound), F.lit(False))
    return joined.withColumn(flag, above).drop(bound)


def box_stats(
    freq: DataFrame, by: str, value: str, k: float = 1.5, write: Write = scratch
) -> DataFrame:
    """Minimum, quartiles, maximum, fences and number of outliers per group of ``frequencies``.

    The fences are the extreme values still within ``k`` times the interquartile range of the box.
    """
    ranges = in_ranges(freq, [by], value, write)
    boxes = quantiles(ranges, [by], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    v = F.col(value)
    reach = F.lit(k) * (F.col("q3") - F.col("q1"))
    above_lower = v >= F.col("q1") - reach
    below_upper = v <= F.col("q3") + reach
    return (
        ranges.join(boxes, by)
        .groupBy(by)
        .agg(
            F.sum("n").alias("n"),
            F.min(v).alias("minimum"),
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.max(v).alias("maximum"),
            F.min(F.when(above_lower, v)).alias("lower_fence"),
            F.max(F.when(below_upper, v)).alias("upper_fence"),
            F.sum(F.when(above_lower & below_upper, 0).otherwise(F.col("n"))).alias("outliers"),
        )
        .orderBy(by)
    )


def histogram(freq: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """Non-empty ones of ``bins`` equal-width bins between the smallest and the largest value.

    The rows behind are those of a ``frequencies`` table, of one or all of its groups; any number of
    bins is summed from the same counts.
    """
    counts = freq.groupBy(value).agg(F.sum("n").alias("n"))
    extremes = counts.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    low, high = extremes.getField("low"), extremes.getField("high")
    width = (high - low) / F.lit(bins)
    place = F.floor(F.coalesce(F.try_divide(F.col(value) - low, width), F.lit(0.0)))
    binned = counts.groupBy(F.least(place, F.lit(bins - 1)).alias("bin")).agg(F.sum("n").alias("n"))
    return binned.select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + F.lit(1)) * width).alias("bin_end"),
        "n",
    ).orderBy("bin")
