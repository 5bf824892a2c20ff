"""Lenient time parsing, bounded overnight correction and date keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip


def parse_ts(df: DataFrame, *cols: str, formats: Sequence[str] = ()) -> DataFrame:
    """Turn the columns into zone-less timestamps; what cannot be read becomes NULL.

    ISO text is always understood; ``formats`` adds further datetime patterns, tried in order.
    """

    def parsed(name: str) -> Column:
        kind = df.schema[name].dataType.typeName()
        if kind == "timestamp_ntz":
            return F.col(name)
        if kind != "string":
            return F.col(name).cast("timestamp_ntz")
        text = strip(name)
        tries = [text.try_cast("timestamp_ntz")]
        tries += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
        return F.coalesce(*tries)

    return df.withColumns({c: parsed(c) for c in cols})


def duration_minutes(start: Column, end: Column) -> Column:
    """Fractional minutes from ``start`` to ``end`` on the clock, whatever the session's time zone.

    Taken from the interval between the two: a difference of timestamps would first place them
    in the time zone and be an hour off across a clock change.
    """
    gap = end - start

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), gap)

    minutes = (part("DAY").cast("long") * F.lit(24) + part("HOUR")) * F.lit(60) + part("MINUTE")
    micros = minutes * F.lit(60_000_000) + (part("SECOND") * F.lit(1_000_000)).cast("long")
    return micros / F.lit(6e7)


def overnight_rollover(
    df: DataFrame,
    dep: str,
    arr: str,
    bound: float,
    flag: str = "overnight_flag",
    adjusted: str = "adjusted_arrival_time",
) -> DataFrame:
    """Add ``flag`` (arrival before departure) and the ``adjusted`` arrival.

    A flagged arrival moves to the next day if that makes a duration of at most ``bound``
    minutes, else it is NULL. Other arrivals are kept whatever their duration. The flag is never
    NULL: a missing time on either side means not overnight.
    """
    start, end = F.col(dep), F.col(arr)
    next_day = end + F.expr("INTERVAL 1 DAY")
    overnight = F.coalesce(end < start, F.lit(False))
    return df.withColumns(
        {
            flag: overnight,
            adjusted: F.when(~overnight, end).when(
                duration_minutes(start, next_day) <= F.lit(bound), next_day
            ),
        }
    )


def date_key(c: Column) -> Column:
    """The date as a yyyyMMdd integer; 0 for NULL."""
    key = F.year(c) * F.lit(10000) + F.month(c) * F.lit(100) + F.day(c)
    return F.coalesce(key, F.lit(0)).cast("int")
