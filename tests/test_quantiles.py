import re

import numpy as np
import pandas as pd
import pytest
from base_helpers import final_plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.operators.quantiles import (
    PART,
    box_stats,
    flag_above,
    frequencies,
    in_ranges,
    iqr_upper_bounds,
    quantiles,
)

PROBS = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def by_group(df, by=("g",)):
    by = list(by)
    return quantiles(in_ranges(frequencies(df, by, "v"), by, "v"), by, "v", PROBS)


def exact(spark, values):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    row = by_group(df).collect()[0]
    return [row[name] for name in PROBS]


def test_linear_interpolation(spark):
    values = [60.0, 70.0, 80.0, None, 500.0]
    assert exact(spark, values) == [67.5, 75.0, 185.0]


def test_outliers_are_strictly_above_the_upper_bound(spark):
    df = spark.createDataFrame(
        [("A", "B", v) for v in (60.0, 70.0, 80.0, None, 500.0)]
        + [("A", "C", 5.0), ("A", "C", 5.0), (None, "C", 900.0), ("A", "D", None)],
        "source string, destination string, d double",
    )
    bounds = iqr_upper_bounds(df, ["source", "destination"], "d")
    assert rows(bounds) == [("A", "B", 361.25), ("A", "C", 5.0)]
    flagged = flag_above(df, bounds, ["source", "destination"], "d")
    assert flagged.columns == ["source", "destination", "d", "is_statistical_outlier"]
    assert rows(flagged.where("is_statistical_outlier"), "d") == [(500.0,)]
    assert flagged.where("is_statistical_outlier IS NULL").count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e4, 1e4, allow_subnormal=False), min_size=1, max_size=40))
def test_quantiles_equal_numpy(spark, values):
    expected = np.quantile(values, list(PROBS.values()))
    assert exact(spark, values) == pytest.approx(expected, rel=1e-9, abs=1e-9)


#: A million values, none twice: all within one unit, and over 600 powers of ten on both sides of 0.
MILLION = {
    "in [0, 1)": "cast(id as double) / 1000000",
    "wide": "if(id % 2 = 0, 1, -1) * pow(10.0D, id / 1000000.0D * 600 - 300)",
}


@pytest.mark.parametrize("name", MILLION)
def test_no_task_sees_more_than_a_share_of_a_large_group(spark, conf, name):
    """One group has all but a few rows; no range has more than twice the even share of values."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(0, 1_000_000, 1, 8).selectExpr(
        "if(id % 100000 = 7, concat('g', id), 'hot') AS g", f"{MILLION[name]} AS v"
    )
    ranges = in_ranges(frequencies(df, ["g"], "v"), ["g"], "v")
    sizes = [r["count"] for r in ranges.groupBy(PART).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / 8
    found = quantiles(ranges, ["g"], "v", PROBS)
    got = found.where("g = 'hot'").first()
    values = df.where("g = 'hot'").toPandas()["v"].to_numpy()
    assert np.allclose([got[p] for p in PROBS], np.quantile(values, list(PROBS.values())), rtol=1e-9)
    plan = final_plan(found)
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\]", plan)
    # Over rows of values a window is bounded by a partition of ranges.
    assert any("part" in w for w in windows)


def test_any_number_of_partitions_gives_the_same(spark, conf):
    df = spark.range(0, 3000, 1, 4).selectExpr("id % 3 AS g", "cast(id * 7919 % 1009 AS double) AS v")
    want = rows(by_group(df))
    for partitions in ("1", "3", "64"):
        conf("spark.sql.shuffle.partitions", partitions)
        conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert rows(by_group(df)) == want


def test_hot_group_equals_pandas(spark):
    """One group has a third of the rows, with a different value in almost each of them."""
    df = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("g"),
        ((F.col("id") * 7919 % 104729) / F.lit(211.0)).alias("v"),
    )
    got = by_group(df).toPandas().set_index("g").sort_index()
    want = df.toPandas().groupby("g")["v"].quantile(list(PROBS.values())).unstack()
    assert np.allclose(got[list(PROBS)].to_numpy(), want.to_numpy(), rtol=1e-12)


def test_box(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 100.0, -50.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 3.0), ("b", None)], "g string, v double")
    a, b = (r.asDict() for r in box_stats(frequencies(df, ["g"], "v"), "g", "v").collect())
    s = pd.Series(values)
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    assert (a["q1"], a["median"], a["q3"]) == (q1, s.median(), q3)
    inside = s[(s >= q1 - 1.5 * (q3 - q1)) & (s <= q3 + 1.5 * (q3 - q1))]
    assert (a["minimum"], a["maximum"], a["n"]) == (-50.0, 100.0, 11)
    assert (a["lower_fence"], a["upper_fence"]) == (inside.min(), inside.max())
    assert a["outliers"] == len(s) - len(inside)
    assert (b["n"], b["q1"], b["median"], b["q3"], b["outliers"]) == (1, 3.0, 3.0, 3.0, 0)
