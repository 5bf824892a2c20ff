import hashlib
from datetime import datetime
from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from tarmac.functions import (
    date_key,
    duration_minutes,
    exact_sum,
    hash_text,
    lenient_number,
    masked_email,
    masked_tail,
    overnight_rollover,
    parse_ts,
    strip,
    surrogate_key,
)
from tarmac.functions.money import fitting


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression("v")).collect()]


def test_strip_removes_any_white_space(spark):
    assert apply(spark, [" a b ", "\t\na ", "　", None], strip) == ["a b", "a", "", None]


def test_email_masks(spark):
    given = ["a@b.com", "noat", None, "", "@x.com", "a@b@c", "a@", "@"]
    expected = ["a****@b.com", "****", "****", "****", "@****@x.com", "a****@b", "a****@", "@****@"]
    masked = apply(spark, given, masked_email)
    assert masked[:4] == expected[:4]
    assert masked[5:7] == expected[5:7]
    # Nothing before the '@': there is no first character to keep but the '@' itself.
    assert masked[4] == expected[4] and masked[7] == expected[7]


def test_tail_masks(spark):
    assert apply(spark, ["9876543210", "123", "", None], masked_tail) == [
        "987654****",
        "***",
        "",
        None,
    ]


def test_hashes(spark):
    assert apply(spark, ["A1", None], hash_text) == [hashlib.sha256(b"A1").hexdigest(), None]


def test_surrogate_keys_match_published_members(spark):
    df = spark.createDataFrame(
        [("SpiceJet", "CCU", "MAA"), ("x", None, "MAA")], "airline string, s string, d string"
    )
    got = df.select(surrogate_key("airline"), surrogate_key("s", "d")).collect()
    assert got[0][0] == "fe10005e6631d2c82bc640a5b707027e"
    assert got[0][1] == "edec40d16277592f865f6f96d12c6237"
    assert got[1][1] is None


def test_lenient_numbers(spark):
    valid = {"12.5": 12.5, " 7 ": 7.0, "1e3": 1000.0, "+5": 5.0, "-3": -3.0, ".5": 0.5, "5.": 5.0}
    assert apply(spark, list(valid), lenient_number) == list(valid.values())
    invalid = ["INVALID", "1,000", "", " ", "0x10", "1_0", "1d", "nan", "inf", "1e999", None]
    assert apply(spark, invalid, lenient_number) == [None] * len(invalid)


def test_timestamps_are_read_leniently(spark):
    df = spark.createDataFrame(
        [("2026-04-20 10:15:00",), (" 2026-04-20T10:15:00 ",), ("20/04/2026 10:15",), ("soon",), (None,)],
        "t string",
    )
    ten = datetime(2026, 4, 20, 10, 15)
    assert [r.t for r in parse_ts(df, "t").collect()] == [ten, ten, None, None, None]
    wide = parse_ts(df, "t", formats=["dd/MM/yyyy HH:mm"])
    assert [r.t for r in wide.collect()] == [ten, ten, ten, None, None]


def flights(spark, *times):
    df = spark.createDataFrame(list(times), "dep string, arr string")
    return parse_ts(df, "dep", "arr")


def timed(df):
    out = overnight_rollover(df, "dep", "arr", 480)
    minutes = duration_minutes(F.col("dep"), F.col("adjusted_arrival_time"))
    return [(r[0], r[1]) for r in out.select("overnight_flag", minutes).collect()]


def test_overnight_rollover(spark):
    df = flights(
        spark,
        ("2026-04-20 22:00:00", "2026-04-20 01:30:00"),
        ("2026-04-20 10:00:00", "2026-04-20 06:00:00"),
        ("2026-04-20 22:00:00", "2026-04-20 06:00:00"),
        ("2026-04-20 22:00:00", "2026-04-20 06:00:01"),
        ("2026-04-20 08:00:00", "2026-04-20 23:00:00"),
        (None, "2026-04-20 06:00:00"),
        ("2026-04-20 22:00:00", None),
    )
    assert timed(df) == [
        (True, 210.0),
        (True, None),
        (True, 480.0),
        (True, None),
        (False, 900.0),
        (False, None),
        (False, None),
    ]


def test_durations_are_fractional(spark):
    df = flights(spark, ("2026-04-20 22:00:00.9", "2026-04-20 22:01:00.1"))
    assert timed(df)[0][1] == pytest.approx(59.2 / 60)


def test_durations_ignore_clock_changes(spark, conf):
    conf("spark.sql.session.timeZone", "America/New_York")
    df = flights(
        spark,
        ("2026-03-08 01:00:00", "2026-03-08 03:30:00"),
        ("2026-03-08 22:00:00", "2026-03-08 02:30:00"),
        ("2026-03-07 22:00:00", "2026-03-07 02:30:00"),
    )
    assert timed(df) == [(False, 150.0), (True, 270.0), (True, 270.0)]


def test_date_keys(spark):
    df = flights(spark, ("2026-04-07 22:00:00", None))
    assert df.select(date_key(F.col("dep")), date_key(F.col("arr"))).collect()[0] == (20260407, 0)


def total(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(exact_sum(F.col("v"))).collect()[0][0]


def test_sums_of_money_do_not_depend_on_the_order(spark):
    amounts = [0.1, 0.2, 0.3, 1e9, 0.7, -1e9, 0.1] * 50
    assert reduce(add, amounts) != reduce(add, sorted(amounts))
    assert total(spark, amounts) == total(spark, sorted(amounts)) == 70.0
    assert total(spark, [0.1, None, 0.2]) == 0.3
    assert total(spark, [None, None]) is None and total(spark, []) is None
    # What the type of amounts cannot hold is no amount; parsing marks it.
    df = spark.createDataFrame([(1 / 3,), (0.000001,), (1e30,), (12.5,), (None,)], "x double")
    kept = [r[0] for r in df.select(fitting(F.col("x"))).collect()]
    assert kept == [None, 0.000001, None, 12.5, None]
