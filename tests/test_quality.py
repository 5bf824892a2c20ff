import pytest
from base_helpers import rows
from pyspark.sql import functions as F

from tarmac.operators.privacy import allowlist, mask_email, mask_tail, pseudonymise, suppress
from tarmac.operators.quality import (
    derive_from_prefix,
    parse_amount,
    standardise_null,
    validate_key_format,
)
from tarmac.rules import AIRLINE_BY_PREFIX, FLIGHT_ID_PATTERN
from tarmac.schemas import SchemaError, conform, require_columns, require_types, RAW


def test_key_format(spark):
    good = ["AI101", " AI101 ", "6F250", "AI12", "AI1234"]
    bad = ["ai101", "AI1", "AI12345", "A-101", "", "  ", None, "AI101x"]
    df = spark.createDataFrame([(v,) for v in good + bad], "flight_id string")
    valid, invalid = validate_key_format(df, "flight_id", FLIGHT_ID_PATTERN)
    assert rows(valid) == sorted([(v,) for v in good], key=repr)
    assert rows(invalid) == sorted([(v,) for v in bad], key=repr)


def test_airline_from_prefix(spark):
    df = spark.createDataFrame(
        [("AI101", None), ("6F250", "UNKNOWN"), ("ZZ100", None), ("ZZ101", "UNKNOWN"), ("UK1", "Own")],
        "flight_id string, airline string",
    )
    out = derive_from_prefix(df, "flight_id", "airline", AIRLINE_BY_PREFIX)
    assert rows(out) == [
        ("6F250", "IndiGo", "DERIVED"),
        ("AI101", "Air India", "DERIVED"),
        ("UK1", "Own", "ORIGINAL"),
        ("ZZ100", None, "ORIGINAL"),
        ("ZZ101", "UNKNOWN", "ORIGINAL"),
    ]


def test_null_status(spark):
    df = spark.createDataFrame([(None,), ("INVALID",), ("OK",)], "status string")
    assert rows(standardise_null(df, "status", "UNKNOWN")) == [("INVALID",), ("OK",), ("UNKNOWN",)]


def test_amount_status(spark):
    df = spark.createDataFrame([("12.5",), ("INVALID",), ("",), (None,)], "amount string")
    assert rows(parse_amount(df, "amount")) == [
        ("", None, "MARKED_INVALID"),
        ("12.5", 12.5, "VALID"),
        ("INVALID", None, "MARKED_INVALID"),
        (None, None, None),
    ]


def test_amounts_may_already_be_numbers(spark):
    df = spark.createDataFrame([(12.5,), (1e10,), (None,)], "amount double")
    assert rows(parse_amount(df, "amount"), "amount_parsed", "amount_status") == [
        (10000000000.0, "VALID"), (12.5, "VALID"), (None, None)
    ]


def test_privacy(spark):
    df = spark.createDataFrame(
        [("p", "A1", "a@b.com", "9876543210", "d")],
        "id string, aadhaar_id string, email string, phone string, dob string",
    )
    out = suppress(mask_tail(mask_email(pseudonymise(df, ["aadhaar_id"])), ["phone"]), ["dob", "absent"])
    row = out.collect()[0].asDict()
    assert list(row) == ["id", "aadhaar_id", "email", "phone"]
    assert len(row["aadhaar_id"]) == 64 and row["email"] == "a****@b.com"
    assert row["phone"] == "987654****"
    assert allowlist(out, ["id"]).columns == ["id"]


def test_required_columns(spark):
    frames = {n: spark.createDataFrame([], s) for n, s in RAW.items()}
    assert require_columns(frames) is frames
    frames["payments"] = frames["payments"].drop("amount", "booking_id").withColumn("extra", F.lit(1))
    with pytest.raises(SchemaError, match=r"payments missing \['booking_id', 'amount'\]"):
        require_columns(frames)
    del frames["flights"]
    with pytest.raises(SchemaError, match="flights"):
        require_columns(frames)


def test_conform_casts_leniently(spark):
    df = spark.createDataFrame([("7", "x"), ("8.0", "z"), ("seven", "y")], "age string, other string")
    out = conform(df, RAW["passengers"])
    assert rows(out) == [(7, "x"), (8, "z"), (None, "y")]
    with pytest.raises(SchemaError, match="age"):
        require_types(df, "passengers", RAW["passengers"])


def test_amounts_are_parsed_once(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("x",), (None,), ("1e400",), ("9" * 30,)], "amount string")
    parsed = parse_amount(df, "amount")
    assert rows(parsed, "amount_parsed", "amount_status") == sorted(
        [(1.5, "VALID"), (2.0, "VALID"), *[(None, "MARKED_INVALID")] * 3, (None, None)], key=repr
    )
    text = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("RLIKE") == 1 and text.count("trim(") == 1
