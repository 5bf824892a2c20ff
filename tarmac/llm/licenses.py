"""Licence scan by ordered signature rules, in DataFrame functions only.

A text becomes its words: A-Z lower-cased, words of ASCII letters, digits and anything beyond
ASCII, joined by single blanks. Texts without any gate word are done; in the others each rule
whose keyword occurs is matched. A detection that lies within one of smaller priority number, or
of the same number and greater length, is suppressed (of equal ones the first rule stays). Base
phrases are rules too: all their places count, and their labels stay though suppressed.

All rules sit in one array literal and every step is an expression on the row: no shuffle, and no
state that grows with the table. Null and empty text has no words, no detection and score 0. Each
input row gives one row, repeated and null ids included. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.license_rules import GATES, RULES, WHOLE_GATES, Rule
from tarmac.llm.shared import text_column

_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPAN = "struct<rule: int, label: string, priority: int, confidence: double, base: boolean, first: int, last: int>"
#: Mark the first and the last word of a match; no word holds them.
_HEAD, _TAIL = "\x01", "\x02"


def rule_array(rules: tuple[Rule, ...]) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(r.id).alias("rule"),
                F.lit(r.label).alias("label"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.confidence).alias("confidence"),
                F.lit(r.base).alias("base"),
                F.lit(f" {r.keyword}").alias("keyword"),
                F.lit(f" ({r.signature})(?= )").alias("signature"),
            )
            for r in rules
        )
    )


def _spans(words: Column, rule: Column) -> Column:
    """The places of a rule: its first word and the word after its last, counted from 0."""
    marked = F.split(
        F.regexp_replace(words, rule["signature"], F.lit(f" {_HEAD}$1{_TAIL}")), F.lit(" ")
    )
    # The text starts with a blank, so word i is element i + 1.
    heads = F.filter(F.transform(marked, lambda w, i: F.when(w.startswith(_HEAD), i - 1)), lambda i: i.isNotNull())
    tails = F.filter(F.transform(marked, lambda w, i: F.when(w.endswith(_TAIL), i)), lambda i: i.isNotNull())
    return F.zip_with(
        heads,
        tails,
        lambda a, b: F.struct(
            rule["rule"].alias("rule"),
            rule["label"].alias("label"),
            rule["priority"].alias("priority"),
            rule["confidence"].alias("confidence"),
            rule["base"].alias("base"),
            a.alias("first"),
            b.alias("last"),
        ),
    )


def _suppressed(found: Column, x: Column) -> Column:
    size = x["last"] - x["first"]
    return F.exists(
        found,
        lambda y: (y["first"] <= x["first"])
        & (y["last"] >= x["last"])
        & (
            (y["priority"] < x["priority"])
            | (
                (y["priority"] == x["priority"])
                & (
                    (y["last"] - y["first"] > size)
                    | ((y["last"] - y["first"] == size) & (y["rule"] < x["rule"]))
                )
            )
        ),
    )


def scan(
    documents: DataFrame, keep: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``keep`` columns with n_words, all base places, and the detections that stay.

    ``base_places`` and ``detections`` are arrays with rule, label, confidence, first and last
    (the word after).
    """
    gate = f"(?i)(?<!{_WORD})(?:{'|'.join(GATES)}|(?:{'|'.join(WHOLE_GATES)})(?!{_WORD}))"
    rows = documents.select(*keep, text_column(documents, text).alias("__text"))
    rows = rows.withColumn("n_words", F.regexp_count("__text", F.lit(f"{_WORD}+")).cast("long"))
    lowered = F.translate("__text", _UPPER, _LOWER)
    spaced = F.regexp_replace(lowered, r"[^0-9a-z\x{80}-\x{10FFFF}]+", " ")
    words = F.when(
        F.col("__text").rlike(gate), F.concat(F.lit(" "), F.trim(spaced), F.lit(" "))
    )
    rows = rows.withColumn("__words", words).drop("__text")
    matching = F.filter(
        rule_array(rules),
        lambda r: F.contains(F.col("__words"), r["keyword"])
        & F.regexp_like(F.col("__words"), r["signature"]),
    )
    found = F.flatten(F.transform(matching, lambda r: _spans(F.col("__words"), r)))
    none = F.expr(f"cast(array() as array<{_SPAN}>)")
    rows = rows.withColumn(
        "__found", F.when(F.col("__words").isNotNull(), F.coalesce(found, none)).otherwise(none)
    )
    return rows.select(
        *keep,
        "n_words",
        F.filter("__found", lambda x: x["base"]).alias("base_places"),
        F.filter("__found", lambda x: ~_suppressed(F.col("__found"), x)).alias("detections"),
    )


def summary(scanned: DataFrame) -> DataFrame:
    """Adds n_base, first_word, last_word, base_labels, labels and score to what ``scan`` returns.

    The score is the noisy-or of the confidences of the labels that stay.
    """
    places = F.transform("base_places", lambda x: x["first"].cast("long"))
    base = F.array_sort(F.array_distinct(F.transform("base_places", lambda x: x["label"])))
    own = F.transform("detections", lambda x: x["label"])
    every = F.array_sort(F.array_distinct(F.concat(base, own)))
    doubt = F.aggregate(
        F.array_distinct(
            F.transform("detections", lambda x: F.struct(x["label"], x["confidence"].alias("c")))
        ),
        F.lit(1.0),
        lambda rest, x: rest * (1 - x["c"]),
    )
    return (
        scanned.withColumn("n_base", F.size("base_places").cast("long"))
        .withColumn("first_word", F.array_min(places))
        .withColumn("last_word", F.array_max(places))
        .withColumn("base_labels", F.concat_ws(",", base))
        .withColumn("labels", F.concat_ws(",", every))
        .withColumn("score", 1 - doubt)
    )
