from base_helpers import final_plan, rows

from tarmac.operators.dedup import (
    count_copies,
    drop_exact_duplicates,
    quarantine_conflicts,
    resolve_by_key,
    resolve_duplicates,
    resolve_variants,
)


def test_exact_duplicates_treat_null_as_equal(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x")], "k string, v string")
    assert rows(drop_exact_duplicates(df)) == [("a", "x"), ("a", None)]
    assert rows(count_copies(df)) == [("a", "x", 1), ("a", None, 2)]


def test_conflicting_keys_lose_all_rows(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("b", 1), ("b", 2), ("b", 2), ("c", None), ("d", None), ("d", 3)],
        "k string, v int",
    )
    kept, conflicts = quarantine_conflicts(df, "k")
    assert rows(kept) == [("a", 1), ("c", None)]
    assert rows(conflicts) == [("b", 1), ("b", 2), ("d", 3), ("d", None)]


def test_copies_are_counted_per_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2)], "k string, v int")
    resolved = resolve_by_key(df, "k")
    assert rows(resolved, "k", "copies", "duplicated", "conflict") == [
        ("a", 2, False, False),
        ("b", 2, True, True),
    ]


PASSENGERS = "id string, age int, gender string, name string"


def test_selective_conflicts(spark):
    df = spark.createDataFrame(
        [
            ("same", 52, "F", "x"), ("same", 52, "F", "y"),
            ("age", 52, "F", "x"), ("age", 53, "F", "x"),
            ("null_age", None, "F", "x"), ("null_age", 52, "F", "x"),
            ("both_null", None, "F", "x"), ("both_null", None, "F", "y"),
            ("single", 1, "M", "z"),
        ],
        PASSENGERS,
    )
    kept, conflicts = resolve_duplicates(df, "id", ["age", "gender"])
    assert rows(kept) == [
        ("both_null", None, "F", "x"),
        ("same", 52, "F", "x"),
        ("single", 1, "M", "z"),
    ]
    assert rows(conflicts, "id") == [("age",), ("age",), ("null_age",), ("null_age",)]


def test_first_row_by_order_column(spark):
    df = spark.createDataFrame([("p", 9, "F", "late"), ("p", 3, "F", "early")], PASSENGERS)
    kept, _ = resolve_duplicates(df, "id", ["gender"], order_col="age")
    assert rows(kept, "name") == [("early",)]
    kept, _ = resolve_duplicates(df.withColumnRenamed("age", "line"), "id", ["gender"])
    assert rows(kept, "name") == [("early",)]


def test_different_rows_without_key_are_a_conflict(spark):
    df = spark.createDataFrame([(None, 5, "F", "x"), (None, 5, "F", "y"), ("p", 1, "M", "z")], PASSENGERS)
    kept, conflicts = resolve_duplicates(df, "id", ["age", "gender"])
    assert rows(kept, "id") == [("p",)]
    assert rows(conflicts, "name") == [("x",), ("y",)]


def test_a_frequent_key_is_combined_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id)) AS k", "if(id % 3 = 0, 1, id) AS v"
    )
    resolved = resolve_by_key(df, "k")
    plan = resolved._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_count" in plan
    assert rows(resolved.where("k = 'hot'"), "copies", "conflict") == [(10000, False)]
    assert resolved.count() == 20001


def test_a_key_of_very_many_variants_leaves_each_task_as_one_row(spark):
    df = spark.range(0, 30000, 1, 8).selectExpr(
        "if(id % 3 = 0, null, concat('k', id div 4)) AS k", "concat('v', id) AS v", "id % 2 AS w"
    )
    resolved = resolve_by_key(df, "k", ["w"])
    plan = final_plan(resolved)
    # The smallest row of a key is found before and after the shuffle; no row is compared whole in one place.
    assert "WindowGroupLimit" in plan and "Partial" in plan
    hot = resolved.where("k is null").collect()
    assert [(r.v, r.copies, r.duplicated, r.conflict) for r in hot] == [("v0", 10000, True, True)]
    pdf = df.where("k is not null").toPandas()
    groups = pdf.groupby("k")
    want = sorted(
        (k, g["v"].min(), len(g), len(g) > 1, g["w"].nunique() > 1) for k, g in groups
    )
    got = rows(resolved.where("k is not null"), "k", "v", "copies", "duplicated", "conflict")
    assert got == sorted(want, key=repr)


def test_fingerprints_tell_null_from_its_place_and_text(spark):
    df = spark.createDataFrame(
        [("k", None, "a"), ("k", "a", None), ("q", None, None), ("q", None, None), ("z", "", None), ("z", None, "")],
        "k string, x string, y string",
    )
    resolved = resolve_by_key(df, "k", ["x", "y"])
    assert rows(resolved, "k", "copies", "duplicated", "conflict") == [
        ("k", 2, True, True), ("q", 2, False, False), ("z", 2, True, True),
    ]


def test_keys_with_several_rows_are_stored_once_for_both_joins(spark, tmp_path):
    variants = spark.range(200).selectExpr(
        "if(id % 50 = 7, cast(null as string), concat('k', id - id % 40 % 2)) as k", "id as v", "1 + id % 3 as copies"
    )
    stored = []

    def write(keys):
        stored.append(keys)
        keys.write.parquet(f"{tmp_path}/{len(stored)}")
        return spark.read.parquet(f"{tmp_path}/{len(stored)}")

    kept = resolve_variants(variants, "k", write=write)
    assert rows(kept) == rows(resolve_variants(variants, "k"))
    assert len(stored) == 1
    # Few keys are sent to the rows: no row is moved but those of such keys.
    assert "SortMergeJoin" not in final_plan(kept) and "ENSURE_REQUIREMENTS" in final_plan(kept)
