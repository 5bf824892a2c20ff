from base_helpers import final_plan, rows
from pyspark.sql import functions as F

from tarmac.operators.references import distinct_keys, match_parent, split_orphans


def test_orphans_of_two_parents(spark):
    child = spark.createDataFrame(
        [(1, "f1", "p1"), (2, "f9", "p1"), (3, "f1", "p9"), (4, None, "p1"), (5, "f1", "p1")],
        "b int, f string, p string",
    )
    flights = spark.createDataFrame([("f1",), ("f1",), ("f2",), (None,)], "f string")
    people = spark.createDataFrame([("p1",)], "p string")
    kept, orphans = split_orphans(child, [(flights, "f"), (people, "p")])
    assert kept.columns == child.columns
    assert rows(kept, "b") == [(1,), (5,)]
    assert rows(orphans, "b") == [(2,), (3,), (4,)]


def test_parent_columns_are_carried(spark):
    child = spark.createDataFrame([(1, "f1"), (2, "f2")], "b int, f string")
    parent = spark.createDataFrame([("f1", "r1")], "f string, route string")
    out = match_parent(child, parent, "f", "found", ["route"])
    assert rows(out, "b", "route", "found") == [(1, "r1", True), (2, None, False)]


def test_a_hot_key_is_split(spark, conf):
    """A third of the children share one key: adaptive execution divides their partition."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.shuffle.partitions", "16")
    child = spark.range(0, 300000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    parent = child.where("k = 'hot' or payload < '8'").select("k")
    kept, orphans = split_orphans(child, [(parent, "k")])
    counted = kept.agg(F.count("payload"))
    assert "skew=true" in final_plan(counted)
    semi = child.join(distinct_keys(parent, "k"), "k", "left_semi").agg(F.count("payload"))
    assert "skew=true" in final_plan(semi)
    assert counted.collect() == semi.collect()
    assert counted.collect()[0][0] + orphans.count() == 300000
