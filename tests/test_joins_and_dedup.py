from pyspark.sql import functions as F

from conftest import plan_of
from hearthline.operators import dedup, joins


def communes(spark, codes=("a", "b", "c")):
    return spark.createDataFrame([(c, c.upper()) for c in codes], "code string, name string")


def test_lookup_keeps_unmatched_facts(spark, rows):
    facts = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, code string")
    found = joins.lookup(facts, communes(spark), "code").select("id", "name")
    assert rows(found) == [(1, "A"), (2, None), (3, None)]


def test_known_and_orphan_rows_are_complements(spark, rows):
    facts = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, code string")
    parent = communes(spark).withColumnRenamed("code", "insee")
    assert rows(joins.only_known(facts, parent, "code", "insee"), "id") == [(1,)]
    assert rows(joins.orphans(facts, parent, "code", "insee"), "id") == [(2,), (3,)]


def test_counts_per_key_do_not_multiply(spark, rows):
    left = spark.createDataFrame([("a",)] * 30 + [("b",)], "code string")
    right = spark.createDataFrame([("a",)] * 20, "code string")
    found = joins.counts_per_key(communes(spark), "code", {"l": left, "r": right})
    assert rows(found, "code", "l", "r") == [("a", 30, 20), ("b", 1, 0), ("c", 0, 0)]


def test_join_aggregates_drops_keys_missing_on_a_side(spark, rows):
    x = spark.createDataFrame([("a", 1), ("b", 2)], "code string, x int")
    y = spark.createDataFrame([("b", 3), ("c", 4)], "code string, y int")
    found = joins.join_aggregates("code", x, y, communes(spark))
    assert rows(found, "code", "x", "y", "name") == [("b", 2, 3, "B")]


def test_broadcast_only_below_the_measured_size(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    big = spark.range(10).select(F.col("id").cast("string").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = big.join(joins.broadcast_if_small(keys), "k", "left_semi")
        large = big.join(joins.broadcast_if_small(keys, max_bytes=100), "k", "left_semi")
        assert "BroadcastHashJoin" in plan_of(small)
        assert "BroadcastHashJoin" not in plan_of(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_and_last_follow_the_declared_order(spark, rows):
    data = [("k", i, f"v{i}") for i in (5, 1, 3)] + [("n", 2, "w"), (None, 9, "x"), (None, 8, "y")]
    for parts in (1, 3):
        df = spark.createDataFrame(data, "key string, ord int, val string").repartition(parts)
        first = dedup.keep_first(df, ["key"], ["ord"])
        last = dedup.keep_last(df, ["key"], ["ord"])
        assert rows(first) == [(None, 8, "y"), ("k", 1, "v1"), ("n", 2, "w")]
        assert rows(last) == [(None, 9, "x"), ("k", 5, "v5"), ("n", 2, "w")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(0, 30000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), "id"
    )
    picked = dedup.keep_last(hot, ["key"], ["id"])
    plan = plan_of(picked)
    # A group limit below the exchange and another above it.
    assert plan.count("WindowGroupLimit (") == 2
    assert picked.count() == 20001
    assert picked.where("key = 0").first()["id"] == 29997


def test_duplicate_count_treats_null_as_a_value(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert dedup.duplicate_count(df, ["k"]).first()[0] == 2
    assert dedup.duplicate_count(df.where("false"), ["k"]).first()[0] == 0
