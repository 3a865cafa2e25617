import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline.operators import ordering


@pytest.mark.parametrize("partitions", [1, 5])
def test_dense_ids_number_a_skewed_table(spark, partitions):
    rng = random.Random(3)
    # A third of the rows share the leading order value.
    data = [(0 if i % 3 == 0 else rng.randrange(50), i) for i in range(900)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "a int, b int").repartition(7)
    got = ordering.with_dense_ids(df, ["a", "b"], "id", partitions).collect()
    want = {row: i + 1 for i, row in enumerate(sorted(data))}
    assert {(r["a"], r["b"]): r["id"] for r in got} == want


def test_dense_ids_of_nothing(spark):
    empty = spark.createDataFrame([], "a int")
    assert ordering.with_dense_ids(empty, ["a"], "id").count() == 0


@pytest.mark.parametrize("chunk", [1, 2, 7, 1000])
def test_previous_row_across_chunks(spark, chunk):
    rng = random.Random(5)
    data = [("hot" if i % 3 else f"k{rng.randrange(4)}", i, rng.random()) for i in range(120)]
    df = spark.createDataFrame(data, "k string, t int, v double").repartition(5)
    got = ordering.with_previous(df, ["k"], ["t"], {"v": "before"}, chunk_rows=chunk).collect()
    last, want = {}, {}
    for k, t, v in sorted(data, key=lambda r: r[1]):
        want[(k, t)] = last.get(k)
        last[k] = v
    assert {(r["k"], r["t"]): r["before"] for r in got} == want
    assert len(got) == len(data)


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.99, 1.0])
@pytest.mark.parametrize("buckets", [2, 16, 4096])
def test_exact_quantile_matches_brute_force(spark, fraction, buckets):
    rng = random.Random(11)
    values = [Decimal(rng.randrange(-10**9, 10**12)) / 10**6 for _ in range(300)]
    values += [Decimal("7.5")] * 150
    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,6)").repartition(3)
    got = ordering.exact_quantile(df, "v", fraction, buckets=buckets)
    assert got == pytest.approx(np.quantile([float(v) for v in values], fraction), abs=1e-6)


def test_quantile_ignores_nulls_and_empty_input(spark):
    df = spark.createDataFrame([(Decimal(1),), (None,), (Decimal(3),)], "v decimal(18,6)")
    assert ordering.exact_quantile(df, "v", 0.5) == 2.0
    assert ordering.exact_quantile(df.where("false"), "v", 0.5) is None


def test_quantile_refuses_what_it_cannot_hold_exactly(spark):
    df = spark.range(5).selectExpr("id", "cast(id as double) as x", "cast(id as decimal(30,2)) as d")
    assert ordering.exact_quantile(df, "id", 0.5) == 2.0
    for column in ("x", "d"):
        with pytest.raises(ValueError):
            ordering.exact_quantile(df, column, 0.5)


def test_top_k(spark):
    top = ordering.top_k(spark.range(100), 3, F.col("id").desc())
    assert [r[0] for r in top.collect()] == [99, 98, 97]


@pytest.mark.parametrize("rows", [
    [5] * 400, [*range(300)], [0] * 300 + [10**17], [-(10**17)] + [0] * 300,
    [10**k for k in range(17)] * 20, [k * k * k for k in range(-200, 200)],
])
def test_quantile_with_bounds_that_miss(spark, monkeypatch, rows):
    """Ties, one value and skew, also where a coarse sketch with no margin bounds the wrong rank."""
    df = spark.createDataFrame([(v,) for v in rows], "v long").repartition(3)
    for sketch, margin in ((1024, 0.005), (8, 0.0)):
        monkeypatch.setattr(ordering, "_SKETCH", sketch)
        monkeypatch.setattr(ordering, "_MARGIN", margin)
        for fraction in (0.01, 0.5, 0.9):
            at = fraction * (len(rows) - 1)
            low, high = sorted(rows)[int(at)], sorted(rows)[min(len(rows) - 1, int(at) + 1)]
            assert ordering.exact_quantile(df, "v", fraction, 16) == low + (high - low) * (at % 1)


def test_quantile_takes_two_passes_and_no_checkpoint(spark, monkeypatch):
    passes, plain = [], ordering.range_counts

    def counted(df, *more):
        passes.append(df)
        return plain(df, *more)

    monkeypatch.setattr(ordering, "range_counts", counted)
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", None)
    df = spark.range(100_000).selectExpr("cast(id % 7919 as decimal(12,2)) / 4 as v")
    df = df.selectExpr("cast(v as decimal(14,2)) as v")
    assert ordering.exact_quantile(df, "v", 0.9) is not None
    assert len(passes) == 1


@pytest.mark.parametrize("chunk", ["second", "minute", "day"])
def test_previous_in_time_across_chunks(spark, chunk):
    from conftest import plan_of

    rng = random.Random(5)
    data = [
        (rng.choice(["hot", "hot", "k1", "k2", None]), rng.randrange(400), rng.randrange(5))
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, "k string, t int, v int").withColumn(
        "at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("t"))
    )
    found = ordering.previous_in_time(df.repartition(5), ["k"], "at", ["v"], {"v": "before"}, chunk)
    got = [(r["k"], r["t"], r["v"], r["before"]) for r in found.collect()]
    last, want = {}, []
    for k, t, v in sorted(data, key=lambda r: r[1:]):
        want.append((k, t, v, last.get(k)))
        last[k] = v
    assert sorted(got, key=str) == sorted(want, key=str)
    # The samples are shuffled once; the edges reuse that shuffle.
    plan = plan_of(ordering.previous_in_time(df, ["k"], "at", ["v"], {"v": "before"}, chunk))
    assert "Checkpoint" not in plan and "Range" not in plan
