"""Deduplication by key with a declared order.

The first row of a key is taken by ``row_number() = 1``. Spark turns that filter into a
group limit that each task applies before the shuffle, so a key holding a third of the
table sends one row per task, not all of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _columns(order: list[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _take_one(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def keep_first(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """The row with the least ``order`` of each key; ``order`` must be total."""
    return _take_one(df, key, [c.asc() for c in _columns(order)])


def keep_last(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` of each key, such as the last arrival."""
    return _take_one(df, key, [c.desc() for c in _columns(order)])


def duplicate_count(df: DataFrame, key: list[str], name: str = "n_duplicates") -> DataFrame:
    """How many rows repeat a key already seen; NULL counts as a key like any other."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(name))
