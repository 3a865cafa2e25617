"""Lookups, key checks and joins that cannot multiply rows.

Lookups carry no broadcast hint: Spark broadcasts a table it knows to be under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, splitting skewed
partitions. ``broadcast_if_small`` is for computed key sets, whose size Spark overestimates;
it measures them first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


KEY_SET_BYTES = 64 * 1024 * 1024


def row_bytes(*columns: str) -> Column:
    """About the size of a row of these columns."""
    size = F.lit(0)
    for column in columns:
        size = size + 8 + F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0))
    return size


def broadcast_if_small(df: DataFrame, max_bytes: int = KEY_SET_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its measured size allows, else unchanged.

    Runs one aggregation over ``df``; persist it first if it is costly to compute.
    """
    measured = df.agg(F.coalesce(F.sum(row_bytes(*df.columns)), F.lit(0))).first()[0]
    return F.broadcast(df) if measured <= max_bytes else df


def lookup(facts: DataFrame, reference: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join to a table unique on ``on``; facts without a match get NULLs."""
    return facts.join(reference, on, "left")


def only_known(
    df: DataFrame, reference: DataFrame, key: str, reference_key: str | None = None
) -> DataFrame:
    """Rows whose ``key`` exists in the reference table."""
    known = reference.select(F.col(reference_key or key).alias(key))
    return df.join(known, key, "left_semi")


def orphans(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None
) -> DataFrame:
    """Rows whose ``key`` is absent from the parent; a NULL key has no parent."""
    parents = parent.select(F.col(parent_key or key).alias(key))
    return child.join(parents, key, "left_anti")


def counts_per_key(
    dimension: DataFrame, key: str, facts: dict[str, DataFrame]
) -> DataFrame:
    """The dimension with one count column per fact table, 0 where there is none.

    Each fact is counted by key before the join, so facts never multiply each other.
    """
    result = dimension
    for name, fact in facts.items():
        counted = fact.groupBy(key).agg(F.count(F.lit(1)).alias(name))
        result = result.join(counted, key, "left")
    return result.fillna(0, subset=list(facts))


def join_aggregates(key: str | list[str], *aggregates: DataFrame) -> DataFrame:
    """Inner join of tables already aggregated to ``key``."""
    return reduce(lambda left, right: left.join(right, key), aggregates)
