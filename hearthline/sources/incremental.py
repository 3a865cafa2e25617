"""Incremental pull behind a high watermark."""

from __future__ import annotations

import os
from bisect import bisect_right
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.operators.ordering import entry_at, range_counts
from hearthline.schemas import BIG, TEXT, struct
from hearthline.sources.tables import read_table

PAGE_ROWS = 1000
WATERMARK = struct(watermark=TEXT)
CURSOR = struct(turn=BIG, received=TEXT, key=TEXT)


def pull_since(
    df: DataFrame, ts: str, since, tie_break: list[str], limit: int = PAGE_ROWS
) -> DataFrame:
    """The next page in ascending order; rows at the watermark itself come again.

    The page size is part of the polling contract. When more rows share one instant than
    fit a page, use ``pull_after``, whose cursor also holds the tie-break.
    """
    fresh = df if since is None else df.where(F.col(ts) >= F.lit(since))
    return fresh.orderBy(F.col(ts).asc_nulls_last(), *tie_break).limit(limit)


def pull_after(
    df: DataFrame, order: list[str], cursor: tuple | None, limit: int = PAGE_ROWS
) -> DataFrame:
    """The next page strictly after a full cursor, so ties cannot stall the pull."""
    fresh = df
    if cursor is not None:
        beyond = F.struct(*order) > F.struct(*[F.lit(v).alias(c) for c, v in zip(order, cursor)])
        fresh = df.where(beyond)
    return fresh.orderBy(*order).limit(limit)


def next_watermark(page: DataFrame, ts: str) -> DataFrame:
    """Greatest non-empty timestamp of a page; NULL when the page is empty."""
    value = F.col(ts).cast("string")
    return page.where(F.length(value) > 0).agg(F.max(value).alias("watermark"))


def load_watermark(spark: SparkSession, path: str) -> str | None:
    stored = read_table(spark, path, WATERMARK)
    return stored.agg(F.max("watermark")).first()[0]


def save_watermark(page: DataFrame, ts: str, path: str) -> None:
    """Record the page's watermark; nothing is stored for an empty page."""
    mark = next_watermark(page, ts).where("watermark is not null")
    mark.coalesce(1).write.mode("append").parquet(path)


def with_cursor(df: DataFrame, ts: str, key: str) -> DataFrame:
    """Append ``received`` and ``key`` as text; an unknown one is empty and so comes first."""
    return df.withColumns({
        "_received": F.coalesce(F.col(ts).cast("string"), F.lit("")),
        "_key": F.coalesce(F.col(key).cast("string"), F.lit("")),
    })


#: Lies before every character of a timestamp or key, so that joined texts sort like pairs.
_MARK = "\x01"
_DIGITS = 6


def _joined() -> Column:
    return F.concat("_received", F.lit(_MARK), "_key")


def _after(df: DataFrame, cursor: tuple[str, str] | None) -> DataFrame:
    return df if cursor is None else df.where(_joined() > F.lit(_MARK.join(cursor)))


class PageBounds(NamedTuple):
    """Rows of the next page, the day of the first one, (received, key) of the last one, and
    whether no row is left behind it."""

    rows: int
    first_day: str
    last: tuple[str, str]
    ends: bool


def page_bounds(rows: DataFrame, limit: int, buckets: int = 4096) -> PageBounds | None:
    """Bounds of the first ``limit`` rows and those that repeat the last one's values.

    Texts are read as numbers, ``_DIGITS`` bytes behind what the least and the greatest have in
    common. Each pass counts ``buckets`` equal ranges of these numbers and goes on with the one
    that holds the wanted row, until it holds one text, or few enough rows to look at each.
    None where there are no rows.
    """
    texts, skipped, first_day = rows.select(_joined().alias("_at")), 0, None
    while True:
        found = texts.agg(
            F.count(F.lit(1)).alias("n"), F.min("_at").alias("lo"), F.max("_at").alias("hi")
        ).first()
        if not found["n"]:
            return None
        if first_day is None:
            total, first_day = found["n"], _split(found["lo"])[0]
            limit = min(limit, total)
        if found["lo"] == found["hi"] or skipped + found["n"] == limit:
            last, n = found["hi"], skipped + found["n"]
            break
        low, high = found["lo"].encode(), found["hi"].encode()
        common = len(os.path.commonprefix([low, high]))

        def number(value: bytes) -> int:
            return int.from_bytes(value[common : common + _DIGITS].ljust(_DIGITS, b"\0"))

        behind = F.substring(F.col("_at").cast("binary"), common + 1, _DIGITS)
        digits = F.conv(F.rpad(F.hex(behind), 2 * _DIGITS, "0"), 16, 10).cast("long")
        numbered = texts.select("_at", digits.alias("_digits"))
        at = F.col("_digits")
        entries = range_counts(numbered, at, at, number(low), number(high), buckets)
        i, before = entry_at(entries, limit - 1 - skipped)
        skipped += before
        texts = numbered.where(at.between(entries[i]["lo"], entries[i]["hi"])).select("_at")
        if entries[i]["n"] <= PAGE_ROWS:
            # Few rows, whatever the size of the table. UTF-8 sorts like code points.
            held = sorted(r["_at"] for r in texts.collect())
            last = held[limit - 1 - skipped]
            n = skipped + bisect_right(held, last)
            break
    return PageBounds(n, first_day, _split(last), n == total)


def _split(text: str) -> tuple[str, str]:
    day, key = text.split(_MARK, 1)
    return day, key


def page_end(rows: DataFrame, limit: int, buckets: int = 4096) -> tuple[str, str] | None:
    """(received, key) of the row at ``limit`` in their order; None where no more rows are left."""
    found = page_bounds(rows, limit, buckets)
    return None if found is None or found.rows <= limit and found.ends else found.last


def bounded_page(
    df: DataFrame, ts: str, key: str, cursor: tuple[str, str] | None, limit: int = PAGE_ROWS
) -> tuple[DataFrame, PageBounds | None]:
    """The next page as ``next_page`` gives it, with its bounds; None for an empty one.

    A page of up to ``PAGE_ROWS`` rows is held in memory until its caller unpersists it.
    """
    fresh = _after(with_cursor(df, ts, key), cursor)
    if limit > PAGE_ROWS:
        found = page_bounds(fresh, limit)
        if found is None or found.ends:
            return fresh, found
        return fresh.where(_joined() <= F.lit(_MARK.join(found.last))), found
    page = fresh.orderBy("_received", "_key").limit(limit).persist()
    found = page.agg(
        F.count(F.lit(1)).alias("n"), F.min("_received").alias("first_day"),
        F.max(F.struct("_received", "_key")).alias("last"),
    ).first()
    if not found["n"]:
        return page, None
    return page, PageBounds(
        found["n"], found["first_day"], tuple(found["last"]), found["n"] < limit
    )


def next_page(
    df: DataFrame, ts: str, key: str, cursor: tuple[str, str] | None, limit: int = PAGE_ROWS
) -> DataFrame:
    """The next page after a stored cursor, in order of (timestamp, key), undated rows first.

    However many rows share one day, each page goes on behind the last one. A page ends with a
    whole key: rows that repeat the last one's values come along. Pages of up to ``PAGE_ROWS`` rows
    are the first ones of a sort; for larger ones the last row is found by counting, and the page
    is a range filter on the table.
    """
    if limit <= PAGE_ROWS:
        fresh = _after(with_cursor(df, ts, key), cursor)
        return fresh.orderBy("_received", "_key").limit(limit)
    return bounded_page(df, ts, key, cursor, limit)[0]


def load_cursor(spark: SparkSession, path: str) -> tuple[str, str] | None:
    stored = read_table(spark, path, CURSOR)
    last = stored.agg(F.max(F.struct(*CURSOR.names)).alias("last")).first()["last"]
    return None if last is None else (last["received"], last["key"])


def save_cursor(spark: SparkSession, path: str, cursor: tuple[str, str]) -> None:
    """Record how far the pull has come; the last record counts."""
    turns = read_table(spark, path, CURSOR).agg(F.coalesce(F.max("turn"), F.lit(0))).first()[0]
    row = spark.range(1).select(
        F.lit(turns + 1).cast("bigint").alias("turn"),
        F.lit(cursor[0]).alias("received"),
        F.lit(cursor[1]).alias("key"),
    )
    row.coalesce(1).write.mode("append").parquet(path)
