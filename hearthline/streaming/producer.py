"""Feeding the event topic: one replay of stored certificates, then polling for new ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hearthline.schemas import CERTIFICATE, all_text
from hearthline.sources import incremental
from hearthline.sources.messages import normalise, publish, replay

KEY = "numero_dpe"


def backfill(
    spark: SparkSession,
    staging: str,
    checkpoint: str,
    options: dict[str, str],
    sink: str = "kafka",
    max_files: int = 100,
    interval: str | None = None,
) -> StreamingQuery:
    """Publish the staged certificates (CSV) as events, ``max_files`` files per trigger.

    The checkpoint remembers what was sent, so a second run publishes nothing.
    """
    stored = replay(
        spark, staging, all_text(CERTIFICATE.names), "csv", max_files=max_files, header=True
    )
    return publish(normalise(stored, None), options, KEY, sink, checkpoint, interval)


def poll(
    current: DataFrame,
    state: str,
    options: dict[str, str],
    sink: str = "kafka",
    limit: int = incremental.PAGE_ROWS,
) -> int:
    """One polling cycle over the live rows; returns how many events were published.

    The stored cursor goes back to the beginning of the last day sent: rows that arrive later
    on that day are still sent, and those sent again are dropped by the keyed table downstream.
    Only behind a full page of one single day it is the last row itself, so that a day with
    more rows than a page is sent page by page.
    """
    spark = current.sparkSession
    received = "date_reception_dpe"
    cursor = incremental.load_cursor(spark, state)
    page, found = incremental.bounded_page(current, received, KEY, cursor, limit)
    try:
        if found is None:
            return 0
        publish(normalise(None, page.drop("_received", "_key")), options, KEY, sink)
        day, key = found.last
        inside = found.rows >= limit and found.first_day == day
        incremental.save_cursor(spark, state, (day, key if inside else ""))
        return found.rows
    finally:
        page.unpersist()


def poll_to_end(
    current: DataFrame,
    state: str,
    options: dict[str, str],
    sink: str = "kafka",
    limit: int = incremental.PAGE_ROWS,
) -> int:
    """Polling cycles until no row is left; returns how many events were published."""
    total = 0
    while True:
        sent = poll(current, state, options, sink, limit)
        total += sent
        if sent < limit:
            return total
