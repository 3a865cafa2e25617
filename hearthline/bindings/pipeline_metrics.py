"""Pipeline metrics over events read as metric samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthline.bindings import tables as t
from hearthline.bindings.registry import instant, query, with_tables
from hearthline.operators import metrics
from hearthline.operators.dedup import keep_last
from hearthline.streaming.gate import enrich, gate_events
from hearthline.sources.messages import decode

# Each event is a sample of the counter named by its type; a smaller value is a reset.
_SAMPLES = """
SELECT event_id, ts, event_type, user_id, CAST(value AS DECIMAL(12,2)) AS reading FROM events"""
_GROWN = """
SELECT *, CASE WHEN previous IS NULL THEN 0 WHEN reading < previous THEN reading
               ELSE reading - previous END AS increase
FROM (SELECT *, lag(reading) OVER (PARTITION BY event_type ORDER BY ts, reading) AS previous
      FROM samples) s"""


def _samples(spark, sf_dir):
    return t.read(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type", "user_id",
        F.col("value").cast("decimal(12,2)").alias("reading"),
    )


@query("counter_increase", with_tables({"samples": _SAMPLES, "grown": _GROWN},
    ["samples", "grown"], "SELECT event_id, CAST(increase AS DOUBLE) AS increase FROM grown"))
def counter_increase(spark, sf_dir):
    grown = metrics.counter_increase(_samples(spark, sf_dir), ["event_type"], "ts", "reading")
    return grown.select("event_id", "increase")


@query("counter_rate", with_tables({"samples": _SAMPLES, "grown": _GROWN},
    ["samples", "grown"], f"""
SELECT event_type, {instant("date_trunc('minute', ts)", "window_start")},
       CAST(SUM(increase) AS DOUBLE) AS increase,
       ROUND(CAST(SUM(increase) AS DOUBLE) / 60, 9) AS rate
FROM grown GROUP BY event_type, date_trunc('minute', ts)"""))
def counter_rate(spark, sf_dir):
    rate = metrics.counter_rate(
        _samples(spark, sf_dir), ["event_type"], ["event_type"], "ts", "reading", 60
    )
    return rate.withColumn("rate", F.round("rate", 9))


@query("counter_by_label", with_tables({"samples": _SAMPLES}, ["samples"], """
SELECT event_type, CAST(SUM(reading) AS DOUBLE) AS total
FROM (SELECT event_type, user_id, arg_max(reading, ROW(ts, reading)) AS reading
      FROM samples GROUP BY event_type, user_id) s GROUP BY event_type"""))
def counter_by_label(spark, sf_dir):
    return metrics.counter_total(
        _samples(spark, sf_dir), ["event_type", "user_id"], ["event_type"], "ts", "reading"
    )


@query("latest_gauge", f"""
SELECT user_id, {instant("ts", "ts")}, up,
       CASE up WHEN 0 THEN 'DOWN' WHEN 1 THEN 'UP' END AS state
FROM (SELECT user_id, max(ts) AS ts, arg_max(up, ROW(ts, up)) AS up
      FROM (SELECT user_id, ts, event_id % 2 AS up FROM events) e GROUP BY user_id) g""")
def latest_gauge(spark, sf_dir):
    samples = t.read(spark, sf_dir, "events").withColumn("up", F.col("event_id") % 2)
    return metrics.latest_gauge(samples, ["user_id"], "ts", "up", {0: "DOWN", 1: "UP"})


@query("clean_raw_ratio", t.over(["gated"], """
SELECT COUNT(*) AS raw_records,
       COUNT(DISTINCT numero_dpe) FILTER (WHERE reject_reason IS NULL) AS clean_records,
       ROUND(COUNT(DISTINCT numero_dpe) FILTER (WHERE reject_reason IS NULL)
             / COUNT(*)::DOUBLE, 9) AS clean_ratio,
       TRUE AS raw_covers_clean
FROM gated"""))
def clean_raw_ratio(spark, sf_dir):
    raw = t.messages(spark, sf_dir)
    events = enrich(decode(raw), t.prices(spark, sf_dir))
    judged = gate_events(events, t.communes(spark, sf_dir)).where("reject_reason is null")
    clean = keep_last(
        judged.select("numero_dpe", "partition", "offset"), ["numero_dpe"],
        ["partition", "offset"],
    )
    ratio = metrics.clean_raw_ratio(raw, clean)
    return ratio.withColumn("clean_ratio", F.round("clean_ratio", 9))
