"""Run operators on a table whose hottest key holds a third of all rows.

Prints, per operator, the largest share of one stage's shuffled rows that a single task
read. Task figures come from Spark's event log, written to a scratch folder.

    python tools/skew.py [rows]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from hearthline import build_session, scratch_path  # noqa: E402
from hearthline.operators import (  # noqa: E402
    corrections,
    dedup,
    joins,
    metrics,
    ordering,
    pricing,
    quality,
)
from hearthline.sources import keyed_table  # noqa: E402

WORTH_A_LOOK = 100_000


def operators(table, parents):
    """Name to a function that computes the operator's whole result."""

    def force(df):
        df.write.format("noop").mode("overwrite").save()

    def quarantine():
        declared = [quality.unique("key"), quality.not_null("key"), quality.foreign_key(
            "key", parents)]
        for part in quality.enforce(table, declared, "quarantine", ["id"]):
            force(part)

    spark = table.sparkSession
    return {
        "keep_last": lambda: force(dedup.keep_last(table, ["key"], ["id"])),
        "duplicate_count": lambda: force(dedup.duplicate_count(table, ["key"])),
        "orphan_counts": lambda: force(
            quality.orphan_counts([("r", table, "key", parents, "key")])),
        "only_known": lambda: force(joins.only_known(table, parents, "key")),
        "lookup": lambda: force(joins.lookup(table, parents, "key")),
        "counts_per_key": lambda: force(joins.counts_per_key(parents, "key", {"n": table})),
        "unit_price_per_sale": lambda: force(
            pricing.unit_price_per_sale(table, ["key"], "price", "size")),
        "unit_price_first_lot": lambda: force(
            pricing.unit_price_first_lot(table, "key", "price", "size", "label", ["id"])),
        "inconsistent_groups": lambda: force(
            quality.inconsistent_groups(table, "key", "price")),
        "enforce": quarantine,
        "nullify_via_join": lambda: force(corrections.nullify_via_join(
            table, parents, "key", "size", F.col("size") > 5, F.col("key") >= 0)),
        "with_dense_ids": lambda: force(ordering.with_dense_ids(table, ["key", "id"], "n")),
        "counter_rate": lambda: force(metrics.counter_rate(
            table, ["key"], ["key"], "ts", "reading")),
        "counter_total": lambda: force(metrics.counter_total(
            table, ["key", "label"], ["label"], "ts", "reading")),
        "latest_gauge": lambda: force(metrics.latest_gauge(table, ["key"], "ts", "reading")),
        "exact_quantile": lambda: ordering.exact_quantile(table, "price", 0.99, 2),
        "insert_if_absent": lambda: keyed_table.insert_if_absent(
            table.select("key", "id", "label"), scratch_path(spark, "skew"), "key", ["id"],
            "q", 0),
    }


def worst_shares(log_dir: str) -> dict[str, tuple[float, int]]:
    """Per job description the largest share one task had of a stage's shuffled rows."""
    stage_name, rows = {}, defaultdict(list)
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path, encoding="utf-8") as lines:
            for line in lines:
                event = json.loads(line)
                kind = event.get("Event")
                if kind == "SparkListenerJobStart":
                    name = event.get("Properties", {}).get("spark.job.description")
                    stage_name.update({s: name for s in event["Stage IDs"]})
                elif kind == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                    read = event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                    rows[event["Stage ID"]].append(read)
    worst: dict[str, tuple[float, int]] = {}
    for stage, counts in rows.items():
        total, name = sum(counts), stage_name.get(stage)
        if name and total >= WORTH_A_LOOK:
            worst[name] = max(worst.get(name, (0.0, 0)), (max(counts) / total, total))
    return worst


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    work = tempfile.mkdtemp(prefix="skew-")
    os.mkdir(f"{work}/log")
    spark = build_session("skew", "local[8]", {
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": "32",
        "spark.checkpoint.dir": f"{work}/shared",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{work}/log",
        "spark.eventLog.compress": "false",
        # Small limits, so that this table is treated like a large one.
        "spark.sql.autoBroadcastJoinThreshold": "100k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    })
    spark.sparkContext.setLogLevel("ERROR")
    i = F.col("id")
    spark.range(0, n, numPartitions=32).select(
        i, F.when(i % 3 == 0, 0).otherwise(i % 200_000).alias("key"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=i)).alias("ts"),
        F.when(i % 3 == 1, 7).otherwise(i % 1000).cast("decimal(12,2)").alias("price"),
        (i % 7 + 1).cast("decimal(8,2)").alias("size"),
        (i % 100).cast("decimal(12,2)").alias("reading"),
        F.concat(F.lit("label "), (i % 11).cast("string")).alias("label"),
    ).write.parquet(f"{work}/table")
    spark.range(200_000).select(i.alias("key"), F.lit("x").alias("name")).write.parquet(
        f"{work}/parents")
    table, parents = (spark.read.parquet(f"{work}/{t}") for t in ("table", "parents"))
    seconds = {}
    for name, run in operators(table, parents).items():
        spark.sparkContext.setJobDescription(name)
        begin = time.perf_counter()
        run()
        seconds[name] = time.perf_counter() - begin
    spark.stop()
    shares = worst_shares(f"{work}/log")
    for name, spent in seconds.items():
        share, total = shares.get(name, (0.0, 0))
        print(f"{name:22s} {spent:6.1f}s  largest task {share:6.1%} of {total} shuffled rows")


if __name__ == "__main__":
    main()
