"""Pipeline metrics as tables: counts, ratios, counter rates, latest gauges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions import safe_ratio, state_label
from hearthline.operators.ordering import previous_in_time


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def clean_raw_ratio(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Raw and clean row counts, their ratio, and whether raw >= clean holds."""
    counted = (
        row_count(raw, "raw_records")
        .unionByName(row_count(clean, "clean_records"), allowMissingColumns=True)
        .agg(
            F.max("raw_records").alias("raw_records"),
            F.max("clean_records").alias("clean_records"),
        )
    )
    return counted.select(
        "raw_records",
        "clean_records",
        safe_ratio("clean_records", "raw_records").cast("double").alias("clean_ratio"),
        (F.col("raw_records") >= F.col("clean_records")).alias("raw_covers_clean"),
    )


def counter_increase(
    samples: DataFrame, series: list[str], ts: str, value: str, name: str = "increase"
) -> DataFrame:
    """Growth since the previous sample of the series; after a reset it counts from 0."""
    paired = previous_in_time(samples, series, ts, [value], {value: "_previous"})
    current, previous = F.col(value), F.col("_previous")
    grown = F.when(previous.isNull(), F.lit(0)).when(current < previous, current)
    return paired.withColumn(name, grown.otherwise(current - previous)).drop("_previous")


def counter_rate(
    samples: DataFrame,
    series: list[str],
    by: list[str],
    ts: str,
    value: str,
    window_seconds: int = 60,
) -> DataFrame:
    """Per-second rate of each window, summed over the series that share ``by``.

    An increase belongs to the window of its later sample, so windows add up to the whole
    increase of the counter; nothing is extrapolated to window edges.
    """
    grown = counter_increase(samples, series, ts, value)
    return (
        grown.groupBy(*by, F.window(ts, f"{window_seconds} seconds").alias("_window"))
        .agg(F.sum("increase").alias("increase"))
        .select(
            *by,
            F.col("_window.start").alias("window_start"),
            "increase",
            (F.col("increase").cast("double") / window_seconds).alias("rate"),
        )
    )


def latest_gauge(
    samples: DataFrame,
    series: list[str],
    ts: str,
    value: str,
    labels: dict[float, str] | None = None,
) -> DataFrame:
    """Last sample of each series, optionally with its text from ``labels``.

    Among samples of the same instant the greatest value is taken. Both groupings work on
    plain values, so that Spark hashes instead of sorting the samples.
    """
    instants = samples.groupBy(*series, ts).agg(F.max(value).alias(value))
    result = instants.groupBy(*series).agg(
        F.max(ts).alias(ts), F.max_by(value, ts).alias(value)
    )
    return result.withColumn("state", state_label(value, labels)) if labels else result


def counter_total(
    samples: DataFrame, series: list[str], by: list[str], ts: str, value: str
) -> DataFrame:
    """Sum over series of the latest counter value, by label."""
    return latest_gauge(samples, series, ts, value).groupBy(*by).agg(
        F.sum(value).alias("total")
    )


def volume_per_minute(events: DataFrame, minute: Column) -> DataFrame:
    return events.groupBy(minute.alias("minute")).agg(F.count(F.lit(1)).alias("n_events"))
