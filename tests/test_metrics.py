from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hearthline.operators import metrics

START = datetime(2024, 1, 1)


def samples(spark, readings):
    data = [(s, label, START + timedelta(seconds=t), float(v)) for s, label, t, v in readings]
    return spark.createDataFrame(data, "series string, label string, ts timestamp, v double")


def test_reset_counts_from_zero(spark, rows):
    df = samples(spark, [("a", "x", 0, 90), ("a", "x", 10, 100), ("a", "x", 20, 5)])
    grown = metrics.counter_increase(df, ["series"], "ts", "v")
    assert [r[0] for r in grown.orderBy("ts").select("increase").collect()] == [0, 10, 5]


def test_rate_sums_the_series_of_a_label(spark, rows):
    df = samples(spark, [
        ("a", "x", 0, 0), ("a", "x", 30, 60), ("a", "x", 70, 120),
        ("b", "x", 10, 0), ("b", "x", 50, 30), ("c", "y", 5, 7),
    ])
    rate = metrics.counter_rate(df, ["series", "label"], ["label"], "ts", "v", 60)
    assert rows(rate, "label", "increase", "rate") == [
        ("x", 60.0, 1.0), ("x", 90.0, 1.5), ("y", 0.0, 0.0),
    ]


def test_windows_add_up_to_the_whole_increase(spark):
    readings = [("a", "x", t, (t * 7) % 50) for t in range(0, 600, 7)]
    df = samples(spark, readings)
    rate = metrics.counter_rate(df, ["series"], ["series"], "ts", "v", 60)
    values = [v for _, _, _, v in readings]
    want = sum(b if b < a else b - a for a, b in zip(values, values[1:]))
    assert rate.agg(F.sum("increase")).first()[0] == pytest.approx(want)


def test_latest_gauge_and_total(spark, rows):
    df = samples(spark, [
        ("a", "x", 0, 1), ("a", "x", 9, 0), ("b", "x", 3, 1), ("c", "y", 1, 4), ("c", "y", 1, 6),
    ])
    latest = metrics.latest_gauge(df, ["series"], "ts", "v", {0: "DOWN", 1: "UP"})
    assert rows(latest, "series", "v", "state") == [
        ("a", 0.0, "DOWN"), ("b", 1.0, "UP"), ("c", 6.0, None),
    ]
    total = metrics.counter_total(df, ["series", "label"], ["label"], "ts", "v")
    assert rows(total) == [("x", 1.0), ("y", 6.0)]


def test_clean_ratio(spark):
    raw, clean = spark.range(8), spark.range(6)
    assert tuple(metrics.clean_raw_ratio(raw, clean).first()) == (8, 6, 0.75, True)
    assert tuple(metrics.clean_raw_ratio(clean, raw).first())[3] is False
    none = spark.range(0)
    assert tuple(metrics.clean_raw_ratio(none, none).first()) == (0, 0, None, True)
