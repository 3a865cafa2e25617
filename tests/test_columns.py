from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hearthline import functions as fn
from hearthline.schemas import CONSTRUCTION_PERIODS, PRICE_BAND_EDGES, PRICE_BAND_LABELS


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def evaluated(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    "text, want",
    [
        ("64.3", Decimal("64.30")), ("", None), (None, None), ("abc", None), ("nan", None),
        ("1e400", None), ("9999999", None), (" 12 ", Decimal("12.00")),
        ("-5", Decimal("-5.00")), ("1_000", None),
    ],
)
def test_lenient_decimal(spark, text, want):
    assert evaluated(one_column(spark, [text]), fn.lenient_decimal("v", 8, 2)) == [want]


def test_lenient_int_takes_whole_numbers_only(spark):
    df = one_column(spark, ["3", "3.0", "3.5", "x", "", None, "99999"])
    assert evaluated(df, fn.lenient_int("v")) == [3, 3, None, None, None, None, 99999]
    assert evaluated(df, fn.lenient_int("v", "smallint"))[-1] is None


def test_lenient_date(spark):
    df = one_column(spark, ["2024-02-29", "2024-13-01", "", None])
    found = evaluated(df, fn.lenient_date("v").cast("string"))
    assert found == ["2024-02-29", None, None, None]


def test_domain_split_gives_every_row_one_side(spark):
    df = one_column(spark, ["A", "H", "", None])
    member = fn.in_domain("v", ["A", "B"])
    assert df.where(member).count() + df.where(~member).count() == 4
    # The plain predicate loses the NULL row on both sides.
    plain = F.col("v").isin(["A", "B"])
    assert df.where(plain).count() + df.where(~plain).count() == 3


def test_has_key_needs_text(spark):
    df = one_column(spark, ["x", "", None])
    assert evaluated(df, fn.has_key("v")) == [True, False, False]


def test_safe_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(6.0, 2.0), (1.0, 0.0)], "a double, b double")
    assert evaluated(df, fn.safe_ratio("a", "b")) == [3.0, None]


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("2.5"),), (Decimal("-2.5"),), (Decimal("3.4"),)],
                               "v decimal(5,2)")
    assert evaluated(df, fn.rounded("v")) == [3.0, -3.0, 3.0]


def test_price_bands(spark):
    df = one_column(spark, [1999.99, 2000.0, 3000.0, 3999.0, 4000.0, None], "double")
    found = evaluated(df, fn.bucketize("v", PRICE_BAND_EDGES, PRICE_BAND_LABELS))
    assert found == ["< 2000", "2000-3000", "3000-4000", "3000-4000", ">= 4000", None]
    with pytest.raises(ValueError):
        fn.bucketize("v", [1], ["only one"])


def test_periods_sort_by_time_not_by_alphabet(spark):
    shuffled = sorted(CONSTRUCTION_PERIODS, reverse=True) + ["inconnue"]
    df = one_column(spark, shuffled)
    ordered = df.orderBy(fn.ordered_category("v", CONSTRUCTION_PERIODS).asc_nulls_last())
    assert [r[0] for r in ordered.collect()] == CONSTRUCTION_PERIODS + ["inconnue"]


def test_share_of_a_category(spark):
    df = one_column(spark, ["F", "A", "G", None])
    assert df.agg(fn.share_pct(F.col("v").isin("F", "G"))).first()[0] == 50.0
    assert df.where("false").agg(fn.share_pct(F.col("v") == "F")).first()[0] is None


def test_first_reason_in_order(spark):
    df = one_column(spark, [None, "", "ok", "xx"])
    reason = fn.first_reason(("missing", F.col("v").isNull()), ("short", F.length("v") < 2),
                             ("long", F.col("v") == "xx"))
    assert evaluated(df, reason) == ["missing", "short", None, "long"]


def test_json_row_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert evaluated(df, fn.json_row("x", "y")) == ['{"x":"a","y":null}']


def test_minute_and_state(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 10, 5, 59), 1.0)], "ts timestamp, up double")
    assert evaluated(df, fn.minute_of("ts")) == [datetime(2024, 1, 1, 10, 5)]
    assert evaluated(df, fn.state_label("up", {0: "DOWN", 1: "UP"})) == ["UP"]
    assert evaluated(df, fn.state_label(F.lit(7), {0: "DOWN"})) == [None]


def test_or_empty(spark):
    assert evaluated(one_column(spark, [None, "x"]), fn.or_empty("v")) == ["", "x"]
