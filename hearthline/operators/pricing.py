"""Unit prices of sales whose rows repeat the price of the whole sale.

A sale of several lots carries its full price on every lot row, so a price per area is
only meaningful after the lots are collapsed to one sale. Row-level ratios are not offered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions import safe_ratio

RATIO_TYPE = "decimal(18,6)"


def unit_price(price: str, size: str) -> Column:
    """Price per size as a decimal, so that sums do not depend on the order of the rows."""
    return safe_ratio(F.col(price).cast("double"), F.col(size).cast("double")).cast(RATIO_TYPE)


def unit_price_per_sale(
    lots: DataFrame,
    keys: list[str],
    price: str,
    size: str,
    ratio: str = "unit_price",
    scope: Column | None = None,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per ``keys``: the repeated price, the summed size and their ratio.

    ``scope`` selects lots first; lots without a positive size never count.
    ``carry`` adds aggregates, such as the group the sale is attributed to.
    """
    kept = lots.where(F.col(size) > 0)
    if scope is not None:
        kept = kept.where(scope)
    sales = kept.groupBy(*keys).agg(
        F.max(price).alias(price),
        F.sum(size).alias(size),
        *[aggregate.alias(name) for name, aggregate in (carry or {}).items()],
    )
    return sales.withColumn(ratio, unit_price(price, size))


def unit_price_first_lot(
    lots: DataFrame,
    sale: str,
    price: str,
    size: str,
    attribute: str,
    order: list[str],
    ratio: str = "unit_price",
    scope: Column | None = None,
) -> DataFrame:
    """One row per sale, priced and attributed by its first lot in ``order``."""
    kept = lots.where((F.col(size) > 0) & F.col(price).isNotNull())
    if scope is not None:
        kept = kept.where(scope)
    first = F.min_by(F.struct(price, attribute), F.struct(*order))
    sales = kept.groupBy(sale).agg(first.alias("_first"), F.sum(size).alias(size))
    return sales.select(sale, "_first.*", size).withColumn(ratio, unit_price(price, size))


def mean_by_group(
    sales: DataFrame,
    group: str,
    ratio: str = "unit_price",
    mean: str = "mean_unit_price",
    count: str = "n_sales",
    at_least: int = 1,
) -> DataFrame:
    """Unweighted mean of the sale ratios per group, for groups of ``at_least`` sales."""
    return (
        sales.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias(count),
            safe_ratio(F.sum(ratio).cast("double"), F.count(ratio)).alias(mean),
        )
        .where(F.col(count) >= at_least)
    )


def ratio_outliers(sales: DataFrame, bound: float, ratio: str = "unit_price") -> DataFrame:
    """Sales whose ratio is above ``bound``."""
    return sales.where(F.col(ratio) > bound)
