"""Price and energy analyses by commune.

Facts are reduced to one row per commune before a commune name is joined. Groups are
formed by code, so two communes of the same name stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions import ordered_category, rounded, share_pct
from hearthline.operators.joins import join_aggregates
from hearthline.operators.pricing import (
    mean_by_group,
    ratio_outliers,
    unit_price_first_lot,
    unit_price_per_sale,
)
from hearthline.schemas import (
    CONSTRUCTION_PERIODS,
    DWELLING_TYPES,
    LEAKY_LABELS,
    MAX_UNIT_PRICE,
    MIN_GROUP_SIZE,
    SALE_NATURE,
)

_PRICE, _AREA = "valeur_fonciere", "surface_reelle_bati"


def dwelling_sales() -> Column:
    """Lots counted in prices: houses and flats that were sold."""
    return F.col("type_local").isin(DWELLING_TYPES) & (F.col("nature_mutation") == SALE_NATURE)


def leaky() -> Column:
    return F.col("etiquette_dpe").isin(LEAKY_LABELS)


def sale_prices(transactions: DataFrame) -> DataFrame:
    """Unit price per sale and commune; a sale over two communes counts in both."""
    return unit_price_per_sale(
        transactions, ["id_mutation", "code_insee"], _PRICE, _AREA, "prix_m2", dwelling_sales()
    )


def _mean_prices(transactions: DataFrame, at_least: int) -> DataFrame:
    return mean_by_group(
        sale_prices(transactions), "code_insee", "prix_m2", "prix_moyen_m2", "nb_mutations",
        at_least,
    )


def _leaky_shares(certificates: DataFrame, at_least: int) -> DataFrame:
    return (
        certificates.groupBy("code_insee")
        .agg(F.count(F.lit(1)).alias("nb_diagnostics"), share_pct(leaky()).alias("pct_f_g"))
        .where(F.col("nb_diagnostics") >= at_least)
    )


def _names(communes: DataFrame) -> DataFrame:
    return communes.select("code_insee", "nom_commune")


def price_by_commune(
    transactions: DataFrame, communes: DataFrame, at_least: int = MIN_GROUP_SIZE
) -> DataFrame:
    """Mean price per square metre, dearest first."""
    return (
        join_aggregates("code_insee", _mean_prices(transactions, at_least), _names(communes))
        .select("nom_commune", "nb_mutations", rounded("prix_moyen_m2").alias("prix_moyen_m2"))
        .orderBy(F.col("prix_moyen_m2").desc_nulls_first(), "nom_commune")
    )


def leaky_share_by_commune(
    certificates: DataFrame, communes: DataFrame, at_least: int = MIN_GROUP_SIZE
) -> DataFrame:
    """Share of F and G labels, highest first."""
    return (
        join_aggregates("code_insee", _leaky_shares(certificates, at_least), _names(communes))
        .select("nom_commune", "nb_diagnostics", rounded("pct_f_g", 1).alias("pct_f_g"))
        .orderBy(F.col("pct_f_g").desc_nulls_first(), "nom_commune")
    )


def price_and_leaky_share(
    transactions: DataFrame,
    certificates: DataFrame,
    communes: DataFrame,
    at_least: int = MIN_GROUP_SIZE,
) -> DataFrame:
    """Both measures side by side for communes that have both."""
    return (
        join_aggregates(
            "code_insee",
            _mean_prices(transactions, at_least),
            _leaky_shares(certificates, at_least),
            _names(communes),
        )
        .select(
            "nom_commune",
            "nb_mutations",
            rounded("prix_moyen_m2").alias("prix_moyen_m2"),
            "nb_diagnostics",
            rounded("pct_f_g", 1).alias("pct_f_g"),
        )
        .orderBy(F.col("prix_moyen_m2").desc_nulls_first(), "nom_commune")
    )


def leaky_share_by_period(certificates: DataFrame) -> DataFrame:
    """Share of F and G labels by construction period, oldest first."""
    return (
        certificates.groupBy("periode_construction")
        .agg(
            F.count(F.lit(1)).alias("nb_diagnostics"),
            rounded(share_pct(leaky()), 1).alias("pct_f_g"),
        )
        .orderBy(
            ordered_category("periode_construction", CONSTRUCTION_PERIODS).asc_nulls_last()
        )
    )


def reference_prices(transactions: DataFrame, order: list[str]) -> DataFrame:
    """Price table used to enrich events: each sale counts once, where its first lot lies.

    Area and price may be text; lots where either is unreadable are left out. ``order``
    is the order of the lots in their file.
    """
    lots = transactions.withColumns({
        _AREA: F.col(_AREA).try_cast("decimal(12,2)"),
        _PRICE: F.col(_PRICE).try_cast("decimal(14,2)"),
    })
    sales = unit_price_first_lot(
        lots, "id_mutation", _PRICE, _AREA, "code_insee", order, "prix_m2", dwelling_sales()
    )
    prices = mean_by_group(sales, "code_insee", "prix_m2", "prix_m2_moyen", "nb_mutations")
    return prices.select(
        "code_insee", rounded("prix_m2_moyen", 2).alias("prix_m2_moyen"), "nb_mutations"
    )


def audited_sales(transactions: DataFrame) -> DataFrame:
    """Unit price per sale over all kinds of lots, the grain of the coherence audit."""
    return unit_price_per_sale(
        transactions, ["id_mutation"], _PRICE, _AREA, "prix_m2",
        carry={"code_insee": F.max("code_insee")},
    )


def implausible_prices(
    transactions: DataFrame, communes: DataFrame, bound: float = MAX_UNIT_PRICE
) -> DataFrame:
    """Sales above ``bound`` per square metre, with their commune."""
    return (
        join_aggregates(
            "code_insee", ratio_outliers(audited_sales(transactions), bound, "prix_m2"),
            _names(communes),
        )
        .select(
            "id_mutation",
            "nom_commune",
            F.col(_PRICE).cast("double").alias(_PRICE),
            F.col(_AREA).cast("double").alias("surface_totale"),
            rounded("prix_m2").alias("prix_m2"),
        )
        .orderBy(F.col("prix_m2").desc(), "id_mutation")
    )
