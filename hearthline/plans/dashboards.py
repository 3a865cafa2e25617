"""Dashboard views over the clean event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.functions import bucketize, minute_of, share_pct
from hearthline.operators.metrics import volume_per_minute
from hearthline.operators.ordering import top_k
from hearthline.plans.market import leaky
from hearthline.schemas import PRICE_BAND_EDGES, PRICE_BAND_LABELS

_PRICE = "prix_m2_commune_reference"


def _counted(flux: DataFrame, column: str) -> DataFrame:
    return flux.groupBy(column).agg(F.count(F.lit(1)).alias("nombre")).orderBy(column)


def labels_received(flux: DataFrame) -> DataFrame:
    return _counted(flux, "etiquette_dpe")


def origins(flux: DataFrame) -> DataFrame:
    return _counted(flux, "source_flux")


def processed_per_minute(flux: DataFrame) -> DataFrame:
    return volume_per_minute(flux, minute_of("traite_le")).orderBy("minute")


def dearest_communes(flux: DataFrame, communes: DataFrame, k: int = 10) -> DataFrame:
    """Reference price of the dearest communes seen in the stream."""
    prices = (
        flux.where(F.col(_PRICE).isNotNull())
        .groupBy("code_insee")
        .agg(F.max(_PRICE).cast("double").alias("prix_moyen"))
    )
    named = prices.join(communes.select("code_insee", "nom_commune"), "code_insee")
    return top_k(named, k, F.col("prix_moyen").desc(), F.col("code_insee").asc()).select(
        "nom_commune", "prix_moyen"
    )


def leaky_share_by_price_band(flux: DataFrame) -> DataFrame:
    band = bucketize(_PRICE, PRICE_BAND_EDGES, PRICE_BAND_LABELS).alias("tranche")
    return (
        flux.where(F.col(_PRICE).isNotNull())
        .groupBy(band)
        .agg(share_pct(leaky()).alias("pct_f_g"))
        .orderBy("tranche")
    )


def latest_events(flux: DataFrame, communes: DataFrame, k: int = 50) -> DataFrame:
    """The last events processed, with commune names."""
    named = flux.join(communes.select("code_insee", "nom_commune"), "code_insee")
    latest = top_k(named, k, F.col("traite_le").desc_nulls_first(), F.col("numero_dpe").asc())
    return latest.select(
        "numero_dpe", "nom_commune", "etiquette_dpe", "etiquette_ges",
        "surface_habitable_logement", _PRICE, "source_flux", "traite_le",
    )
