"""Raw text extracts to typed staging tables.

``order`` names the columns that give a row's place in its file; of repeated keys the
first row is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions import (
    first_reason,
    in_domain,
    lenient_date,
    lenient_decimal,
    lenient_int,
    overflows,
)
from hearthline.operators.dedup import keep_first
from hearthline.operators.joins import lookup
from hearthline.operators.quality import reject_repeats
from hearthline.schemas import CERTIFICATE, COMMUNE, ENERGY_LABELS, TRANSACTION

REASON = "reject_reason"


def commune_outcomes(raw: DataFrame, order: list[str]) -> DataFrame:
    """Raw communes with the reason the cleaning drops them, NULL where they stay."""
    reason = first_reason(("missing_code", F.col("code_insee").isNull()))
    return reject_repeats(raw.withColumn(REASON, reason), "code_insee", "repeated_code", order)


def clean_communes(raw: DataFrame, order: list[str]) -> DataFrame:
    named = raw.withColumnRenamed("nom_standard", "nom_commune")
    unique = keep_first(
        named.select(*COMMUNE.names, *order).where(F.col("code_insee").isNotNull()),
        ["code_insee"],
        order,
    )
    return unique.select(*COMMUNE.names)


def transaction_outcomes(raw: DataFrame, communes: DataFrame) -> DataFrame:
    """Raw lots with the reason the cleaning drops them, NULL where they stay."""
    return _judged(
        raw.withColumnRenamed("code_commune", "code_insee"),
        communes,
        ("price_too_large", overflows("valeur_fonciere", 12, 2)),
        ("no_price", lenient_decimal("valeur_fonciere", 12, 2).isNull()),
    )


def clean_transactions(
    raw: DataFrame, communes: DataFrame, keep: list[str] | None = None
) -> DataFrame:
    """Lots of known communes with a readable price; other numbers may be missing.

    ``keep`` names further columns to carry along, such as the order of the file.
    """
    return (
        transaction_outcomes(raw, communes)
        .where(F.col(REASON).isNull())
        .select(
            "id_mutation",
            lenient_date("date_mutation").alias("date_mutation"),
            "nature_mutation",
            lenient_decimal("valeur_fonciere", 12, 2).alias("valeur_fonciere"),
            "code_insee",
            "type_local",
            lenient_decimal("surface_reelle_bati", 8, 2).alias("surface_reelle_bati"),
            lenient_int("nombre_pieces_principales", "smallint").alias(
                "nombre_pieces_principales"
            ),
            lenient_decimal("surface_terrain", 10, 2).alias("surface_terrain"),
            lenient_decimal("longitude", 9, 6).alias("longitude"),
            lenient_decimal("latitude", 9, 6).alias("latitude"),
            *(keep or []),
        )
        .select(*TRANSACTION.names, *(keep or []))
    )


def _certificates(raw: DataFrame, communes: DataFrame) -> DataFrame:
    renamed = raw.withColumnsRenamed({"code_insee_ban": "code_insee", "adresse_ban": "adresse"})
    labelled = in_domain("etiquette_dpe", ENERGY_LABELS) & in_domain(
        "etiquette_ges", ENERGY_LABELS
    )
    return _judged(renamed, communes, ("bad_label", ~labelled))


def certificate_outcomes(raw: DataFrame, communes: DataFrame, order: list[str]) -> DataFrame:
    """Raw certificates with the reason the cleaning drops them, NULL where they stay."""
    judged = _certificates(raw, communes)
    return reject_repeats(judged, "numero_dpe", "repeated_number", order)


def clean_certificates(raw: DataFrame, communes: DataFrame, order: list[str]) -> DataFrame:
    """Certificates of known communes with two valid labels, one row per number."""
    kept = _certificates(raw, communes).where(F.col(REASON).isNull())
    unique = keep_first(
        kept.select(*CERTIFICATE.names, *[c for c in order if c not in CERTIFICATE.names]),
        ["numero_dpe"],
        order,
    )
    return unique.withColumns({
        "date_etablissement_dpe": lenient_date("date_etablissement_dpe"),
        "annee_construction": lenient_int("annee_construction"),
        "surface_habitable_logement": lenient_decimal("surface_habitable_logement", 8, 2),
    }).select(*CERTIFICATE.names)


def _judged(rows: DataFrame, communes: DataFrame, *rules: tuple[str, Column]) -> DataFrame:
    """Append the first reason to drop a row; ``communes`` is unique on its code."""
    known = communes.select("code_insee").withColumn("_known", F.lit(True))
    judged = lookup(rows, known, "code_insee")
    reason = first_reason(("unknown_commune", F.col("_known").isNull()), *rules)
    return judged.withColumn(REASON, reason).drop("_known")
