"""Event enrichment and cleaning, the same expressions for batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions import (
    first_reason,
    has_key,
    holds,
    in_domain,
    lenient_date,
    lenient_decimal,
    overflows,
)
from hearthline.operators.joins import lookup
from hearthline.operators.quality import Rule
from hearthline.schemas import (
    CERTIFICATE_FLUX,
    ENERGY_LABELS,
    EVENT_ORIGINS,
)

PRICE = "prix_m2_commune_reference"
CLEAN_COLUMNS = [c for c in CERTIFICATE_FLUX.names if c != "traite_le"]


def enrich(events: DataFrame, prices: DataFrame) -> DataFrame:
    """Append the commune's reference price; NULL where the commune has none.

    ``prices`` must be unique on its code (see ``one_price_each``).
    """
    known = prices.select("code_insee", F.col("prix_m2_moyen").alias(PRICE))
    return lookup(events, known, "code_insee")


def one_price_each(prices: DataFrame) -> DataFrame:
    """One row per code: of several prices the one that most sales support, then the lowest."""
    best = F.min_by("prix_m2_moyen", F.struct(-F.col("nb_mutations"), "prix_m2_moyen"))
    priced = prices.where("code_insee is not null and prix_m2_moyen is not null")
    return priced.groupBy("code_insee").agg(best.alias("prix_m2_moyen"))


def known_codes(communes: DataFrame) -> DataFrame:
    """The set of commune codes."""
    return communes.select("code_insee").where("code_insee is not null").distinct()


def reject_rules() -> list[tuple[str, Column]]:
    """Reasons to hold an event back, in the order they are tested.

    The first three are the cleaning rules; the others are the stored table's
    constraints, which would otherwise fail the whole batch.
    """
    area = lenient_decimal("surface_habitable_logement", 38, 10)
    received = F.col("date_reception_dpe")
    return [
        ("missing_key", ~has_key("numero_dpe", "code_insee")),
        (
            "bad_label",
            ~in_domain("etiquette_dpe", ENERGY_LABELS) | ~in_domain("etiquette_ges", ENERGY_LABELS),
        ),
        ("unknown_commune", F.col("_known").isNull()),
        ("key_too_long", F.length("numero_dpe") > 20),
        ("bad_date", (F.length(received) > 0) & lenient_date(received).isNull()),
        ("negative_area", area < 0),
        ("area_too_large", overflows("surface_habitable_logement", 8, 2)),
        ("bad_origin", ~in_domain("source_flux", EVENT_ORIGINS)),
    ]


def gate_events(enriched: DataFrame, communes: DataFrame) -> DataFrame:
    """Append ``reject_reason``, NULL for events that pass; every event gets one outcome.

    ``communes`` must be unique on its code (see ``known_codes``).
    """
    known = communes.select("code_insee").withColumn("_known", F.lit(True))
    judged = lookup(enriched, known, "code_insee")
    return judged.withColumn("reject_reason", first_reason(*reject_rules())).drop("_known")


def typed(accepted: DataFrame) -> DataFrame:
    """Accepted events with the stored table's types; unreadable areas become NULL."""
    return accepted.withColumns({
        "date_reception_dpe": lenient_date("date_reception_dpe"),
        "surface_habitable_logement": lenient_decimal("surface_habitable_logement", 8, 2),
        PRICE: F.col(PRICE).try_cast("decimal(10,2)"),
    })


_AREA = "surface_habitable_logement"


def as_audited(events: DataFrame) -> DataFrame:
    """Events with the area as a number, as the rules of the stored table read it.

    Wider than the stored column, so that a value that will not fit is still seen by a rule.
    """
    return events.withColumn(_AREA, lenient_decimal(_AREA, 38, 10))


def apply_rules(judged: DataFrame, rules: list[Rule]) -> DataFrame:
    """Does what the rules' actions say: ``quarantine`` names the reason, ``nullify`` empties.

    A reason found before stays. All rules judge the event as it came.
    """
    marks = {f"_rule{i}": holds(r.predicate) for i, r in enumerate(rules)}
    seen = as_audited(judged.withColumn("_area", F.col(_AREA))).withColumns(marks)
    acted = seen.withColumn(_AREA, F.col("_area"))
    for mark, rule in zip(marks, rules):
        hit = F.col(mark)
        if rule.action == "quarantine":
            reason = F.coalesce("reject_reason", F.when(hit, F.lit(rule.name)))
            acted = acted.withColumn("reject_reason", reason)
        elif rule.action == "nullify":
            acted = acted.withColumn(rule.column, F.when(~hit, F.col(rule.column)))
        elif rule.action != "keep":
            raise ValueError(f"unknown action {rule.action!r}")
    return acted.select(*judged.columns)
