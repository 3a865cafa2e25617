"""The quality audit, its corrections, and the comparison of two audits."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions import holds
from hearthline.operators import quality
from hearthline.operators.corrections import (
    Decision,
    apply_corrections,
    corrected_beside,
    decision_log,
)
from hearthline.operators.joins import lookup
from hearthline.operators.ordering import exact_quantile
from hearthline.operators.pricing import unit_price
from hearthline.plans.market import audited_sales
from hearthline.schemas import (
    DWELLING_TYPES,
    ENERGY_LABELS,
    EVENT_ORIGINS,
    FLAT_BUILDING,
    MAX_FLAT_AREA,
    MAX_UNIT_PRICE,
    OLDEST_EXPECTED_YEAR,
)

TRANSACTIONS, CERTIFICATES = "transaction_dvf", "diagnostic_dpe"
FLUX, COMMUNES = "diagnostic_dpe_flux", "commune"

PROFILED_COLUMNS = {
    CERTIFICATES: ["annee_construction", "surface_habitable_logement", "adresse"],
    FLUX: ["surface_habitable_logement"],
    TRANSACTIONS: ["surface_reelle_bati", "type_local", "longitude"],
}


def is_dwelling():
    return F.col("type_local").isin(DWELLING_TYPES)


def is_flat():
    return F.col("type_batiment") == FLAT_BUILDING


def oversized():
    return F.col("surface_habitable_logement") > MAX_FLAT_AREA


def no_rooms():
    return (F.col("nombre_pieces_principales") == 0) & is_dwelling()


def too_old():
    return F.col("annee_construction") < OLDEST_EXPECTED_YEAR


def validity_rules() -> list[quality.Rule]:
    return [
        quality.Rule("dwelling_without_rooms", TRANSACTIONS, no_rooms(), "error", "nullify"),
        quality.Rule("oversized_flat", CERTIFICATES, oversized() & is_flat(), "error", "nullify"),
        quality.Rule("very_old_building", CERTIFICATES, too_old(), "info", "keep"),
    ]


def event_rules() -> list[quality.Rule]:
    """The rules of the stream table, for its rows as well as for events on their way there.

    By default they only count; ``with_action`` gives one of them something to do.
    """
    area, price = "surface_habitable_logement", "prix_m2_commune_reference"
    return [
        quality.Rule("missing_area", FLUX, F.col(area).isNull(), "warning", column=area),
        quality.Rule("missing_price", FLUX, F.col(price).isNull(), "warning", column=price),
        quality.Rule(f"area_above_{MAX_FLAT_AREA}", FLUX, oversized(), "warning", column=area),
    ]


def with_action(rules: list[quality.Rule], **actions: str) -> list[quality.Rule]:
    """The rules, those named with another action."""
    return [replace(r, action=actions.get(r.name, r.action)) for r in rules]


def completeness(tables: dict[str, DataFrame]) -> DataFrame:
    profiled = {n: (tables[n], cols) for n, cols in PROFILED_COLUMNS.items() if n in tables}
    return quality.null_profile(profiled).orderBy("table_name", "column_name")


def same_address_and_day(certificates: DataFrame) -> DataFrame:
    """Certificates sharing address and date: many flats of one building, not duplicates."""
    located = certificates.where(F.col("adresse").isNotNull())
    return quality.duplicate_groups(located, ["adresse", "date_etablissement_dpe"])


def inconsistent_sale_prices(transactions: DataFrame) -> DataFrame:
    return quality.inconsistent_groups(transactions, "id_mutation", "valeur_fonciere")


def relations(tables: dict[str, DataFrame]) -> list[tuple]:
    return [
        (f"{name} -> {COMMUNES}", tables[name], "code_insee", tables[COMMUNES], "code_insee")
        for name in (TRANSACTIONS, CERTIFICATES, FLUX)
        if name in tables
    ]


Metric = tuple[str, str, Column]


def _row_metrics(tables: dict[str, DataFrame]) -> dict[str, list[Metric]]:
    """By table the (dimension, metric, predicate) that one row decides with its commune."""
    rules, metrics = validity_rules(), {}
    for name in (TRANSACTIONS, CERTIFICATES, FLUX):
        if name in tables:
            metrics[name] = [
                *[("completeness", f"null({c})", F.col(c).isNull()) for c in PROFILED_COLUMNS[name]],
                *[("validity", r.name, r.predicate) for r in rules if r.table == name],
                ("volume", "rows", F.lit(True)),
                ("integrity", "orphans", F.col("_known").isNull()),
            ]
    return metrics


def _group_metrics(tables: dict[str, DataFrame]) -> list[tuple[DataFrame, str, list[Metric], set]]:
    """(groups, table, metrics, columns they depend on) of what only groups of rows decide."""
    return [
        (
            same_address_and_day(tables[CERTIFICATES]), CERTIFICATES,
            [("uniqueness", "same_address_and_day_groups", F.lit(True))],
            {"adresse", "date_etablissement_dpe"},
        ),
        (
            _sales_summary(tables[TRANSACTIONS]), TRANSACTIONS,
            [
                ("uniqueness", "sales_with_several_prices", F.col("least") < F.col("greatest")),
                ("coherence", "implausible_unit_price", F.col("prix_m2") > MAX_UNIT_PRICE),
            ],
            {"id_mutation", "valeur_fonciere", "surface_reelle_bati"},
        ),
    ]


def _with_commune(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    known = tables[COMMUNES].select("code_insee").withColumn("_known", F.lit(True))
    return lookup(df, known, "code_insee")


def audit(tables: dict[str, DataFrame]) -> DataFrame:
    """All five dimensions as (dimension, table_name, metric, metric_value).

    Null counts, row rules and orphans of a table share one scan, the sale checks one
    grouping. The communes must be unique on their code, as the cleaned table is.
    """
    counted = [
        _counted(_with_commune(tables[name], tables), name, metrics)
        for name, metrics in _row_metrics(tables).items()
    ]
    counted += [_counted(df, name, found) for df, name, found, _ in _group_metrics(tables)]
    return reduce(DataFrame.unionByName, counted)


def _cells(table: str, found: list[Metric], **values) -> Column:
    """One struct per metric, its values given by the position of the metric."""
    return F.array(*[
        F.struct(
            F.lit(dimension).alias("dimension"),
            F.lit(table).alias("table_name"),
            F.lit(metric).alias("metric"),
            *[value(i).alias(name) for name, value in values.items()],
        )
        for i, (dimension, metric, _) in enumerate(found)
    ])


def _counted(df: DataFrame, table: str, found: list[Metric]) -> DataFrame:
    """Rows meeting each (dimension, metric, predicate), in one pass."""
    cells = _cells(table, found, metric_value=lambda i: F.count_if(holds(found[i][2])))
    return df.agg(cells.alias("_cells")).select(F.inline("_cells"))


def _counted_twice(
    df: DataFrame, corrected: dict[str, Column], table: str, found: list[Metric]
) -> DataFrame:
    """The same before and after the columns are corrected, in one pass."""
    judged = df.withColumns({f"_before{i}": holds(p) for i, (*_, p) in enumerate(found)})
    cells = _cells(
        table, found,
        before_value=lambda i: F.count_if(f"_before{i}"),
        after_value=lambda i: F.count_if(holds(found[i][2])),
    )
    after = judged.withColumns(corrected) if corrected else judged
    return after.agg(cells.alias("_cells")).select(F.inline("_cells"))


def _sales_summary(transactions: DataFrame) -> DataFrame:
    """Per sale its price range and unit price, for both sale checks in one grouping.

    A sale has several prices when its least differs from its greatest.
    """
    price, area = F.col("valeur_fonciere"), F.col("surface_reelle_bati")
    built = holds(area > 0)
    sales = transactions.groupBy("id_mutation").agg(
        F.min(price).alias("least"),
        F.max(price).alias("greatest"),
        F.max(F.when(built, price)).alias("valeur_fonciere"),
        F.sum(F.when(built, area)).alias("surface_reelle_bati"),
    )
    return sales.withColumn("prix_m2", unit_price("valeur_fonciere", "surface_reelle_bati"))


def decisions() -> list[Decision]:
    """What the audit found and what is done about each anomaly."""
    too_dear = F.col("prix_m2") > MAX_UNIT_PRICE
    area = "surface_habitable_logement"
    return [
        Decision(
            "dwelling_without_rooms", TRANSACTIONS, "nombre_pieces_principales", no_rooms(),
            "nullify", "a dwelling has rooms; the true number is unknown",
        ),
        Decision(
            "oversized_flat", CERTIFICATES, area, oversized() & is_flat(),
            "nullify", "probably the area of the whole building",
        ),
        Decision(
            "oversized_flat_event", FLUX, area, oversized(),
            "nullify", "same anomaly, judged on the event's own area",
            parent=(CERTIFICATES, "numero_dpe", is_flat()),
        ),
        Decision(
            "very_old_building", CERTIFICATES, "annee_construction", too_old(),
            "keep", "old buildings exist; rarity proves no error",
        ),
        Decision(
            "implausible_unit_price", TRANSACTIONS, "valeur_fonciere", too_dear,
            "keep", "each value is plausible alone; leave such sales out of means",
            grouped=audited_sales,
        ),
        Decision(
            "missing_year", CERTIFICATES, "annee_construction",
            F.col("annee_construction").isNull(),
            "keep", "no imputation; the construction period is complete",
        ),
        Decision(
            "missing_built_area", TRANSACTIONS, "surface_reelle_bati",
            F.col("surface_reelle_bati").isNull(),
            "keep", "structural: sales without a building",
        ),
    ]


def corrected(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return apply_corrections(tables, decisions())


def correction_log(tables: dict[str, DataFrame]) -> DataFrame:
    return decision_log(tables, decisions())


def before_and_after(tables: dict[str, DataFrame]) -> DataFrame:
    """The same audit on the tables as they are and as corrected, at the cost of one.

    Corrected values stand beside the raw ones, and every metric counts both. What depends on no
    corrected column is counted once.
    """
    chosen, counted, changed = decisions(), [], {}
    for name, metrics in _row_metrics(tables).items():
        df, corrected = corrected_beside(tables, name, chosen)
        if "code_insee" in corrected:
            raise ValueError("communes are looked up once, so their codes cannot be corrected")
        changed[name] = set(corrected)
        counted.append(_counted_twice(_with_commune(df, tables), corrected, name, metrics))
    for df, name, found, reads in _group_metrics(tables):
        if reads & changed[name]:
            raise ValueError(f"groups of {name} depend on a corrected column")
        counted.append(_counted_twice(df, {}, name, found))
    delta = F.col("after_value") - F.col("before_value")
    return reduce(DataFrame.unionByName, counted).withColumn("delta", delta)


def unit_price_threshold(
    transactions: DataFrame, fraction: float = 0.99, factor: float = 1.7
) -> tuple[float | None, float | None]:
    """A high quantile of the unit price and the audit bound derived from it."""
    return price_threshold(audited_sales(transactions), fraction, factor)


def price_threshold(
    sales: DataFrame, fraction: float = 0.99, factor: float = 1.7
) -> tuple[float | None, float | None]:
    """The same of sales at hand, such as a stored table that is used further."""
    quantile = exact_quantile(sales, "prix_m2", fraction)
    return quantile, None if quantile is None else quantile * factor


def expectations(table: str, communes: DataFrame) -> list[quality.Expectation]:
    """The declared constraints of a table."""
    q = quality
    commune_key = [
        q.not_null("code_insee"), q.max_length("code_insee", 5),
        q.foreign_key("code_insee", communes),
    ]
    certificate_key = [
        q.not_null("numero_dpe"), q.max_length("numero_dpe", 20), q.unique("numero_dpe")
    ]
    labels = [q.domain(c, ENERGY_LABELS) for c in ("etiquette_dpe", "etiquette_ges")]

    def at_least_zero(column: str) -> q.Expectation:
        return q.check(column, F.col(column) >= 0)

    return {
        COMMUNES: [
            q.not_null("code_insee"), q.max_length("code_insee", 5), q.unique("code_insee"),
            q.not_null("nom_commune"), q.max_length("nom_commune", 100),
            q.max_length("code_postal", 5), q.max_length("epci_code", 15),
            q.max_length("epci_nom", 150), q.not_null("dep_code"),
            q.max_length("dep_code", 2), q.max_length("dep_nom", 50),
            q.max_length("reg_code", 2), q.max_length("reg_nom", 50),
        ],
        TRANSACTIONS: [
            q.not_null("id_mutation"), q.max_length("id_mutation", 20),
            q.not_null("date_mutation"), q.max_length("nature_mutation", 50),
            q.not_null("valeur_fonciere"), at_least_zero("valeur_fonciere"), *commune_key,
            q.max_length("type_local", 50), at_least_zero("surface_reelle_bati"),
            at_least_zero("surface_terrain"),
        ],
        CERTIFICATES: [
            *certificate_key, *commune_key, *labels,
            q.max_length("periode_construction", 20), q.max_length("type_batiment", 30),
            at_least_zero("surface_habitable_logement"), q.max_length("adresse", 255),
        ],
        FLUX: [
            *certificate_key, *commune_key, *labels,
            at_least_zero("surface_habitable_logement"), q.not_null("source_flux"),
            q.domain("source_flux", EVENT_ORIGINS), q.max_length("source_flux", 10),
            q.not_null("traite_le"),
        ],
    }[table]
