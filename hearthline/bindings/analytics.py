"""Verification and market analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.bindings import tables as t
from hearthline.bindings.registry import query
from hearthline.operators.metrics import row_count
from hearthline.plans import audit, market, verification
from hearthline.schemas import CONSTRUCTION_PERIODS

# Sale-level definitions shared by several oracles.
_SALES = """
SELECT id_mutation, code_insee,
       CAST(CAST(MAX(valeur_fonciere) AS DOUBLE) / CAST(SUM(surface_reelle_bati) AS DOUBLE)
            AS DECIMAL(18,6)) AS prix_m2
FROM transaction_dvf
WHERE type_local IN ('Maison', 'Appartement') AND surface_reelle_bati > 0
  AND nature_mutation = 'Vente'
GROUP BY id_mutation, code_insee"""
_PRICES = """
SELECT code_insee, COUNT(*) AS nb_mutations,
       CAST(SUM(prix_m2) AS DOUBLE) / COUNT(prix_m2) AS prix_moyen_m2
FROM sales GROUP BY code_insee HAVING COUNT(*) >= 10"""
_SHARES = """
SELECT code_insee, COUNT(*) AS nb_diagnostics,
       100.0::DOUBLE * COUNT(*) FILTER (WHERE etiquette_dpe IN ('F', 'G')) / COUNT(*) AS pct_f_g
FROM diagnostic_dpe GROUP BY code_insee HAVING COUNT(*) >= 10"""
AUDITED_SALES = """
SELECT id_mutation, MAX(valeur_fonciere) AS valeur_fonciere,
       SUM(surface_reelle_bati) AS surface_totale, MAX(code_insee) AS code_insee,
       CAST(CAST(MAX(valeur_fonciere) AS DOUBLE) / CAST(SUM(surface_reelle_bati) AS DOUBLE)
            AS DECIMAL(18,6)) AS prix_m2
FROM transaction_dvf WHERE surface_reelle_bati > 0 GROUP BY id_mutation"""


def _numbered(ordered: DataFrame) -> DataFrame:
    """The place of each row in an ordered list of one row per commune or period."""
    placed = ordered.withColumn("_at", F.monotonically_increasing_id())
    nth = F.row_number().over(Window.orderBy("_at")).cast("bigint")
    return placed.withColumn("position", nth).drop("_at")


@query("table_counts", """
SELECT 'orders' AS table_name, COUNT(*) AS n_rows FROM orders
UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
UNION ALL SELECT 'events', COUNT(*) FROM events""")
def table_counts(spark, sf_dir):
    names = ("orders", "lineitem", "events")
    return verification.table_counts({n: t.read(spark, sf_dir, n) for n in names})


@query("facts_per_dim_topk", t.over(["commune", "transaction_dvf", "diagnostic_dpe"], """
SELECT c.code_insee, c.nom_commune,
       (SELECT COUNT(*) FROM transaction_dvf f WHERE f.code_insee = c.code_insee)
         AS nb_transactions,
       (SELECT COUNT(*) FROM diagnostic_dpe d WHERE d.code_insee = c.code_insee)
         AS nb_diagnostics
FROM commune c ORDER BY nb_transactions DESC, c.code_insee LIMIT 10"""))
def facts_per_dim_topk(spark, sf_dir):
    return verification.busiest_communes(
        t.communes(spark, sf_dir), t.transactions(spark, sf_dir), t.certificates(spark, sf_dir)
    )


@query("mean_unit_price", t.over(["commune", "transaction_dvf"], """
SELECT nom_commune, nb_mutations, ROUND(prix_moyen_m2, 0) AS prix_moyen_m2,
       row_number() OVER (ORDER BY ROUND(prix_moyen_m2, 0) DESC NULLS FIRST, nom_commune)
         AS position
FROM prices JOIN commune USING (code_insee)""", sales=_SALES, prices=_PRICES))
def mean_unit_price(spark, sf_dir):
    return _numbered(
        market.price_by_commune(t.transactions(spark, sf_dir), t.communes(spark, sf_dir))
    )


@query("category_share", t.over(["commune", "diagnostic_dpe"], """
SELECT nom_commune, nb_diagnostics, ROUND(pct_f_g, 1) AS pct_f_g,
       row_number() OVER (ORDER BY ROUND(pct_f_g, 1) DESC NULLS FIRST, nom_commune) AS position
FROM shares JOIN commune USING (code_insee)""", shares=_SHARES))
def category_share(spark, sf_dir):
    return _numbered(market.leaky_share_by_commune(
        t.certificates(spark, sf_dir), t.communes(spark, sf_dir)
    ))


@query("price_vs_share", t.over(["commune", "transaction_dvf", "diagnostic_dpe"], """
SELECT nom_commune, nb_mutations, ROUND(prix_moyen_m2, 0) AS prix_moyen_m2,
       nb_diagnostics, ROUND(pct_f_g, 1) AS pct_f_g,
       row_number() OVER (ORDER BY ROUND(prix_moyen_m2, 0) DESC NULLS FIRST, nom_commune)
         AS position
FROM prices JOIN shares USING (code_insee) JOIN commune USING (code_insee)""",
    sales=_SALES, prices=_PRICES, shares=_SHARES))
def price_vs_share(spark, sf_dir):
    return _numbered(market.price_and_leaky_share(
        t.transactions(spark, sf_dir), t.certificates(spark, sf_dir), t.communes(spark, sf_dir)
    ))


_PERIODS = ", ".join(f"'{p}'" for p in CONSTRUCTION_PERIODS)


@query("share_by_period", t.over(["diagnostic_dpe"], f"""
SELECT periode_construction, COUNT(*) AS nb_diagnostics,
       ROUND(100.0::DOUBLE * COUNT(*) FILTER (WHERE etiquette_dpe IN ('F', 'G')) / COUNT(*), 1)
         AS pct_f_g,
       row_number() OVER (ORDER BY list_position([{_PERIODS}], periode_construction) NULLS LAST)
         AS position
FROM diagnostic_dpe GROUP BY periode_construction"""))
def share_by_period(spark, sf_dir):
    return _numbered(market.leaky_share_by_period(t.certificates(spark, sf_dir)))


@query("unit_price_first_pick", t.over(["transaction_dvf"], """
SELECT code_insee, ROUND(CAST(SUM(prix_m2) AS DOUBLE) / COUNT(prix_m2), 2) AS prix_m2_moyen,
       COUNT(*) AS nb_mutations
FROM first_sales GROUP BY code_insee""", first_sales="""
SELECT id_mutation,
       arg_min(code_insee, ROW(_line, _part, _supplier)) AS code_insee,
       CAST(CAST(arg_min(valeur_fonciere, ROW(_line, _part, _supplier)) AS DOUBLE)
            / CAST(SUM(surface_reelle_bati) AS DOUBLE) AS DECIMAL(18,6)) AS prix_m2
FROM transaction_dvf
WHERE type_local IN ('Maison', 'Appartement') AND surface_reelle_bati > 0
  AND nature_mutation = 'Vente'
GROUP BY id_mutation"""))
def unit_price_first_pick(spark, sf_dir):
    return market.reference_prices(t.transactions(spark, sf_dir), t.LOT_ORDER)


@query("ratio_bound", t.over(["commune", "transaction_dvf"], """
SELECT id_mutation, nom_commune, CAST(valeur_fonciere AS DOUBLE) AS valeur_fonciere,
       CAST(surface_totale AS DOUBLE) AS surface_totale,
       CAST(ROUND(prix_m2, 0) AS DOUBLE) AS prix_m2
FROM audited JOIN commune USING (code_insee) WHERE prix_m2 > 15000""", audited=AUDITED_SALES))
def ratio_bound(spark, sf_dir):
    return market.implausible_prices(t.transactions(spark, sf_dir), t.communes(spark, sf_dir))


@query("percentile_threshold", t.over(["transaction_dvf"], """
SELECT ROUND(p99, 2) AS p99, ROUND(p99 * 1.7, 2) AS threshold,
       (SELECT COUNT(*) FROM audited WHERE CAST(prix_m2 AS DOUBLE) > p99) AS n_above_p99
FROM (SELECT quantile_cont(CAST(prix_m2 AS DOUBLE), 0.99) AS p99 FROM audited) q""",
    audited=AUDITED_SALES))
def percentile_threshold(spark, sf_dir):
    sales = market.audited_sales(t.transactions(spark, sf_dir)).select("prix_m2").checkpoint()
    p99, threshold = audit.price_threshold(sales)
    above = sales.where(F.col("prix_m2").cast("double") > p99)
    return row_count(above, "n_above_p99").select(
        F.round(F.lit(p99), 2).alias("p99"),
        F.round(F.lit(threshold), 2).alias("threshold"),
        "n_above_p99",
    )
