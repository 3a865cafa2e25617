"""Dashboard views."""

from __future__ import annotations

from hearthline.bindings import tables as t
from hearthline.bindings.registry import instant, query
from hearthline.plans import dashboards

_FLUX = ["diagnostic_dpe_flux"]
_FLUX_COMMUNES = ["commune", "diagnostic_dpe_flux"]


@query("label_counts", t.over(_FLUX, """
SELECT etiquette_dpe, COUNT(*) AS nombre FROM diagnostic_dpe_flux GROUP BY etiquette_dpe"""))
def label_counts(spark, sf_dir):
    return dashboards.labels_received(t.flux(spark, sf_dir))


@query("origin_counts", t.over(_FLUX, """
SELECT source_flux, COUNT(*) AS nombre FROM diagnostic_dpe_flux GROUP BY source_flux"""))
def origin_counts(spark, sf_dir):
    return dashboards.origins(t.flux(spark, sf_dir))


@query("volume_per_minute", t.over(_FLUX, f"""
SELECT {instant("date_trunc('minute', traite_le)", "minute")}, COUNT(*) AS n_events
FROM diagnostic_dpe_flux GROUP BY 1"""))
def volume_per_minute(spark, sf_dir):
    return dashboards.processed_per_minute(t.flux(spark, sf_dir))


@query("top_price_dims", t.over(_FLUX_COMMUNES, """
SELECT nom_commune, CAST(MAX(prix_m2_commune_reference) AS DOUBLE) AS prix_moyen
FROM diagnostic_dpe_flux JOIN commune USING (code_insee)
WHERE prix_m2_commune_reference IS NOT NULL
GROUP BY code_insee, nom_commune ORDER BY prix_moyen DESC, code_insee LIMIT 10"""))
def top_price_dims(spark, sf_dir):
    return dashboards.dearest_communes(t.flux(spark, sf_dir), t.communes(spark, sf_dir))


@query("share_by_band", t.over(_FLUX, """
SELECT CASE WHEN prix_m2_commune_reference < 2000 THEN '< 2000'
            WHEN prix_m2_commune_reference < 3000 THEN '2000-3000'
            WHEN prix_m2_commune_reference < 4000 THEN '3000-4000'
            ELSE '>= 4000' END AS tranche,
       100.0::DOUBLE * SUM(CASE WHEN etiquette_dpe IN ('F', 'G') THEN 1 ELSE 0 END) / COUNT(*)
         AS pct_f_g
FROM diagnostic_dpe_flux WHERE prix_m2_commune_reference IS NOT NULL GROUP BY 1"""))
def share_by_band(spark, sf_dir):
    return dashboards.leaky_share_by_price_band(t.flux(spark, sf_dir))


@query("latest_events", t.over(_FLUX_COMMUNES, f"""
SELECT numero_dpe, nom_commune, etiquette_dpe, etiquette_ges,
       CAST(surface_habitable_logement AS DOUBLE) AS surface_habitable_logement,
       CAST(prix_m2_commune_reference AS DOUBLE) AS prix_m2_commune_reference,
       source_flux, {instant("traite_le", "traite_le")}
FROM (SELECT * FROM diagnostic_dpe_flux JOIN commune USING (code_insee)
      ORDER BY traite_le DESC, numero_dpe LIMIT 50) f"""))
def latest_events(spark, sf_dir):
    return dashboards.latest_events(t.flux(spark, sf_dir), t.communes(spark, sf_dir))
