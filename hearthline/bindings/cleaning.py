"""Batch cleaning of raw text extracts and row accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.bindings import tables as t
from hearthline.bindings.registry import query
from hearthline.operators.quality import reason_counts
from hearthline.plans import cleaning, warehouse
from hearthline.schemas import RAW_CERTIFICATE, RAW_COMMUNE, RAW_TRANSACTION
from hearthline.session import scratch_path
from hearthline.sources import files

# Raw extracts: the staged tables as text, with repeated keys, unknown codes and bad numbers.


def raw_communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = F.sequence(F.lit(0), F.col("n_nationkey") % 3)
    nation = t.read(spark, sf_dir, "nation").select(
        t._code(F.col("n_nationkey")).alias("code_insee"), F.explode(copies).alias("_copy")
    )
    staged = t.communes(spark, sf_dir)
    raw = staged.join(nation, "code_insee").withColumnRenamed("nom_commune", "_name")
    return raw.withColumns({
        "nom_standard": F.concat("_name", F.lit("/"), F.col("_copy").cast("string")),
        "code_insee": F.when(F.col("code_insee") != "00007", F.col("code_insee")),
    })


def raw_transactions(spark: SparkSession, sf_dir: str, keep: list[str] = ()) -> DataFrame:
    lots = t.transactions(spark, sf_dir)
    sale, rooms = F.col("id_mutation"), F.col("nombre_pieces_principales")
    text = {c: F.col(c).cast("string") for c in (
        "id_mutation", "date_mutation", "surface_terrain", "longitude", "latitude",
    )}
    text["valeur_fonciere"] = F.when(sale % 97 == 0, "n/a").when(sale % 89 == 0, "").otherwise(
        F.col("valeur_fonciere").cast("string")
    )
    text["surface_reelle_bati"] = F.when(F.col("_line") == 5, "vide").otherwise(
        F.col("surface_reelle_bati").cast("string")
    )
    text["nombre_pieces_principales"] = F.when(rooms == 6, "3.5").when(rooms == 5, "5.0").otherwise(
        rooms.cast("string")
    )
    text["code_commune"] = F.when(F.col("_supplier") % 10 == 3, "99999").otherwise(
        F.col("code_insee")
    )
    return lots.withColumns(text).drop("code_insee", *(c for c in t.LOT_ORDER if c not in keep))


def raw_certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = t.certificates(spark, sf_dir)
    number = F.col("numero_dpe").cast("bigint")
    text = {
        "_row": number,
        "numero_dpe": (number - (number % 7 == 3).cast("int")).cast("string"),
        "etiquette_dpe": F.when(number % 31 == 0, "H").when(
            number % 31 != 1, F.col("etiquette_dpe")
        ),
        "annee_construction": F.coalesce(
            F.col("annee_construction").cast("string"), F.lit("inconnue")
        ),
        "surface_habitable_logement": F.when(
            number % 13 != 0, F.col("surface_habitable_logement").cast("string")
        ).otherwise("nan"),
        "date_etablissement_dpe": F.col("date_etablissement_dpe").cast("string"),
        "code_insee_ban": F.col("code_insee"),
        "adresse_ban": F.col("adresse"),
        "code_postal_ban": F.col("code_insee"),
    }
    return staged.withColumns(text).drop("code_insee", "adresse")


_CLEAN_CERTIFICATES = """
SELECT * EXCLUDE (_nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY key_number ORDER BY _row) AS _nth FROM (
    SELECT CAST(numero_dpe AS BIGINT) AS _row,
           CAST(CAST(numero_dpe AS BIGINT)
                - CASE WHEN CAST(numero_dpe AS BIGINT) % 7 = 3 THEN 1 ELSE 0 END AS VARCHAR)
             AS key_number,
           code_insee, date_etablissement_dpe,
           CASE WHEN CAST(numero_dpe AS BIGINT) % 31 = 0 THEN 'H'
                WHEN CAST(numero_dpe AS BIGINT) % 31 <> 1 THEN etiquette_dpe END AS label,
           etiquette_ges, annee_construction, periode_construction, type_batiment,
           CASE WHEN CAST(numero_dpe AS BIGINT) % 13 <> 0 THEN surface_habitable_logement END
             AS area,
           adresse
    FROM diagnostic_dpe) r
  WHERE code_insee IN (SELECT code_insee FROM commune) AND label IN ('A','B','C','D','E','F','G')
) s WHERE _nth = 1"""


@query("clean_dim", t.over(["commune"], """
SELECT code_insee, nom_commune || '/0' AS nom_commune, code_postal, epci_code, epci_nom,
       dep_code, dep_nom, reg_code, reg_nom
FROM commune WHERE code_insee <> '00007'"""))
def clean_dim(spark, sf_dir):
    return cleaning.clean_communes(raw_communes(spark, sf_dir), ["_copy"])


@query("clean_sales", t.over(["commune", "transaction_dvf"], """
SELECT CAST(id_mutation AS VARCHAR) AS id_mutation,
       CAST(date_mutation AS VARCHAR) AS date_mutation, nature_mutation,
       CAST(valeur_fonciere AS DOUBLE) AS valeur_fonciere, code_insee, type_local,
       CASE WHEN _line <> 5 THEN CAST(surface_reelle_bati AS DOUBLE) END AS surface_reelle_bati,
       CAST(CASE WHEN _line <> 7 THEN nombre_pieces_principales END AS DOUBLE)
         AS nombre_pieces_principales,
       CAST(surface_terrain AS DOUBLE) AS surface_terrain,
       CAST(longitude AS DOUBLE) AS longitude, CAST(latitude AS DOUBLE) AS latitude
FROM transaction_dvf
WHERE _supplier % 10 <> 3 AND id_mutation % 97 <> 0 AND id_mutation % 89 <> 0"""))
def clean_sales(spark, sf_dir):
    return cleaning.clean_transactions(
        raw_transactions(spark, sf_dir), t.communes(spark, sf_dir)
    )


@query("clean_events", t.over(["commune", "diagnostic_dpe"], """
SELECT key_number AS numero_dpe, code_insee,
       CAST(date_etablissement_dpe AS VARCHAR) AS date_etablissement_dpe,
       label AS etiquette_dpe, etiquette_ges,
       CAST(annee_construction AS DOUBLE) AS annee_construction, periode_construction,
       type_batiment, CAST(area AS DOUBLE) AS surface_habitable_logement, adresse
FROM cleaned""", cleaned=_CLEAN_CERTIFICATES))
def clean_events(spark, sf_dir):
    cleaned = cleaning.clean_certificates(
        raw_certificates(spark, sf_dir), t.communes(spark, sf_dir), ["_row"]
    )
    return cleaned.withColumn("annee_construction", F.col("annee_construction").cast("double"))


@query("commune_outcomes", """
SELECT CASE WHEN n_nationkey = 7 THEN 'missing_code' WHEN copy > 0 THEN 'repeated_code'
            ELSE 'accepted' END AS reject_reason, COUNT(*) AS n_rows
FROM (SELECT n_nationkey, unnest(range(n_nationkey % 3 + 1)) AS copy FROM nation) n GROUP BY 1""")
def commune_outcomes(spark, sf_dir):
    return reason_counts(cleaning.commune_outcomes(raw_communes(spark, sf_dir), ["_copy"]))


@query("certificate_outcomes", t.over(["commune", "diagnostic_dpe"], """
SELECT reject_reason, COUNT(*) AS n_rows FROM (
  SELECT CASE WHEN reason IS NULL AND row_number() OVER (
                PARTITION BY reason, key_number ORDER BY number) > 1 THEN 'repeated_number'
              ELSE coalesce(reason, 'accepted') END AS reject_reason
  FROM (SELECT CAST(numero_dpe AS BIGINT) AS number,
               number - CASE WHEN number % 7 = 3 THEN 1 ELSE 0 END AS key_number,
               CASE WHEN code_insee NOT IN (SELECT code_insee FROM commune)
                      THEN 'unknown_commune'
                    WHEN number % 31 IN (0, 1) OR etiquette_dpe IS NULL THEN 'bad_label'
               END AS reason FROM diagnostic_dpe) r) o
GROUP BY 1"""))
def certificate_outcomes(spark, sf_dir):
    judged = cleaning.certificate_outcomes(
        raw_certificates(spark, sf_dir), t.communes(spark, sf_dir), ["_row"]
    )
    return reason_counts(judged)


@query("sales_outcomes", t.over(["transaction_dvf"], """
SELECT CASE WHEN _supplier % 10 = 3 THEN 'unknown_commune'
            WHEN id_mutation % 97 = 0 OR id_mutation % 89 = 0 THEN 'no_price'
            ELSE 'accepted' END AS reject_reason, COUNT(*) AS n_rows
FROM transaction_dvf GROUP BY 1"""))
def sales_outcomes(spark, sf_dir):
    judged = cleaning.transaction_outcomes(
        raw_transactions(spark, sf_dir), t.communes(spark, sf_dir)
    )
    return reason_counts(judged)


_LOADED_LOTS = """
SELECT * FROM transaction_dvf
WHERE _supplier % 10 <> 3 AND id_mutation % 97 <> 0 AND id_mutation % 89 <> 0
  AND code_insee <> '00007'"""


@query("warehouse_load", t.over(["commune", "transaction_dvf", "diagnostic_dpe"], """
SELECT code_insee, ROUND(CAST(SUM(prix_m2) AS DOUBLE) / COUNT(prix_m2), 2) AS prix_m2_moyen,
       COUNT(*) AS nb_mutations,
       (SELECT COUNT(*) FROM commune WHERE code_insee <> '00007') AS n_communes,
       (SELECT COUNT(*) FROM loaded) AS n_lots,
       (SELECT COUNT(DISTINCT key_number) FROM certified) AS n_certificates
FROM first_sales GROUP BY code_insee""", loaded=_LOADED_LOTS, certified="""
SELECT number - CASE WHEN number % 7 = 3 THEN 1 ELSE 0 END AS key_number
FROM (SELECT *, CAST(numero_dpe AS BIGINT) AS number FROM diagnostic_dpe) d
WHERE code_insee IN (SELECT code_insee FROM commune) AND code_insee <> '00007'
  AND number % 31 NOT IN (0, 1) AND etiquette_dpe IS NOT NULL""", first_sales="""
SELECT id_mutation,
       arg_min(code_insee, ROW(_line, _part, _supplier)) AS code_insee,
       CAST(CAST(arg_min(valeur_fonciere, ROW(_line, _part, _supplier)) AS DOUBLE)
            / CAST(SUM(surface_reelle_bati) AS DOUBLE) AS DECIMAL(18,6)) AS prix_m2
FROM loaded
WHERE type_local IN ('Maison', 'Appartement') AND surface_reelle_bati > 0 AND _line <> 5
  AND nature_mutation = 'Vente'
GROUP BY id_mutation"""))
def warehouse_load(spark, sf_dir):
    """Extracts written as text, loaded, checked, corrected and priced."""
    at = scratch_path(spark, "extracts")
    parts = {
        "communes": raw_communes(spark, sf_dir).orderBy("code_postal", "_name", "_copy")
        .select(*RAW_COMMUNE.names),
        "transactions": raw_transactions(spark, sf_dir, keep=t.LOT_ORDER)
        .orderBy(F.col("id_mutation").cast("bigint"), *t.LOT_ORDER).select(*RAW_TRANSACTION.names),
        "certificates": raw_certificates(spark, sf_dir).orderBy("_row")
        .select(*RAW_CERTIFICATE.names),
    }
    for name, rows in parts.items():
        files.write_csv(rows, f"{at}/{name}")
    extracts = warehouse.Extracts(*(f"{at}/{name}" for name in parts))
    tables = warehouse.load(spark, extracts, scratch_path(spark, "warehouse"))
    counts = {
        "n_communes": tables["commune"].count(), "n_lots": tables["transaction_dvf"].count(),
        "n_certificates": tables["diagnostic_dpe"].count(),
    }
    return tables[warehouse.PRICES].withColumns({
        name: F.lit(n).cast("bigint") for name, n in counts.items()
    })
