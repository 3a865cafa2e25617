"""Housing and energy tables derived from the driver's tables, in Spark and in SQL.

=====================  ==========================================================
transaction_dvf        one row per line item, priced by its order
diagnostic_dpe         one row per event
diagnostic_dpe_flux    events as processed rows with a reference price
commune                nations; events refer to two codes that do not exist
messages               events as JSON payloads, some of them faulty
=====================  ==========================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.bindings.registry import with_tables
from hearthline.functions import json_row
from hearthline.schemas import CONSTRUCTION_PERIODS, EVENT

LOT_ORDER = ["_line", "_part", "_supplier"]
LIVE_FROM = "2024-01-20"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _code(column: Column, width: int = 5) -> Column:
    return F.lpad(column.cast("string"), width, "0")


def communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = _code(F.col("n_regionkey"), 2)
    code = _code(F.col("n_nationkey"))
    return read(spark, sf_dir, "nation").select(
        code.alias("code_insee"),
        F.col("n_name").alias("nom_commune"),
        F.when(F.col("n_nationkey") != 4, code).alias("code_postal"),
        F.concat(F.lit("E"), region).alias("epci_code"),
        F.concat(F.lit("EPCI "), region).alias("epci_nom"),
        region.alias("dep_code"),
        F.concat(F.lit("Dep "), region).alias("dep_nom"),
        region.alias("reg_code"),
        F.concat(F.lit("Reg "), region).alias("reg_nom"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").join(
        read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    # Joined last, so that grouping by sale reuses the partitioning by order.
    lots = lines.join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    diverging = (F.col("l_orderkey") % 50 == 0) & (F.col("l_linenumber") >= 6)
    status, flag = F.col("o_orderstatus"), F.col("l_returnflag")
    return lots.select(
        F.col("l_orderkey").alias("id_mutation"),
        F.col("o_orderdate").cast("date").alias("date_mutation"),
        F.when(status == "F", "Vente").when(status == "O", "Echange").otherwise("Adjudication")
        .alias("nature_mutation"),
        (F.col("o_totalprice").cast("decimal(12,2)") + F.when(diverging, 1000).otherwise(0))
        .cast("decimal(12,2)").alias("valeur_fonciere"),
        _code(F.col("s_nationkey")).alias("code_insee"),
        F.when(flag == "A", "Maison").when(flag == "R", "Appartement")
        .when(F.col("l_linenumber") < 7, "Dépendance").alias("type_local"),
        F.when(F.col("l_quantity") != 1, F.col("l_quantity")).cast("decimal(8,2)")
        .alias("surface_reelle_bati"),
        (F.col("l_linenumber") - 1).cast("smallint").alias("nombre_pieces_principales"),
        F.when(F.col("l_tax") > 0, F.col("l_tax") * 10000).cast("decimal(10,2)")
        .alias("surface_terrain"),
        F.when(F.col("l_discount") > 0, F.col("l_discount")).cast("decimal(9,6)")
        .alias("longitude"),
        F.when(F.col("l_discount") > 0, F.col("l_tax")).cast("decimal(9,6)").alias("latitude"),
        F.col("l_linenumber").alias("_line"),
        F.col("l_partkey").alias("_part"),
        F.col("l_suppkey").alias("_supplier"),
    )


def _label(kind: Column) -> Column:
    return (
        F.when(kind == "click", "A").when(kind == "view", "B").when(kind == "purchase", "C")
        .when(kind == "error", "F").when(kind == "signup", "G")
    )


def _event_fields() -> dict[str, Column]:
    k = F.get_json_object("props", "$.k").cast("int")
    periods = F.array(*[F.lit(p) for p in CONSTRUCTION_PERIODS])
    kinds = F.array(F.lit("appartement"), F.lit("maison"), F.lit("immeuble"))
    return {
        "_k": k,
        "_code": _code(F.col("user_id") % 27),
        "_label": _label(F.col("event_type")),
        "_ges": F.substring(F.lit("ABCDEFG"), k % 7 + 1, F.lit(1)),
        "_area": (F.col("value").cast("decimal(8,2)") * 4).cast("decimal(8,2)"),
        "_kind": F.element_at(kinds, (F.col("event_id") % 3 + 1).cast("int")),
        "_period": F.element_at(periods, F.floor(k / 10).cast("int") + 1),
        "_origin": F.when(F.col("ts") < F.lit(LIVE_FROM).cast("timestamp_ntz"), "backfill")
        .otherwise("live"),
    }


def certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").withColumns(_event_fields()).select(
        F.col("event_id").cast("string").alias("numero_dpe"),
        F.col("_code").alias("code_insee"),
        F.col("ts").cast("date").alias("date_etablissement_dpe"),
        F.col("_label").alias("etiquette_dpe"),
        F.col("_ges").alias("etiquette_ges"),
        F.when(F.col("_k") % 3 != 0, 1690 + F.col("_k") * 4).alias("annee_construction"),
        F.col("_period").alias("periode_construction"),
        F.col("_kind").alias("type_batiment"),
        F.when(F.col("_k") != 7, F.col("_area")).alias("surface_habitable_logement"),
        F.when(
            F.col("_k") != 50,
            F.concat((F.col("user_id") % 40).cast("string"), F.lit(" rue "), "event_type"),
        ).alias("adresse"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference prices; one region has none, so some lookups find no match."""
    known = read(spark, sf_dir, "nation").where(F.col("n_regionkey") != 4)
    return known.select(
        _code(F.col("n_nationkey")).alias("code_insee"),
        (1000.5 + F.col("n_nationkey") * 160).cast("double").alias("prix_m2_moyen"),
        F.lit(10).cast("bigint").alias("nb_mutations"),
    )


def flux(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = prices(spark, sf_dir).select("code_insee", "prix_m2_moyen")
    rows = read(spark, sf_dir, "events").withColumns(_event_fields())
    return rows.withColumnRenamed("_code", "code_insee").join(known, "code_insee", "left").select(
        F.col("event_id").cast("string").alias("numero_dpe"),
        "code_insee",
        F.col("ts").cast("date").alias("date_reception_dpe"),
        F.col("_label").alias("etiquette_dpe"),
        F.col("_ges").alias("etiquette_ges"),
        F.when(F.col("_k") != 11, F.col("_area")).alias("surface_habitable_logement"),
        F.col("prix_m2_moyen").cast("decimal(10,2)").alias("prix_m2_commune_reference"),
        F.col("_origin").alias("source_flux"),
        F.col("ts").alias("traite_le"),
    )


def staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "commune": communes(spark, sf_dir),
        "transaction_dvf": transactions(spark, sf_dir),
        "diagnostic_dpe": certificates(spark, sf_dir),
        "diagnostic_dpe_flux": flux(spark, sf_dir),
    }


def as_messages(events: DataFrame) -> DataFrame:
    """Events as the messages of a topic; works on a batch or a stream of events."""
    i, k = F.col("event_id"), F.col("_k")
    fields = {
        "numero_dpe": F.when(i % 50 == 1, "").when(i % 50 != 0, (i - (i % 5 == 4).cast("int"))
                                                   .cast("string")),
        "code_insee": F.col("_code"),
        "date_reception_dpe": F.when(i % 71 == 0, "2024-13-45").when(i % 71 == 1, "2024")
        .when(i % 71 == 2, "2024-01").when(i % 71 == 3, "2024-01-05Tx")
        .otherwise(F.col("ts").cast("date").cast("string")),
        "etiquette_dpe": F.when(i % 31 == 0, "H").when(i % 31 != 1, F.col("_label")),
        "etiquette_ges": F.col("_ges"),
        "surface_habitable_logement": F.when(k % 10 == 0, "abc").when(k % 10 == 1, "-12.5")
        .when(k % 10 == 2, "").when(k % 10 == 3, "nan").when(i % 61 == 0, "123456789")
        .otherwise(F.col("_area").cast("string")),
        "source_flux": F.when(i % 211 == 0, "other").otherwise(F.col("_origin")),
    }
    payload = F.when(i % 97 == 0, "not json {").otherwise(json_row(*EVENT.names))
    return events.withColumns(_event_fields()).withColumns(fields).select(
        payload.cast("binary").alias("value"),
        F.lit("certificates").alias("topic"),
        (i % 4).cast("int").alias("partition"),
        i.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(read(spark, sf_dir, "events"))


# The same tables in SQL.

_PERIODS = ", ".join(f"'{p}'" for p in CONSTRUCTION_PERIODS)

SQL = {
    "commune": """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code_insee,
       n_name AS nom_commune,
       CASE WHEN n_nationkey <> 4 THEN lpad(CAST(n_nationkey AS VARCHAR), 5, '0') END
         AS code_postal,
       'E' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS epci_code,
       'EPCI ' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS epci_nom,
       lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS dep_code,
       'Dep ' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS dep_nom,
       lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS reg_code,
       'Reg ' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS reg_nom
FROM nation""",
    "transaction_dvf": """
SELECT l_orderkey AS id_mutation,
       CAST(o_orderdate AS DATE) AS date_mutation,
       CASE o_orderstatus WHEN 'F' THEN 'Vente' WHEN 'O' THEN 'Echange'
            ELSE 'Adjudication' END AS nature_mutation,
       CAST(CAST(o_totalprice AS DECIMAL(12,2))
            + CASE WHEN l_orderkey % 50 = 0 AND l_linenumber >= 6 THEN 1000 ELSE 0 END
            AS DECIMAL(12,2)) AS valeur_fonciere,
       lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS code_insee,
       CASE WHEN l_returnflag = 'A' THEN 'Maison' WHEN l_returnflag = 'R' THEN 'Appartement'
            WHEN l_linenumber < 7 THEN 'Dépendance' END AS type_local,
       CAST(nullif(l_quantity, 1) AS DECIMAL(8,2)) AS surface_reelle_bati,
       CAST(l_linenumber - 1 AS INTEGER) AS nombre_pieces_principales,
       CAST(CASE WHEN l_tax > 0 THEN l_tax * 10000 END AS DECIMAL(10,2)) AS surface_terrain,
       CAST(CASE WHEN l_discount > 0 THEN l_discount END AS DECIMAL(9,6)) AS longitude,
       CAST(CASE WHEN l_discount > 0 THEN l_tax END AS DECIMAL(9,6)) AS latitude,
       l_linenumber AS _line, l_partkey AS _part, l_suppkey AS _supplier
FROM lineitem
JOIN supplier ON s_suppkey = l_suppkey
JOIN orders ON o_orderkey = l_orderkey""",
    "event_fields": f"""
SELECT *,
       lpad(CAST(user_id % 27 AS VARCHAR), 5, '0') AS _code,
       CASE event_type WHEN 'click' THEN 'A' WHEN 'view' THEN 'B' WHEN 'purchase' THEN 'C'
            WHEN 'error' THEN 'F' WHEN 'signup' THEN 'G' END AS _label,
       substr('ABCDEFG', _k % 7 + 1, 1) AS _ges,
       CAST(CAST(value AS DECIMAL(8,2)) * 4 AS DECIMAL(8,2)) AS _area,
       (ARRAY['appartement', 'maison', 'immeuble'])[event_id % 3 + 1] AS _kind,
       (ARRAY[{_PERIODS}])[_k // 10 + 1] AS _period,
       CASE WHEN ts < TIMESTAMP '{LIVE_FROM}' THEN 'backfill' ELSE 'live' END AS _origin
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS _k FROM events) AS e""",
    "diagnostic_dpe": """
SELECT CAST(event_id AS VARCHAR) AS numero_dpe,
       _code AS code_insee,
       CAST(ts AS DATE) AS date_etablissement_dpe,
       _label AS etiquette_dpe,
       _ges AS etiquette_ges,
       CASE WHEN _k % 3 <> 0 THEN 1690 + _k * 4 END AS annee_construction,
       _period AS periode_construction,
       _kind AS type_batiment,
       CASE WHEN _k <> 7 THEN _area END AS surface_habitable_logement,
       CASE WHEN _k <> 50 THEN CAST(user_id % 40 AS VARCHAR) || ' rue ' || event_type END
         AS adresse
FROM event_fields""",
    "prix_moyen_commune": """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code_insee,
       CAST(1000.5 + n_nationkey * 160 AS DOUBLE) AS prix_m2_moyen,
       CAST(10 AS BIGINT) AS nb_mutations
FROM nation WHERE n_regionkey <> 4""",
    "diagnostic_dpe_flux": """
SELECT CAST(event_id AS VARCHAR) AS numero_dpe,
       _code AS code_insee,
       CAST(ts AS DATE) AS date_reception_dpe,
       _label AS etiquette_dpe,
       _ges AS etiquette_ges,
       CASE WHEN _k <> 11 THEN _area END AS surface_habitable_logement,
       CAST(prix_m2_moyen AS DECIMAL(10,2)) AS prix_m2_commune_reference,
       _origin AS source_flux,
       ts AS traite_le
FROM event_fields LEFT JOIN prix_moyen_commune p ON p.code_insee = _code""",
    # Decoded message payloads; malformed ones have no field at all.
    "decoded": """
SELECT event_id,
       event_id % 4 AS _partition,
       ts,
       CASE WHEN event_id % 97 <> 0 THEN
         CASE WHEN event_id % 50 = 1 THEN '' WHEN event_id % 50 <> 0 THEN
           CAST(event_id - CASE WHEN event_id % 5 = 4 THEN 1 ELSE 0 END AS VARCHAR) END END
         AS numero_dpe,
       CASE WHEN event_id % 97 <> 0 THEN _code END AS code_insee,
       CASE WHEN event_id % 97 <> 0 THEN
         CASE event_id % 71 WHEN 0 THEN '2024-13-45' WHEN 1 THEN '2024' WHEN 2 THEN '2024-01'
              WHEN 3 THEN '2024-01-05Tx' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END
         END AS date_reception_dpe,
       CASE WHEN event_id % 97 <> 0 THEN
         CASE WHEN event_id % 31 = 0 THEN 'H' WHEN event_id % 31 <> 1 THEN _label END END
         AS etiquette_dpe,
       CASE WHEN event_id % 97 <> 0 THEN _ges END AS etiquette_ges,
       CASE WHEN event_id % 97 <> 0 THEN
         CASE _k % 10 WHEN 0 THEN 'abc' WHEN 1 THEN '-12.5' WHEN 2 THEN '' WHEN 3 THEN 'nan'
              ELSE CASE WHEN event_id % 61 = 0 THEN '123456789' ELSE CAST(_area AS VARCHAR) END
         END END AS surface_habitable_logement,
       CASE WHEN event_id % 97 <> 0 THEN
         CASE WHEN event_id % 211 = 0 THEN 'other' ELSE _origin END END AS source_flux,
       CASE WHEN event_id % 97 <> 0 AND _k % 10 = 1 THEN CAST(-12.5 AS DECIMAL(18,2))
            WHEN event_id % 97 <> 0 AND _k % 10 > 3 THEN
              CASE WHEN event_id % 61 = 0 THEN 123456789 ELSE _area END END AS _number
FROM event_fields""",
    "gated": """
SELECT d.*,
       p.prix_m2_moyen AS prix_m2_commune_reference,
       CASE WHEN coalesce(numero_dpe, '') = '' OR coalesce(d.code_insee, '') = ''
              THEN 'missing_key'
            WHEN NOT coalesce(etiquette_dpe IN ('A','B','C','D','E','F','G'), FALSE)
              OR NOT coalesce(etiquette_ges IN ('A','B','C','D','E','F','G'), FALSE)
              THEN 'bad_label'
            WHEN d.code_insee NOT IN (SELECT code_insee FROM commune) THEN 'unknown_commune'
            WHEN date_reception_dpe IN ('2024-13-45', '2024', '2024-01', '2024-01-05Tx')
              THEN 'bad_date'
            WHEN _number < 0 THEN 'negative_area'
            WHEN _number > 999999.99 THEN 'area_too_large'
            WHEN source_flux NOT IN ('backfill', 'live') THEN 'bad_origin'
       END AS reject_reason
FROM decoded d LEFT JOIN prix_moyen_commune p ON p.code_insee = d.code_insee""",
}

_NEEDS = {
    "diagnostic_dpe": ["event_fields"],
    "diagnostic_dpe_flux": ["event_fields", "prix_moyen_commune"],
    "decoded": ["event_fields"],
    "gated": ["commune", "event_fields", "prix_moyen_commune", "decoded"],
}


def over(names: list[str], body: str, **more: str) -> str:
    """Oracle SQL over the named tables, with the definitions they build on."""
    ordered: list[str] = []
    for name in names:
        ordered += [n for n in [*_NEEDS.get(name, []), name] if n not in ordered]
    return with_tables(SQL, ordered, body, **more)
