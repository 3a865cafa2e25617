"""Profiles, rules, constraints, corrections and the audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthline.bindings import tables as t
from hearthline.bindings.analytics import AUDITED_SALES
from hearthline.bindings.registry import query
from hearthline.operators import corrections, dedup, quality
from hearthline.operators.joins import orphans
from hearthline.operators.ordering import top_k
from hearthline.plans import audit
from hearthline.schemas import DWELLING_TYPES
from hearthline.session import scratch_path
from hearthline.sources.messages import decode

_ALL = ["commune", "transaction_dvf", "diagnostic_dpe", "diagnostic_dpe_flux"]


def _null_rows(profiled: dict[str, list[str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name,"
        f" COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null, COUNT(*) AS total FROM {table}"
        for table, columns in profiled.items()
        for c in columns
    )


@query("null_profile", t.over(_ALL, _null_rows(audit.PROFILED_COLUMNS)))
def null_profile(spark, sf_dir):
    return audit.completeness(t.staged(spark, sf_dir))


_SCOPED = ["surface_reelle_bati", "type_local", "nombre_pieces_principales", "surface_terrain"]


@query("null_profile_scoped", t.over(["transaction_dvf"], " UNION ALL ".join(f"""
SELECT 'transaction_dvf' AS table_name, '{c}' AS column_name,
       COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null, COUNT(*) AS total,
       COUNT(*) FILTER (WHERE {c} IS NULL AND type_local IN ('Maison', 'Appartement'))
         AS n_null_in_scope,
       COUNT(*) FILTER (WHERE type_local IN ('Maison', 'Appartement')) AS total_in_scope
FROM transaction_dvf""" for c in _SCOPED)))
def null_profile_scoped(spark, sf_dir):
    return quality.null_profile_compared(
        t.transactions(spark, sf_dir), _SCOPED, audit.is_dwelling(), "transaction_dvf"
    )


@query("nulls_by_category", t.over(["transaction_dvf"], """
SELECT type_local, COUNT(*) FILTER (WHERE surface_reelle_bati IS NULL) AS n_null
FROM transaction_dvf WHERE type_local IN ('Maison', 'Appartement') GROUP BY type_local"""))
def nulls_by_category(spark, sf_dir):
    return quality.nulls_by_category(
        t.transactions(spark, sf_dir), "type_local", DWELLING_TYPES, "surface_reelle_bati"
    )


@query("dup_candidates", t.over(["diagnostic_dpe"], """
SELECT adresse, CAST(date_etablissement_dpe AS VARCHAR) AS date_etablissement_dpe,
       COUNT(*) AS n
FROM diagnostic_dpe WHERE adresse IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) > 1
ORDER BY n DESC, adresse, date_etablissement_dpe LIMIT 10"""))
def dup_candidates(spark, sf_dir):
    groups = audit.same_address_and_day(t.certificates(spark, sf_dir))
    return top_k(
        groups, 10, F.col("n").desc(), F.col("adresse"), F.col("date_etablissement_dpe")
    )


@query("dup_count", """
SELECT COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicates FROM lineitem""")
def dup_count(spark, sf_dir):
    return dedup.duplicate_count(
        t.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query("inconsistent_groups", t.over(["transaction_dvf"], """
SELECT id_mutation, COUNT(*) AS n_rows, COUNT(DISTINCT valeur_fonciere) AS n_values
FROM transaction_dvf GROUP BY id_mutation
HAVING COUNT(*) > 1 AND COUNT(DISTINCT valeur_fonciere) > 1"""))
def inconsistent_groups(spark, sf_dir):
    return audit.inconsistent_sale_prices(t.transactions(spark, sf_dir))


_RULES = """
SELECT 'transaction_dvf' AS table_name, 'dwelling_without_rooms' AS rule, 'error' AS severity,
       'nullify' AS action, COUNT(*) AS n_rows
FROM transaction_dvf
WHERE nombre_pieces_principales = 0 AND type_local IN ('Maison', 'Appartement')
UNION ALL SELECT 'diagnostic_dpe', 'oversized_flat', 'error', 'nullify', COUNT(*)
FROM diagnostic_dpe WHERE surface_habitable_logement > 400 AND type_batiment = 'appartement'
UNION ALL SELECT 'diagnostic_dpe', 'very_old_building', 'info', 'keep', COUNT(*)
FROM diagnostic_dpe WHERE annee_construction < 1700"""


@query("rule_counts", t.over(["transaction_dvf", "diagnostic_dpe"], _RULES))
def rule_counts(spark, sf_dir):
    return quality.rule_counts(t.staged(spark, sf_dir), audit.validity_rules())


@query("rule_list", t.over(["diagnostic_dpe"], """
SELECT numero_dpe, CAST(surface_habitable_logement AS DOUBLE) AS surface_habitable_logement,
       type_batiment
FROM diagnostic_dpe WHERE surface_habitable_logement > 400 AND type_batiment = 'appartement'"""))
def rule_list(spark, sf_dir):
    rule = next(r for r in audit.validity_rules() if r.name == "oversized_flat")
    columns = ["numero_dpe", "surface_habitable_logement", "type_batiment"]
    listed = quality.rule_rows(t.certificates(spark, sf_dir), rule, columns)
    return listed.orderBy(F.col("surface_habitable_logement").desc_nulls_first(), "numero_dpe")


@query("rule_list_old", t.over(["diagnostic_dpe"], """
SELECT numero_dpe, annee_construction FROM diagnostic_dpe WHERE annee_construction < 1700"""))
def rule_list_old(spark, sf_dir):
    rule = next(r for r in audit.validity_rules() if r.name == "very_old_building")
    columns = ["numero_dpe", "annee_construction"]
    return quality.rule_rows(t.certificates(spark, sf_dir), rule, columns).orderBy(
        "annee_construction", "numero_dpe"
    )


_ORPHANS = " UNION ALL ".join(
    f"SELECT '{name} -> commune' AS relation, COUNT(*) AS n_orphans FROM {name} f"
    " LEFT JOIN commune c ON c.code_insee = f.code_insee WHERE c.code_insee IS NULL"
    for name in ("transaction_dvf", "diagnostic_dpe", "diagnostic_dpe_flux")
)


@query("fk_profile", t.over(_ALL, f"""
{_ORPHANS} UNION ALL
SELECT 'lineitem -> open or filled orders', COUNT(*) FROM lineitem
LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON o_orderkey = l_orderkey
WHERE o_orderkey IS NULL"""))
def fk_profile(spark, sf_dir):
    orders = t.read(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    lines = t.read(spark, sf_dir, "lineitem")
    relation = ("lineitem -> open or filled orders", lines, "l_orderkey", orders, "o_orderkey")
    return quality.orphan_counts([*audit.relations(t.staged(spark, sf_dir)), relation])


@query("orphan_rows", t.over(["commune", "diagnostic_dpe"], """
SELECT numero_dpe, d.code_insee FROM diagnostic_dpe d
LEFT JOIN commune c ON c.code_insee = d.code_insee WHERE c.code_insee IS NULL"""))
def orphan_rows(spark, sf_dir):
    missing = orphans(t.certificates(spark, sf_dir), t.communes(spark, sf_dir), "code_insee")
    return missing.select("numero_dpe", "code_insee")


# Constraints, checked on the undecided events.

_SUBMITTED = """
SELECT event_id, numero_dpe, code_insee, etiquette_dpe, etiquette_ges,
       _number AS surface_habitable_logement, source_flux, ts AS traite_le FROM decoded"""
_LABELS = "('A','B','C','D','E','F','G')"
_CONSTRAINTS = {
    "not_null(numero_dpe)": "COUNT(*) FILTER (WHERE numero_dpe IS NULL)",
    "max_length(numero_dpe)": "COUNT(*) FILTER (WHERE length(numero_dpe) > 20)",
    "not_null(code_insee)": "COUNT(*) FILTER (WHERE code_insee IS NULL)",
    "max_length(code_insee)": "COUNT(*) FILTER (WHERE length(code_insee) > 5)",
    "domain(etiquette_dpe)": f"COUNT(*) FILTER (WHERE etiquette_dpe NOT IN {_LABELS})",
    "domain(etiquette_ges)": f"COUNT(*) FILTER (WHERE etiquette_ges NOT IN {_LABELS})",
    "check(surface_habitable_logement)":
        "COUNT(*) FILTER (WHERE surface_habitable_logement < 0)",
    "not_null(source_flux)": "COUNT(*) FILTER (WHERE source_flux IS NULL)",
    "domain(source_flux)": "COUNT(*) FILTER (WHERE source_flux NOT IN ('backfill', 'live'))",
    "max_length(source_flux)": "COUNT(*) FILTER (WHERE length(source_flux) > 10)",
    "not_null(traite_le)": "COUNT(*) FILTER (WHERE traite_le IS NULL)",
    "unique(numero_dpe)": "COUNT(numero_dpe) - COUNT(DISTINCT numero_dpe)",
    "foreign_key(code_insee)": "COUNT(*) FILTER (WHERE code_insee IS NOT NULL"
    " AND code_insee NOT IN (SELECT code_insee FROM commune))",
}


def _submitted(spark, sf_dir):
    """Events as landed: stored before the checks, which read them several times."""
    path = scratch_path(spark, "submitted")
    rows = _undecided(spark, sf_dir)
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _undecided(spark, sf_dir):
    decoded = decode(t.messages(spark, sf_dir))
    area = F.col("surface_habitable_logement").try_cast("decimal(8,2)")
    return decoded.select(
        F.col("offset").alias("event_id"), "numero_dpe", "code_insee", "etiquette_dpe",
        "etiquette_ges", area.alias("surface_habitable_logement"), "source_flux",
        F.col("timestamp").alias("traite_le"),
    )


@query("expectations", t.over(["commune", "decoded"], " UNION ALL ".join(
    f"SELECT '{name}' AS constraint_name, {count} AS n_violations FROM submitted"
    for name, count in _CONSTRAINTS.items()), submitted=_SUBMITTED))
def expectations(spark, sf_dir):
    declared = audit.expectations("diagnostic_dpe_flux", t.communes(spark, sf_dir))
    return quality.expectation_counts(_submitted(spark, sf_dir), declared)


_WIDTHS = {
    "commune": {
        "code_insee": 5, "nom_commune": 100, "code_postal": 5, "epci_code": 15, "epci_nom": 150,
        "dep_code": 2, "dep_nom": 50, "reg_code": 2, "reg_nom": 50,
    },
    "transaction_dvf": {
        "id_mutation": 20, "nature_mutation": 50, "code_insee": 5, "type_local": 50,
    },
    "diagnostic_dpe": {
        "numero_dpe": 20, "code_insee": 5, "periode_construction": 20, "type_batiment": 30,
        "adresse": 255,
    },
}
_PRESENT = {
    "commune": ["code_insee", "nom_commune", "dep_code"],
    "transaction_dvf": ["id_mutation", "date_mutation", "valeur_fonciere", "code_insee"],
    "diagnostic_dpe": ["numero_dpe", "code_insee"],
}
_NOT_NEGATIVE = {
    "transaction_dvf": ["valeur_fonciere", "surface_reelle_bati", "surface_terrain"],
    "diagnostic_dpe": ["surface_habitable_logement"],
}
_UNIQUE = {"commune": "code_insee", "diagnostic_dpe": "numero_dpe"}


def _staged_constraints() -> str:
    """The declared constraints of the three staged tables, counted in SQL."""
    rows = []
    for name in _WIDTHS:
        found = {f"not_null({c})": f"{c} IS NULL" for c in _PRESENT[name]}
        found |= {
            f"max_length({c})": f"length(CAST({c} AS VARCHAR)) > {n}"
            for c, n in _WIDTHS[name].items()
        }
        found |= {f"check({c})": f"{c} < 0" for c in _NOT_NEGATIVE.get(name, [])}
        if name == "diagnostic_dpe":
            found |= {f"domain({c})": f"{c} NOT IN {_LABELS}"
                      for c in ("etiquette_dpe", "etiquette_ges")}
        if name != "commune":
            found["foreign_key(code_insee)"] = (
                "code_insee IS NOT NULL AND code_insee NOT IN (SELECT code_insee FROM commune)"
            )
        rows += [
            f"SELECT '{name}' AS table_name, '{rule}' AS constraint_name, "
            f"COUNT(*) FILTER (WHERE {broken}) AS n_violations FROM sent_{name}"
            for rule, broken in found.items()
        ]
        if name in _UNIQUE:
            key = _UNIQUE[name]
            rows.append(
                f"SELECT '{name}', 'unique({key})', COUNT({key}) - COUNT(DISTINCT {key}) "
                f"FROM sent_{name}"
            )
    return " UNION ALL ".join(rows)


@query("expectations_staged", t.over(
    ["commune", "transaction_dvf", "diagnostic_dpe"], _staged_constraints(),
    sent_commune="""
SELECT * REPLACE (CASE WHEN code_insee <> '00007' THEN code_insee END AS code_insee,
                  repeat(nom_commune, CASE WHEN code_insee = '00003' THEN 20 ELSE 1 END)
                    AS nom_commune)
FROM commune UNION ALL SELECT * FROM commune WHERE code_insee < '00004'""",
    sent_transaction_dvf="""
SELECT * REPLACE (CASE WHEN id_mutation % 97 <> 0 THEN
                    CASE WHEN id_mutation % 89 = 0 THEN -valeur_fonciere ELSE valeur_fonciere END
                  END AS valeur_fonciere,
                  CASE WHEN _supplier % 10 = 3 THEN '99999' ELSE code_insee END AS code_insee)
FROM transaction_dvf""",
    sent_diagnostic_dpe="""
SELECT * REPLACE (CAST(number - CASE WHEN number % 7 = 3 THEN 1 ELSE 0 END AS VARCHAR)
                    AS numero_dpe,
                  CASE WHEN number % 31 = 0 THEN 'H' ELSE etiquette_dpe END AS etiquette_dpe)
FROM (SELECT *, CAST(numero_dpe AS BIGINT) AS number FROM diagnostic_dpe) d"""))
def expectations_staged(spark, sf_dir):
    """Broken constraints of communes, transactions and certificates."""
    communes, code = t.communes(spark, sf_dir), F.col("code_insee")
    sale, number = F.col("id_mutation"), F.col("numero_dpe").cast("bigint")
    price = F.when(sale % 89 == 0, -F.col("valeur_fonciere")).otherwise(F.col("valeur_fonciere"))
    sent = {
        "commune": communes.withColumns({
            "nom_commune": F.when(code == "00003", F.repeat("nom_commune", 20))
            .otherwise(F.col("nom_commune")),
            "code_insee": F.when(code != "00007", code),
        }).union(communes.where(code < "00004")),
        "transaction_dvf": t.transactions(spark, sf_dir).withColumns({
            "valeur_fonciere": F.when(sale % 97 != 0, price),
            "code_insee": F.when(F.col("_supplier") % 10 == 3, "99999").otherwise(code),
        }),
        "diagnostic_dpe": t.certificates(spark, sf_dir).withColumns({
            "numero_dpe": (number - (number % 7 == 3).cast("int")).cast("string"),
            "etiquette_dpe": F.when(number % 31 == 0, "H").otherwise(F.col("etiquette_dpe")),
        }),
    }
    counted = [
        quality.expectation_counts(df, audit.expectations(name, communes))
        .select(F.lit(name).alias("table_name"), "constraint_name", "n_violations")
        for name, df in sent.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("enforce_constraints", t.over(["commune", "decoded"], """
SELECT CASE WHEN reason IS NULL AND nth > 1 THEN 'unique(numero_dpe)'
            ELSE coalesce(reason, 'accepted') END AS reject_reason, COUNT(*) AS n_rows
FROM (SELECT *, row_number() OVER (PARTITION BY numero_dpe, reason ORDER BY event_id) AS nth
      FROM (SELECT *, CASE WHEN numero_dpe IS NULL THEN 'not_null(numero_dpe)'
                           WHEN code_insee IS NULL THEN 'not_null(code_insee)'
                           WHEN code_insee NOT IN (SELECT code_insee FROM commune)
                             THEN 'foreign_key(code_insee)'
                           WHEN etiquette_dpe NOT IN ('A','B','C','D','E','F','G')
                             THEN 'domain(etiquette_dpe)'
                           WHEN surface_habitable_logement < 0
                             THEN 'check(surface_habitable_logement)'
                           WHEN source_flux NOT IN ('backfill', 'live')
                             THEN 'domain(source_flux)' END AS reason
            FROM submitted) r) n
GROUP BY 1""", submitted=_SUBMITTED))
def enforce_constraints(spark, sf_dir):
    declared = audit.expectations("diagnostic_dpe_flux", t.communes(spark, sf_dir))
    accepted, rejected = quality.enforce(
        _submitted(spark, sf_dir), declared, "quarantine", ["event_id"]
    )
    none = F.lit(None).cast("string")
    return quality.reason_counts(
        rejected.unionByName(accepted.withColumn("reject_reason", none))
    )


# Corrections and audits.


@query("nullify_where", t.over(["transaction_dvf"], """
SELECT id_mutation, _line, _part, _supplier,
       CAST(CASE WHEN nombre_pieces_principales = 0
                      AND coalesce(type_local IN ('Maison', 'Appartement'), FALSE)
                 THEN NULL ELSE nombre_pieces_principales END AS DOUBLE)
         AS nombre_pieces_principales
FROM transaction_dvf"""))
def nullify_where(spark, sf_dir):
    column = "nombre_pieces_principales"
    lots = t.transactions(spark, sf_dir)
    fixed = corrections.nullify_where(lots, column, audit.no_rooms())
    return fixed.select("id_mutation", *t.LOT_ORDER, column)


@query("nullify_via_join", t.over(["diagnostic_dpe", "diagnostic_dpe_flux"], """
SELECT f.numero_dpe,
       CAST(CASE WHEN f.surface_habitable_logement > 400 AND d.type_batiment = 'appartement'
                 THEN NULL ELSE f.surface_habitable_logement END AS DOUBLE)
         AS surface_habitable_logement
FROM diagnostic_dpe_flux f LEFT JOIN diagnostic_dpe d ON d.numero_dpe = f.numero_dpe"""))
def nullify_via_join(spark, sf_dir):
    column = "surface_habitable_logement"
    fixed = corrections.nullify_via_join(
        t.flux(spark, sf_dir), t.certificates(spark, sf_dir), "numero_dpe", column,
        audit.oversized(), audit.is_flat(),
    )
    return fixed.select("numero_dpe", column)


def _metric(dimension: str, table: str, metric: str, value: str, source: str) -> str:
    return (
        f"SELECT '{dimension}' AS dimension, '{table}' AS table_name, '{metric}' AS metric,"
        f" {value} AS metric_value FROM {source}"
    )


def _audit_sql(names: dict[str, str], audited: str) -> str:
    """The audit as SQL; ``names`` maps each table to the relation holding its rows."""
    rows = []
    for table, columns in audit.PROFILED_COLUMNS.items():
        rows.append(_metric("volume", table, "rows", "COUNT(*)", names[table]))
        rows += [
            _metric("completeness", table, f"null({c})",
                    f"COUNT(*) FILTER (WHERE {c} IS NULL)", names[table])
            for c in columns
        ]
        rows.append(_metric(
            "integrity", table, "orphans", "COUNT(*)",
            f"{names[table]} WHERE code_insee NOT IN (SELECT code_insee FROM commune)"))
    lots, certs = "transaction_dvf", "diagnostic_dpe"
    rows += [
        _metric("validity", lots, "dwelling_without_rooms", "COUNT(*)",
                f"{names[lots]} WHERE nombre_pieces_principales = 0"
                " AND type_local IN ('Maison', 'Appartement')"),
        _metric("validity", certs, "oversized_flat", "COUNT(*)",
                f"{names[certs]} WHERE surface_habitable_logement > 400"
                " AND type_batiment = 'appartement'"),
        _metric("validity", certs, "very_old_building", "COUNT(*)",
                f"{names[certs]} WHERE annee_construction < 1700"),
        _metric("uniqueness", certs, "same_address_and_day_groups", "COUNT(*)",
                f"(SELECT 1 FROM {names[certs]} WHERE adresse IS NOT NULL"
                " GROUP BY adresse, date_etablissement_dpe HAVING COUNT(*) > 1) g"),
        _metric("uniqueness", lots, "sales_with_several_prices", "COUNT(*)",
                f"(SELECT 1 FROM {names[lots]} GROUP BY id_mutation"
                " HAVING COUNT(DISTINCT valeur_fonciere) > 1) g"),
        _metric("coherence", lots, "implausible_unit_price", "COUNT(*)",
                f"{audited} WHERE prix_m2 > 15000"),
    ]
    return " UNION ALL ".join(rows)


_SAME = {n: n for n in ("transaction_dvf", "diagnostic_dpe", "diagnostic_dpe_flux")}
_FIXED = {n: f"{n}_fixed" for n in _SAME}
_FIXED_SQL = {
    "transaction_dvf_fixed": """
SELECT * REPLACE (CASE WHEN nombre_pieces_principales = 0
                       AND coalesce(type_local IN ('Maison', 'Appartement'), FALSE) THEN NULL
                       ELSE nombre_pieces_principales END AS nombre_pieces_principales)
FROM transaction_dvf""",
    "diagnostic_dpe_fixed": """
SELECT * REPLACE (CASE WHEN surface_habitable_logement > 400 AND type_batiment = 'appartement'
                       THEN NULL ELSE surface_habitable_logement END
                  AS surface_habitable_logement)
FROM diagnostic_dpe""",
    "diagnostic_dpe_flux_fixed": """
SELECT f.* REPLACE (CASE WHEN f.surface_habitable_logement > 400
                         AND d.type_batiment = 'appartement' THEN NULL
                         ELSE f.surface_habitable_logement END AS surface_habitable_logement)
FROM diagnostic_dpe_flux f LEFT JOIN diagnostic_dpe d ON d.numero_dpe = f.numero_dpe""",
}


@query("full_audit", t.over(_ALL, _audit_sql(_SAME, "audited"), audited=AUDITED_SALES))
def full_audit(spark, sf_dir):
    return audit.audit(t.staged(spark, sf_dir))


@query("audit_diff", t.over(_ALL, f"""
SELECT dimension, table_name, metric, b.metric_value AS before_value,
       a.metric_value AS after_value, a.metric_value - b.metric_value AS delta
FROM ({_audit_sql(_SAME, "audited")}) b
FULL JOIN ({_audit_sql(_FIXED, "audited")}) a USING (dimension, table_name, metric)""",
    audited=AUDITED_SALES, **_FIXED_SQL))
def audit_diff(spark, sf_dir):
    return audit.before_and_after(t.staged(spark, sf_dir))


def _decision(name: str, table: str, column: str, action: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS decision, '{table}' AS table_name, '{column}' AS column_name,"
        f" '{action}' AS action, COUNT(*) AS n_rows FROM {source}"
    )


_AREA = "surface_habitable_logement"


@query("correction_log", t.over(_ALL, " UNION ALL ".join([
    _decision("dwelling_without_rooms", "transaction_dvf", "nombre_pieces_principales",
              "nullify", "transaction_dvf WHERE nombre_pieces_principales = 0"
              " AND type_local IN ('Maison', 'Appartement')"),
    _decision("oversized_flat", "diagnostic_dpe", _AREA, "nullify",
              f"diagnostic_dpe WHERE {_AREA} > 400 AND type_batiment = 'appartement'"),
    _decision("oversized_flat_event", "diagnostic_dpe_flux", _AREA, "nullify",
              "diagnostic_dpe_flux f JOIN diagnostic_dpe d ON d.numero_dpe = f.numero_dpe"
              f" WHERE f.{_AREA} > 400 AND d.type_batiment = 'appartement'"),
    _decision("very_old_building", "diagnostic_dpe", "annee_construction", "keep",
              "diagnostic_dpe WHERE annee_construction < 1700"),
    _decision("implausible_unit_price", "transaction_dvf", "valeur_fonciere", "keep",
              "audited WHERE prix_m2 > 15000"),
    _decision("missing_year", "diagnostic_dpe", "annee_construction", "keep",
              "diagnostic_dpe WHERE annee_construction IS NULL"),
    _decision("missing_built_area", "transaction_dvf", "surface_reelle_bati", "keep",
              "transaction_dvf WHERE surface_reelle_bati IS NULL"),
]), audited=AUDITED_SALES))
def correction_log(spark, sf_dir):
    return audit.correction_log(t.staged(spark, sf_dir)).drop("why")
