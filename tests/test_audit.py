from datetime import date, datetime
from decimal import Decimal

import pytest

from hearthline.operators import corrections, quality
from hearthline.operators.corrections import nullify_where
from hearthline.plans import audit, verification
from hearthline.schemas import CERTIFICATE, CERTIFICATE_FLUX, COMMUNE, TRANSACTION
from pyspark.sql import functions as F

DAY = date(2024, 5, 1)


def lot(sale, price, kind, rooms, area="50", code="44109"):
    area = None if area is None else Decimal(area)
    return (sale, DAY, "Vente", Decimal(price), code, kind, area, rooms, None, None, None)


def certificate(number, kind, area, year=1990, address="1 rue x", code="44109"):
    area = None if area is None else Decimal(area)
    return (number, code, DAY, "F", "A", year, "1989-2000", kind, area, address)


def event(number, area, code="44109"):
    area = None if area is None else Decimal(area)
    return (number, code, DAY, "F", "A", area, None, "live", datetime(2024, 5, 1))


@pytest.fixture
def tables(spark):
    return {
        "commune": spark.createDataFrame(
            [("44109", "Nantes", None, None, None, "44", None, None, None)], COMMUNE
        ),
        "transaction_dvf": spark.createDataFrame([
            lot("s1", 100000, "Maison", 0), lot("s2", 100000, "Dépendance", 0),
            lot("s3", 100000, None, 0, None), lot("s4", 900000, "Maison", 4, "30"),
            lot("s5", 1, "Maison", 4), lot("s5", 2, "Maison", 4),
        ], TRANSACTION),
        "diagnostic_dpe": spark.createDataFrame([
            certificate("c1", "appartement", "400"), certificate("c2", "appartement", "400.01"),
            certificate("c3", "immeuble", "900"), certificate("c4", "appartement", None, 1650),
            certificate("c5", "maison", "90", None, None, "99999"),
        ], CERTIFICATE),
        "diagnostic_dpe_flux": spark.createDataFrame([
            event("c2", "500"), event("c3", "900"), event("c1", "80"), event("zz", "800"),
        ], CERTIFICATE_FLUX),
    }


def metrics(df):
    return {(r["table_name"], r["metric"]): r["metric_value"] for r in df.collect()}


def test_audit_counts(tables):
    found = metrics(audit.audit(tables))
    lots, certs, flux = "transaction_dvf", "diagnostic_dpe", "diagnostic_dpe_flux"
    assert found[(lots, "rows")] == 6
    assert found[(lots, "null(surface_reelle_bati)")] == 1
    assert found[(lots, "dwelling_without_rooms")] == 1
    assert found[(lots, "sales_with_several_prices")] == 1
    assert found[(lots, "implausible_unit_price")] == 1
    assert found[(certs, "oversized_flat")] == 1
    assert found[(certs, "very_old_building")] == 1
    assert found[(certs, "same_address_and_day_groups")] == 1
    assert found[(certs, "orphans")] == 1
    assert found[(flux, "orphans")] == 0


def test_corrections_touch_only_what_they_name(tables, rows):
    fixed = audit.corrected(tables)
    rooms = fixed["transaction_dvf"].where("id_mutation < 's4'")
    assert rows(rooms, "id_mutation", "nombre_pieces_principales") == [
        ("s1", None), ("s2", 0), ("s3", 0),
    ]
    areas = rows(fixed["diagnostic_dpe"], "numero_dpe", "surface_habitable_logement")
    assert areas[:3] == [("c1", Decimal("400.00")), ("c2", None), ("c3", Decimal("900.00"))]
    # The event is judged on its own area; its parent was already corrected.
    flux = rows(fixed["diagnostic_dpe_flux"], "numero_dpe", "surface_habitable_logement")
    assert flux == [
        ("c1", Decimal("80.00")), ("c2", None), ("c3", Decimal("900.00")),
        ("zz", Decimal("800.00")),
    ]


def test_only_corrected_metrics_move(tables):
    moved = {
        (r["table_name"], r["metric"]): (r["before_value"], r["after_value"])
        for r in audit.before_and_after(tables).where("delta <> 0").collect()
    }
    assert moved == {
        ("transaction_dvf", "dwelling_without_rooms"): (1, 0),
        ("diagnostic_dpe", "oversized_flat"): (1, 0),
        ("diagnostic_dpe", "null(surface_habitable_logement)"): (1, 2),
        ("diagnostic_dpe_flux", "null(surface_habitable_logement)"): (0, 1),
    }


def test_corrections_are_idempotent(tables):
    once = audit.corrected(tables)
    twice = audit.corrected(once)
    for name in once:
        assert once[name].exceptAll(twice[name]).count() == 0
        assert twice[name].count() == tables[name].count()


def test_decision_log(tables, rows):
    log = audit.correction_log(tables)
    found = {r["decision"]: (r["action"], r["n_rows"]) for r in log.collect()}
    assert found == {
        "dwelling_without_rooms": ("nullify", 1),
        "oversized_flat": ("nullify", 1),
        "oversized_flat_event": ("nullify", 1),
        "very_old_building": ("keep", 1),
        "implausible_unit_price": ("keep", 1),
        "missing_year": ("keep", 1),
        "missing_built_area": ("keep", 1),
    }
    assert log.where("why is null or why = ''").count() == 0


def test_unknown_predicate_keeps_the_value(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "v int, k string")
    assert rows(nullify_where(df, "v", F.col("k") == "x"), "v") == [(None,), (1,)]


def test_declared_constraints_hold_after_a_clean_load(spark, tables):
    from hearthline.operators.quality import expectation_counts

    for name in ("commune", "transaction_dvf", "diagnostic_dpe_flux"):
        declared = audit.expectations(name, tables["commune"])
        broken = expectation_counts(tables[name], declared).where("n_violations > 0")
        assert broken.count() == 0, (name, broken.collect())


def test_table_counts_and_busiest_communes(tables, rows):
    counts = verification.table_counts({n: tables[n] for n in ("commune", "transaction_dvf")})
    assert rows(counts) == [("commune", 1), ("transaction_dvf", 6)]
    top = verification.busiest_communes(
        tables["commune"], tables["transaction_dvf"], tables["diagnostic_dpe"]
    )
    assert rows(top, "nom_commune", "nb_transactions", "nb_diagnostics") == [("Nantes", 6, 4)]


def test_threshold_from_a_quantile(tables):
    p50, bound = audit.unit_price_threshold(tables["transaction_dvf"], 0.5, 2.0)
    assert p50 == pytest.approx(2000.0) and bound == pytest.approx(4000.0)


def test_paired_audit_equals_two_audits_in_the_scans_of_one(spark, tables, rows, tmp_path):
    from conftest import plan_of

    stored = {}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    paired = audit.before_and_after(stored)
    apart = quality.audit_diff(
        audit.audit(stored), audit.audit(audit.corrected(stored)),
        ["dimension", "table_name", "metric"],
    )
    assert paired.columns == apart.columns
    assert rows(paired) == rows(apart)

    def scans(df, table):
        plan = plan_of(df)
        return sum(1 for line in plan.splitlines() if "Location" in line and f"/{table}]" in line)

    for table, more in (("transaction_dvf", 0), ("diagnostic_dpe", 1)):
        assert scans(paired, table) == scans(audit.audit(stored), table) + more
    # Doubtful events meet their certificates; the others do not.
    assert scans(paired, "diagnostic_dpe_flux") <= scans(audit.audit(stored), "diagnostic_dpe_flux") + 2


def test_correction_by_parent_starts_no_job_and_leaves_most_rows_unshuffled(spark, tmp_path, rows):
    from conftest import plan_of
    from pyspark.sql import functions as F

    child = spark.range(1000).selectExpr("id % 50 as k", "cast(id as int) as v").unionByName(
        spark.createDataFrame([(None, 998), (7, None)], "k long, v int")
    )
    child.write.parquet(str(tmp_path / "child"))
    parent = spark.createDataFrame([(k % 40, k % 3) for k in range(60)], "k long, kind int")
    child = spark.read.parquet(str(tmp_path / "child"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("none", "none")
    fixed = corrections.nullify_via_join(
        child, parent, "k", "v", F.col("v") > 990, F.col("kind") == 1
    )
    assert not tracker.getJobIdsForGroup("none")
    kinds = {}
    for k in range(60):
        kinds.setdefault(k % 40, set()).add(k % 3)
    want = [
        (r["k"], None if (r["v"] or 0) > 990 and 1 in kinds.get(r["k"], ()) else r["v"])
        for r in child.collect()
    ]
    assert rows(fixed) == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
    plan = plan_of(fixed)
    assert "Union" in plan and plan.count("GreaterThan(v,990)") >= 2
    assert "Checkpoint" not in plan
