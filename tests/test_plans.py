from datetime import date
from decimal import Decimal

import pytest

from conftest import plan_of
from hearthline.plans import audit, dashboards, market
from hearthline.schemas import CERTIFICATE_FLUX, COMMUNE, TRANSACTION


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    lots = [("s", date(2025, 1, 1), "Vente", Decimal(100), "44109", "Maison", Decimal(10), 3,
             None, None, None)]
    spark.createDataFrame(lots, TRANSACTION).write.parquet(f"{root}/lots")
    spark.createDataFrame([], CERTIFICATE_FLUX).write.parquet(f"{root}/flux")
    spark.createDataFrame([("44109", "Nantes", *[None] * 7)], COMMUNE).write.parquet(
        f"{root}/commune"
    )
    return {n: spark.read.parquet(f"{root}/{n}") for n in ("lots", "flux", "commune")}


def test_price_filters_and_columns_reach_the_scan(stored):
    plan = plan_of(market.price_by_commune(stored["lots"], stored["commune"]))
    for pushed in (
        "In(type_local, [Appartement,Maison])", "EqualTo(nature_mutation,Vente)",
        "GreaterThan(surface_reelle_bati,0.00)",
    ):
        assert pushed in plan
    read = "struct<id_mutation:string,nature_mutation:string,valeur_fonciere:decimal(12,2)," \
        "code_insee:string,type_local:string,surface_reelle_bati:decimal(8,2)>"
    assert f"ReadSchema: {read}" in plan
    assert "SortAggregate" not in plan


def test_rule_lists_push_their_predicate(stored):
    plan = plan_of(stored["lots"].where(audit.no_rooms()))
    assert "EqualTo(nombre_pieces_principales,0)" in plan


def test_top_lists_do_not_sort_the_table(stored):
    plan = plan_of(dashboards.latest_events(stored["flux"], stored["commune"]))
    assert "TakeOrderedAndProject" in plan
    assert "Exchange rangepartitioning" not in plan
