from datetime import date
from decimal import Decimal

from hearthline.plans import market
from hearthline.schemas import COMMUNE, TRANSACTION, seed_tables

LOT = ("id_mutation", "valeur_fonciere", "code_insee", "type_local", "surface_reelle_bati")


def lots(spark, data, nature="Vente"):
    full = [
        (sale, date(2025, 1, 1), nature, Decimal(price), code, kind,
         None if area is None else Decimal(str(area)), 3, None, None, None)
        for sale, price, code, kind, area in data
    ]
    return spark.createDataFrame(full, TRANSACTION)


def communes(spark, *codes):
    rest = [None] * 7
    return spark.createDataFrame([(c, f"commune {c}", *rest) for c in codes], COMMUNE)


def test_repeated_price_counts_once_per_sale(spark, rows):
    sale = lots(spark, [("s", 300000, "1", "Maison", 50)] * 3)
    found = market.sale_prices(sale)
    assert rows(found, "surface_reelle_bati", "prix_m2") == [(Decimal("150.00"), Decimal("2000"))]


def test_grains_of_a_sale_over_two_communes(spark, rows):
    data = [("s", 1000, "1", "Maison", 5), ("s", 1000, "2", "Maison", 15)]
    df = lots(spark, data)
    assert rows(market.sale_prices(df), "code_insee", "prix_m2") == [
        ("1", Decimal(200)), ("2", Decimal("66.666667")),
    ]
    first = market.reference_prices(df, ["surface_reelle_bati"])
    assert rows(first, "code_insee", "prix_m2_moyen", "nb_mutations") == [("1", 50.0, 1)]
    assert rows(market.audited_sales(df), "code_insee", "prix_m2") == [("2", Decimal(50))]


def test_lots_without_area_and_other_kinds_are_left_out(spark):
    data = [
        ("a", 100, "1", "Maison", None), ("b", 100, "1", "Maison", 0),
        ("c", 100, "1", "Dépendance", 10), ("d", 100, "1", None, 10),
    ]
    assert market.sale_prices(lots(spark, data)).count() == 0
    exchange = lots(spark, [("e", 100, "1", "Maison", 10)], nature="Echange")
    assert market.sale_prices(exchange).count() == 0
    # The audit grain looks at every kind and nature.
    assert market.audited_sales(lots(spark, data)).count() == 2


def test_communes_below_ten_sales_are_dropped(spark, rows):
    nine = [(f"a{i}", 1000, "1", "Maison", 10) for i in range(9)]
    ten = [(f"b{i}", 2000, "2", "Appartement", 10) for i in range(10)]
    found = market.price_by_commune(lots(spark, nine + ten), communes(spark, "1", "2"))
    assert rows(found) == [("commune 2", 10, 200.0)]


def test_mean_of_ratios_is_not_weighted_by_area(spark, rows):
    data = [("big", 100000, "1", "Maison", 1000), ("small", 3000, "1", "Maison", 10)]
    found = market.price_by_commune(lots(spark, data), communes(spark, "1"), at_least=1)
    assert rows(found, "prix_moyen_m2") == [(200.0,)]


def test_same_name_in_two_places_stays_apart(spark, rows):
    two = spark.createDataFrame([(c, "Saint-Denis", *[None] * 7) for c in ("1", "2")], COMMUNE)
    data = [("a", 100, "1", "Maison", 10), ("b", 900, "2", "Maison", 10)]
    found = market.price_by_commune(lots(spark, data), two, at_least=1)
    assert rows(found) == [("Saint-Denis", 1, 10.0), ("Saint-Denis", 1, 90.0)]


def test_implausible_prices(spark, rows):
    data = [("a", 160010, "1", "Maison", 10), ("b", 150000, "1", "Maison", 10)]
    found = market.implausible_prices(lots(spark, data), communes(spark, "1"))
    assert rows(found, "id_mutation", "prix_m2") == [("a", 16001.0)]


def test_text_prices_that_do_not_parse_are_skipped(spark, rows):
    df = lots(spark, [("a", 100, "1", "Maison", 10), ("b", 100, "1", "Maison", 10)])
    text = df.selectExpr(
        "* except (valeur_fonciere)",
        "if(id_mutation = 'b', 'n/a', string(valeur_fonciere)) as valeur_fonciere",
    )
    found = market.reference_prices(text, ["id_mutation"])
    assert rows(found, "prix_m2_moyen", "nb_mutations") == [(10.0, 1)]


def test_seed_rows_give_price_and_share(spark, rows):
    seed = seed_tables(spark)
    found = market.price_and_leaky_share(
        seed["transaction_dvf"], seed["diagnostic_dpe"], seed["commune"], at_least=1
    )
    assert rows(found) == [
        ("Nantes", 1, 2674.0, 1, 0.0), ("Rezé", 1, 2908.0, 1, 0.0),
        ("Saint-Nazaire", 1, 2500.0, 1, 100.0),
    ]
