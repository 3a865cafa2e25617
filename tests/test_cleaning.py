import pytest

from hearthline.operators.quality import reason_counts
from hearthline.plans import cleaning
from hearthline.schemas import RAW_CERTIFICATE, RAW_COMMUNE, RAW_TRANSACTION
from hearthline.sources import files


def raw(spark, schema, records, extra=()):
    names = [*schema.names, *extra]
    data = [tuple(r.get(n) for n in names) for r in records]
    ddl = ", ".join(
        [f"{n} string" for n in schema.names] + [f"{n} int" for n in extra]
    )
    return spark.createDataFrame(data, ddl)


@pytest.fixture
def communes(spark):
    return raw(spark, RAW_COMMUNE, [
        {"code_insee": "01001", "nom_standard": "first", "dep_code": "01", "row": 1},
        {"code_insee": "01001", "nom_standard": "second", "dep_code": "01", "row": 2},
        {"code_insee": None, "nom_standard": "nowhere", "row": 3},
        {"code_insee": "44109", "nom_standard": "Nantes", "dep_code": "44", "row": 4},
    ], ["row"])


def test_communes_keep_the_first_row_and_leading_zeros(communes, rows):
    found = cleaning.clean_communes(communes, ["row"])
    assert rows(found, "code_insee", "nom_commune") == [("01001", "first"), ("44109", "Nantes")]


def test_transactions(spark, communes, rows):
    lots = raw(spark, RAW_TRANSACTION, [
        {"id_mutation": "1", "code_commune": "44109", "valeur_fonciere": "100000",
         "surface_reelle_bati": "abc", "nombre_pieces_principales": "3.0"},
        {"id_mutation": "2", "code_commune": "44109", "valeur_fonciere": "gratuit"},
        {"id_mutation": "3", "code_commune": "75056", "valeur_fonciere": "5"},
        {"id_mutation": "4", "code_commune": None, "valeur_fonciere": "5"},
    ])
    staged = cleaning.clean_communes(communes, ["row"])
    found = cleaning.clean_transactions(lots, staged)
    assert rows(found, "id_mutation", "surface_reelle_bati", "nombre_pieces_principales") == [
        ("1", None, 3)
    ]
    outcomes = reason_counts(cleaning.transaction_outcomes(lots, staged))
    assert rows(outcomes) == [("accepted", 1), ("no_price", 1), ("unknown_commune", 2)]


def test_certificates(spark, communes, rows):
    base = {"code_insee_ban": "44109", "etiquette_dpe": "A", "etiquette_ges": "B"}
    certs = raw(spark, RAW_CERTIFICATE, [
        {**base, "numero_dpe": "x", "adresse_ban": "1 rue", "annee_construction": "1990", "row": 1},
        {**base, "numero_dpe": "x", "adresse_ban": "2 rue", "row": 2},
        {**base, "numero_dpe": "h", "etiquette_dpe": "H", "row": 3},
        {**base, "numero_dpe": "n", "etiquette_ges": None, "row": 4},
        {**base, "numero_dpe": "e", "etiquette_ges": "", "row": 5},
        {**base, "numero_dpe": "f", "code_insee_ban": "99999", "row": 6},
    ], ["row"])
    staged = cleaning.clean_communes(communes, ["row"])
    found = cleaning.clean_certificates(certs, staged, ["row"])
    assert rows(found, "numero_dpe", "adresse", "annee_construction") == [("x", "1 rue", 1990)]


def test_from_gzip_csv_to_staging(spark, communes, tmp_path, rows):
    import gzip

    path = tmp_path / "lots.csv.gz"
    header = ",".join(RAW_TRANSACTION.names)
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write(f"{header}\n1,2025-01-02,Vente,100,44109,Maison,10,2,,,\n")
    lots = files.read_csv_text(spark, str(path), RAW_TRANSACTION.names, spread=2)
    found = cleaning.clean_transactions(lots, cleaning.clean_communes(communes, ["row"]))
    files.write_csv(found, str(tmp_path / "staging"))
    loaded = files.load_csv_typed(spark, str(tmp_path / "staging"), found.schema)
    assert rows(loaded) == rows(found)
    assert loaded.schema == found.schema
