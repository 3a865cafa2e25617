"""Declared schemas, value domains and seed rows of the housing and energy tables."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed values.
ENERGY_LABELS = ["A", "B", "C", "D", "E", "F", "G"]
LEAKY_LABELS = ["F", "G"]
DWELLING_TYPES = ["Maison", "Appartement"]
SALE_NATURE = "Vente"
FLAT_BUILDING = "appartement"
EVENT_ORIGINS = ["backfill", "live"]
CONSTRUCTION_PERIODS = [
    "avant 1948", "1948-1974", "1975-1977", "1978-1982", "1983-1988",
    "1989-2000", "2001-2005", "2006-2012", "2013-2021", "après 2021",
]
PRICE_BAND_EDGES = [2000, 3000, 4000]
PRICE_BAND_LABELS = ["< 2000", "2000-3000", "3000-4000", ">= 4000"]
MIN_GROUP_SIZE = 10
MAX_FLAT_AREA = 400
OLDEST_EXPECTED_YEAR = 1700
MAX_UNIT_PRICE = 15000


TEXT, DAY, WHOLE, BIG = T.StringType(), T.DateType(), T.IntegerType(), T.LongType()


def struct(**columns: T.DataType) -> T.StructType:
    """Schema of nullable columns, in the order given."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def all_text(columns: list[str]) -> T.StructType:
    """Schema reading every column as text, for scans that coerce later."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


COMMUNE = struct(
    code_insee=TEXT,
    nom_commune=TEXT,
    code_postal=TEXT,
    epci_code=TEXT,
    epci_nom=TEXT,
    dep_code=TEXT,
    dep_nom=TEXT,
    reg_code=TEXT,
    reg_nom=TEXT,
)

# Loaded columns; the generated id_transaction comes from ordering.with_dense_ids.
TRANSACTION = struct(
    id_mutation=TEXT,
    date_mutation=DAY,
    nature_mutation=TEXT,
    valeur_fonciere=T.DecimalType(12, 2),
    code_insee=TEXT,
    type_local=TEXT,
    surface_reelle_bati=T.DecimalType(8, 2),
    nombre_pieces_principales=T.ShortType(),
    surface_terrain=T.DecimalType(10, 2),
    longitude=T.DecimalType(9, 6),
    latitude=T.DecimalType(9, 6),
)

CERTIFICATE = struct(
    numero_dpe=TEXT,
    code_insee=TEXT,
    date_etablissement_dpe=DAY,
    etiquette_dpe=TEXT,
    etiquette_ges=TEXT,
    annee_construction=WHOLE,
    periode_construction=TEXT,
    type_batiment=TEXT,
    surface_habitable_logement=T.DecimalType(8, 2),
    adresse=TEXT,
)

CERTIFICATE_FLUX = struct(
    numero_dpe=TEXT,
    code_insee=TEXT,
    date_reception_dpe=DAY,
    etiquette_dpe=TEXT,
    etiquette_ges=TEXT,
    surface_habitable_logement=T.DecimalType(8, 2),
    prix_m2_commune_reference=T.DecimalType(10, 2),
    source_flux=TEXT,
    traite_le=T.TimestampType(),
)

REFERENCE_PRICE = struct(
    code_insee=TEXT,
    prix_m2_moyen=T.DoubleType(),
    nb_mutations=BIG,
)

EVENT = all_text([
    "numero_dpe", "code_insee", "date_reception_dpe", "etiquette_dpe",
    "etiquette_ges", "surface_habitable_logement", "source_flux",
])

RAW_COMMUNE = all_text([
    "code_insee", "nom_standard", "code_postal", "epci_code", "epci_nom",
    "dep_code", "dep_nom", "reg_code", "reg_nom",
])

RAW_TRANSACTION = all_text([
    "id_mutation", "date_mutation", "nature_mutation", "valeur_fonciere", "code_commune",
    "type_local", "surface_reelle_bati", "nombre_pieces_principales", "surface_terrain",
    "longitude", "latitude",
])

RAW_CERTIFICATE = all_text([
    "numero_dpe", "code_insee_ban", "code_postal_ban", "date_etablissement_dpe",
    "etiquette_dpe", "etiquette_ges", "annee_construction", "periode_construction",
    "type_batiment", "surface_habitable_logement", "adresse_ban",
])

LIVE_EVENT_COLUMNS = [
    "numero_dpe", "code_insee_ban", "date_reception_dpe", "etiquette_dpe",
    "etiquette_ges", "surface_habitable_logement",
]

TABLES = {
    "commune": COMMUNE,
    "transaction_dvf": TRANSACTION,
    "diagnostic_dpe": CERTIFICATE,
    "diagnostic_dpe_flux": CERTIFICATE_FLUX,
    "prix_moyen_commune": REFERENCE_PRICE,
}


def seed_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Nine literal rows for smoke checks (fixed values)."""
    communes = [
        ("44109", "Nantes", "44000", "244400404", "Nantes Métropole",
         "44", "Loire-Atlantique", "52", "Pays de la Loire"),
        ("44184", "Saint-Nazaire", "44600", "244400323", "CARENE",
         "44", "Loire-Atlantique", "52", "Pays de la Loire"),
        ("44143", "Rezé", "44400", "244400404", "Nantes Métropole",
         "44", "Loire-Atlantique", "52", "Pays de la Loire"),
    ]
    d = Decimal
    transactions = [
        ("2025-563765", date(2025, 1, 3), "Vente", d("115000"), "44109", "Appartement",
         d("43"), 3, None, d("-1.538267"), d("47.232243")),
        ("2025-570012", date(2025, 2, 14), "Vente", d("245000"), "44184", "Maison",
         d("98"), 5, d("620"), d("-2.213500"), d("47.273300")),
        ("2025-571890", date(2025, 3, 2), "Vente", d("189000"), "44143", "Appartement",
         d("65"), 3, None, d("-1.550100"), d("47.183900")),
    ]
    certificates = [
        ("2644E0039039K", "44109", date(2026, 1, 7), "C", "C", 2020, "2013-2021",
         "appartement", d("64.3"), "20 Route de Carquefou 44300 Nantes"),
        ("2244E0139144L", "44143", date(2022, 1, 19), "C", "A", 2008, "2006-2012",
         "appartement", d("56.7"), "21 Rue Benoît Chupiet 44400 Rezé"),
        ("2344E0200001A", "44184", date(2023, 6, 10), "F", "F", 1975, "1975-1977",
         "maison", d("98.0"), "5 Rue de la Plage 44600 Saint-Nazaire"),
    ]
    return {
        "commune": spark.createDataFrame(communes, COMMUNE),
        "transaction_dvf": spark.createDataFrame(transactions, TRANSACTION),
        "diagnostic_dpe": spark.createDataFrame(certificates, CERTIFICATE),
    }
