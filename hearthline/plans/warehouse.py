"""From raw extracts to corrected, typed tables on disk."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from hearthline.operators.ordering import with_dense_ids
from hearthline.operators.quality import enforce
from hearthline.plans import audit, cleaning, market
from hearthline.schemas import RAW_CERTIFICATE, RAW_COMMUNE, RAW_TRANSACTION
from hearthline.sources.files import FILE_ORDER, read_csv_text

PRICES = "prix_moyen_commune"


@dataclass(frozen=True)
class Extracts:
    """Paths of the raw files; compressed files are recognised by their name."""

    communes: str
    transactions: str
    certificates: str


def load(
    spark: SparkSession, extracts: Extracts, root: str, spread: int | None = None
) -> dict[str, DataFrame]:
    """Clean, check, correct and store all tables; returns them as stored.

    Communes come first: their codes decide which rows of the others are kept. All tables
    are staged; a broken constraint aborts the load before any table is replaced.
    ``spread`` redistributes rows of unsplittable files.
    """

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def raw(path: str, schema, spread_rows: int | None = None) -> DataFrame:
        return read_csv_text(spark, path, schema.names, spread_rows, in_order=True)

    communes = stored(
        cleaning.clean_communes(raw(extracts.communes, RAW_COMMUNE), FILE_ORDER),
        f"staging/{audit.COMMUNES}",
    )
    lots = cleaning.clean_transactions(
        raw(extracts.transactions, RAW_TRANSACTION, spread), communes, keep=FILE_ORDER
    )
    numbered = with_dense_ids(lots, FILE_ORDER, "id_transaction").drop(*FILE_ORDER)
    certificates = cleaning.clean_certificates(
        raw(extracts.certificates, RAW_CERTIFICATE, spread), communes, FILE_ORDER
    )
    staged = {
        audit.COMMUNES: communes,
        audit.TRANSACTIONS: stored(numbered, f"staging/{audit.TRANSACTIONS}"),
        audit.CERTIFICATES: stored(certificates, f"staging/{audit.CERTIFICATES}"),
    }
    for name, df in staged.items():
        enforce(df, audit.expectations(name, communes), "fail")
    wanted = [d for d in audit.decisions() if d.table in staged]
    corrected = audit.apply_corrections(staged, wanted)
    tables = {name: stored(df, name) for name, df in corrected.items()}
    prices = market.reference_prices(tables[audit.TRANSACTIONS], ["id_transaction"])
    return {**tables, PRICES: stored(prices, PRICES)}
