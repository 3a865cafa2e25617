"""Checks after a load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.operators.joins import counts_per_key
from hearthline.operators.ordering import top_k


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def busiest_communes(
    communes: DataFrame, transactions: DataFrame, certificates: DataFrame, k: int = 10
) -> DataFrame:
    """Transactions and certificates per commune, by number of transactions."""
    counted = counts_per_key(
        communes.select("code_insee", "nom_commune"),
        "code_insee",
        {"nb_transactions": transactions, "nb_diagnostics": certificates},
    )
    return top_k(counted, k, F.col("nb_transactions").desc(), F.col("code_insee").asc())
