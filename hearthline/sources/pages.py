"""Landed pages of a paged API: ``{"total": n, "next": url, "results": [...]}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.functions import or_empty
from hearthline.schemas import all_text


def page_schema(columns: list[str]) -> T.StructType:
    return T.StructType([
        T.StructField("total", T.LongType()),
        T.StructField("next", T.StringType()),
        T.StructField("results", T.ArrayType(all_text(columns))),
    ])


def read_pages(
    spark: SparkSession, path: str, columns: list[str], one_page_per_file: bool = True
) -> DataFrame:
    """One row per landed page: a file each, or packed one page per line."""
    reader = spark.read.schema(page_schema(columns)).option("multiLine", one_page_per_file)
    return reader.json(path)


def flatten_pages(pages: DataFrame, columns: list[str]) -> DataFrame:
    """All results as rows with a fixed column list; a missing field is empty text."""
    rows = pages.select(F.explode("results").alias("r"))
    return rows.select(*[or_empty(F.col(f"r.{c}")).alias(c) for c in columns])


def page_completeness(pages: DataFrame) -> DataFrame:
    """Announced total against rows landed."""
    landed = F.sum(F.coalesce(F.size("results"), F.lit(0)))
    return pages.agg(
        F.max("total").alias("announced"), landed.cast("long").alias("landed")
    ).withColumn("complete", F.col("announced") == F.col("landed"))
