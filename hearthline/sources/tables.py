"""Parquet tables with declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_table(
    spark: SparkSession, path: str, schema: T.StructType, replace: bool = False
) -> None:
    """Create an empty table; an existing one is kept unless ``replace``."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("overwrite" if replace else "ignore").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``; no rows when nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema``, strictly cast: a value that does not fit is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def key_set(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def stamped(df: DataFrame, name: str = "traite_le") -> DataFrame:
    """Append the processing time, one value for the whole batch."""
    return df.withColumn(name, F.current_timestamp())
