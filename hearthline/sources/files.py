"""CSV and raw-file input and output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.schemas import all_text


FILE_ORDER = ["_file", "_block", "_row"]
#: Quotes inside a quoted value are doubled and backslashes are plain, as in RFC 4180.
DIALECT = {"header": True, "quote": '"', "escape": '"'}


def read_csv_text(
    spark: SparkSession,
    path: str,
    columns: list[str],
    spread: int | None = None,
    in_order: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with header, every column as text; ``.csv.gz`` is recognised by its name.

    ``columns`` are the header's names, in the file's order. A gzip file is read by one
    task: pass ``spread`` to redistribute its rows for the work that follows.
    ``in_order`` appends ``FILE_ORDER``, which sorts rows as they stand in the files.
    ``multi_line`` allows line ends inside quotes; such a file is read by one task. A row with
    too few or too many values aborts the read.
    """
    reader = spark.read.options(**DIALECT, mode="FAILFAST", multiLine=multi_line)
    # Without pruning each row is split in full, so its width is always checked.
    df = reader.option("columnPruning", False).schema(all_text(columns)).csv(path)
    if in_order:
        # Rows of one block are read by one task, in order.
        df = df.select(
            *columns,
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
    return df.repartition(spread) if spread else df


def load_csv_typed(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Typed CSV load that aborts on the first malformed row; empty text is NULL."""
    reader = spark.read.options(**DIALECT, mode="FAILFAST", multiLine=multi_line)
    return reader.option("columnPruning", False).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("overwrite").options(**DIALECT, compression=compression).csv(path)


def land_raw_lines(spark: SparkSession, source: str, path: str) -> DataFrame:
    """Copy text files into the lake line by line, unchanged, with their origin."""
    lines = spark.read.text(source).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file")
    )
    lines.write.mode("overwrite").parquet(path)
    return spark.read.schema(lines.schema).parquet(path)
