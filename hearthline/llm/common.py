"""What several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import hearthline
from hearthline.session import scratch_path

_SHIPPED: set[str] = set()
#: Rows and bytes of texts that go to a Python worker at once, where the session names none: a
#: worker and the executor beside it hold some copies of a batch.
_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors' Python, once per application.

    Needed where it was neither installed there nor given by ``--py-files``. Also keeps the
    batches of texts small, which bounds memory and changes no result.
    """
    for name, value in _BATCHES.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(hearthline.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="hearthline-")) / "hearthline_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, lost executors cost nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """``df`` with ranks 1..n in ``name``, sorted in range partitions, as a table.

    The only global step adds up one row count per partition. Give a stored ``df``: the range
    bounds are found in a pass of their own.
    """
    place, part = F.monotonically_increasing_id(), F.shiftright("_place", 33)
    sorted_parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(sorted_parts.withColumn("_place", place), label).withColumn("_part", part)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_n"))
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition of the range shuffle.
    return placed.join(F.broadcast(before), "_part").select(
        *df.columns, (F.col("_n") + within + 1).alias(name)
    )


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file; the package is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def in_portions(frame: pd.DataFrame, rows: int = 8192) -> Iterator[pd.DataFrame]:
    """A task's result in frames that fit one Arrow batch each."""
    for first in range(0, len(frame), rows):
        yield frame.iloc[first : first + rows]


def whole_text(column: str = "text") -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(column), F.lit(""))


def packed(docs: DataFrame) -> DataFrame:
    """All columns in one struct ``row``, so that no added column can clash with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``row`` again, some of them replaced."""
    return df.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in columns])
