"""Insert-if-absent on Parquet: the first committed row of a key wins.

Rows lie in a fixed number of buckets by the hash of their key, so a batch reads the stored keys of
its own buckets only, and of these the row groups whose key range meets the batch's. A batch counts
once its commit is written: a failed attempt is invisible and a batch that was committed is not
inserted again. There must be one writer per table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.operators.dedup import keep_last
from hearthline.operators.joins import KEY_SET_BYTES, row_bytes
from hearthline.sources.committed import BUCKET, CommittedTable, Commits, committed_once

#: Choose it once per table: about the final size divided by what one task should read.
BUCKETS = 16


def keyed_table(path: str) -> CommittedTable:
    """The table at ``path`` with commits of its own."""
    return CommittedTable(f"{path.rstrip('/')}/rows", "rows", Commits(f"{path.rstrip('/')}/commits"))


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_keyed(
    spark: SparkSession, path: str, schema: T.StructType, buckets: list[int] | None = None
) -> DataFrame:
    """Stored rows with the batch that wrote them, of all buckets or those named."""
    table = keyed_table(path)
    return table.read(spark, schema, in_buckets(table.live(spark), buckets))


def in_buckets(parts: list[str], buckets: list[int] | None) -> list[str]:
    """The parts that lie in the buckets named."""
    if buckets is None:
        return parts
    ends = tuple(f"/{BUCKET}={b}" for b in buckets)
    return [p for p in parts if p.endswith(ends)]


def compact(
    spark: SparkSession, path: str, schema: T.StructType, key: str, min_parts: int = 8
) -> int:
    """Merges the parts of each bucket that holds many, sorted by key; batches may go on."""
    return keyed_table(path).compact(spark, schema, min_parts, by=BUCKET, order=key)


def compacted_copy(
    spark: SparkSession,
    path: str,
    target: str,
    schema: T.StructType,
    key: str,
    buckets: int = BUCKETS,
) -> None:
    """Rewrite a table to ``target`` as one batch, such as with another number of buckets.

    Run it between streams and go on with ``target``. A batch replayed later finds its
    keys there and inserts nothing twice.
    """
    rows = read_keyed(spark, path, schema).select(*schema.names)
    arranged = rows.withColumn(BUCKET, bucket_of(key, buckets))
    copy = keyed_table(target)
    committed_once(
        copy.commits, spark, "compacted", 0,
        lambda _: [copy.stage(arranged, "compacted", 0, by=BUCKET)],
    )


def key_summary(batch: DataFrame, key: str, buckets: int = BUCKETS) -> Row:
    """Least and greatest key, the size of all keys and the buckets they lie in; one row."""
    return batch.agg(
        F.min(key).alias("least"),
        F.max(key).alias("greatest"),
        F.coalesce(F.sum(row_bytes(key)), F.lit(0)).alias("n_bytes"),
        F.collect_set(bucket_of(key, buckets)).alias("buckets"),
    ).first()


def absent_rows(
    batch: DataFrame, stored: DataFrame, key: str, keys: DataFrame | None = None,
    summary: Row | None = None,
) -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet.

    The stored keys are reduced to those in the batch first: when the batch's keys are
    few enough to broadcast, the large table is scanned, one column of it, but not
    shuffled. Only row groups whose key range meets the batch's are read, which skips most
    of a table whose keys grow with time or which is sorted by key. ``keys`` are those of the
    batch, where they are cheaper to compute than its rows.
    """
    keys = batch.select(key) if keys is None else keys
    summary = summary or key_summary(keys, key)
    within = F.col(key).between(F.lit(summary["least"]), F.lit(summary["greatest"]))
    near = stored.select(key).where(within)
    if summary["n_bytes"] <= KEY_SET_BYTES:
        keys = F.broadcast(keys)
    present = near.join(keys, key, "left_semi")
    return batch.join(present, key, "left_anti")


def stage_absent(
    batch: DataFrame,
    table: CommittedTable,
    records: list[Row],
    key: str,
    order: list[str],
    query_id: str,
    batch_id: int,
    columns: list[str] | None = None,
    buckets: int = BUCKETS,
) -> Row:
    """Writes the last row of each new key and returns the record that would make them count.

    The batch is read up to three times: for the summary of its keys, for the keys, for the rows.
    """
    spark = batch.sparkSession
    wanted = columns or batch.columns
    needed = batch.where(F.col(key).isNotNull()).select(*dict.fromkeys([*wanted, *order]))
    rows = keep_last(needed, [key], order).select(*wanted)
    live = table.live(spark, records)
    if any(int(part.rsplit("=", 1)[1]) >= buckets for part in live):
        raise ValueError(f"the table has more than {buckets} buckets")
    keys = needed.select(key)
    summary = key_summary(keys, key, buckets)
    if live:
        stored = table.read(spark, rows.schema, in_buckets(live, summary["buckets"]))
        rows = absent_rows(rows, stored, key, keys, summary)
    return table.stage(
        rows.withColumn(BUCKET, bucket_of(key, buckets)), query_id, batch_id, by=BUCKET,
        few=summary["n_bytes"] <= KEY_SET_BYTES,
    )


def insert_if_absent(
    batch: DataFrame,
    path: str,
    key: str,
    order: list[str],
    query_id: str,
    batch_id: int,
    columns: list[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Append the last row of each new key; returns the rows this batch inserted.

    ``order`` gives the arrival order within the batch. ``columns`` are those to store. As
    under a primary key, a row without a key is not stored; the stream's gate quarantines it.
    """
    spark, table = batch.sparkSession, keyed_table(path)

    def write(records: list[Row]) -> list[Row]:
        return [
            stage_absent(
                batch, table, records, key, order, query_id, batch_id, columns, buckets
            )
        ]

    records = committed_once(table.commits, spark, query_id, batch_id, write)
    schema = batch.select(*(columns or batch.columns)).schema
    own = (F.col("query_id") == query_id) & (F.col("batch_id") == batch_id)
    return table.read(spark, schema, table.live(spark, records)).where(own).select(*schema.names)
