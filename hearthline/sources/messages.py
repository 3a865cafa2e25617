"""Message streams: Kafka or files in, JSON decode, shape normalisation, JSON out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hearthline.functions import json_row
from hearthline.schemas import BIG, EVENT, TEXT, WHOLE, struct

MESSAGE = struct(
    value=T.BinaryType(), topic=TEXT, partition=WHOLE, offset=BIG, timestamp=T.TimestampType()
)


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, per_batch: int = 1_000_000
) -> DataFrame:
    """Topic as a stream from its earliest offset, with a bound on each micro-batch.

    Needs Spark's Kafka connector on the class path.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_batch)
        .load()
        .select(*MESSAGE.names)
    )


def file_messages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The same columns from Parquet files, each read once per checkpoint."""
    return replay(spark, path, MESSAGE, max_files=max_files)


def replay(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
    max_files: int | None = None, max_bytes: str | None = None, **options,
) -> DataFrame:
    """A stored table as a bounded-rate stream; the checkpoint makes it run once only."""
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    if max_files and max_bytes:
        raise ValueError("bound a batch by files or by bytes, not both")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def decode(messages: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """Payload fields beside the message columns; a malformed payload gives NULL fields.

    The parsed struct goes through ``inline``: otherwise a later filter on its fields would
    be moved below the projection and parse the payload again for each field it uses.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(*messages.columns, F.inline(F.array(parsed)))


def normalise(
    backfill: DataFrame | None, live: DataFrame | None
) -> DataFrame:
    """Replayed certificates and live API rows in one event shape, tagged by origin.

    A replayed row reports its issue date as reception date.
    """
    shapes = []
    if backfill is not None:
        shapes.append(_event(backfill, "code_insee", "date_etablissement_dpe", "backfill"))
    if live is not None:
        shapes.append(_event(live, "code_insee_ban", "date_reception_dpe", "live"))
    if not shapes:
        raise ValueError("no event source given")
    return shapes[0] if len(shapes) == 1 else shapes[0].unionByName(shapes[1])


def _event(df: DataFrame, commune: str, received: str, origin: str) -> DataFrame:
    renamed = {"code_insee": commune, "date_reception_dpe": received}
    fields = [
        F.col(renamed.get(name, name)).cast("string").alias(name)
        for name in EVENT.names
        if name != "source_flux"
    ]
    return df.select(*fields, F.lit(origin).alias("source_flux"))


def encode(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON ``value``, optionally keyed so that one key keeps its order."""
    value = json_row(*df.columns).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).alias("key"), value)


def publish(
    df: DataFrame,
    options: dict[str, str],
    key: str | None = None,
    sink: str = "kafka",
    checkpoint: str | None = None,
    interval: str | None = None,
) -> StreamingQuery | None:
    """Send rows as JSON messages; ``options`` name the servers and topic, or a path.

    A streaming ``df`` needs a ``checkpoint``; it returns its query, which stops once the
    source is drained unless an ``interval`` is given.
    """
    rows = encode(df, key)
    if not df.isStreaming:
        rows.write.format(sink).options(**options).mode("append").save()
        return None
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = rows.writeStream.format(sink).options(**options)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
