"""Event stream to lake layers, a keyed clean table, quarantine and a batch log.

Each micro-batch is decoded, enriched and judged once and cached; all outputs are written
by the executors. Only the few counts of the batch log are computed to one row, and that
row is written, not collected. One commit at the end of a batch makes all its outputs count
together: if the batch dies half-way, readers see none of it, and its next attempt writes anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hearthline.functions import json_row
from hearthline.operators import quality
from hearthline.plans.audit import event_rules
from hearthline.schemas import (
    BIG,
    CERTIFICATE_FLUX,
    EVENT,
    REFERENCE_PRICE,
    TEXT,
    WHOLE,
    struct,
)
from hearthline.sources.committed import BUCKET, CommittedTable, Commits, committed_once
from hearthline.sources.keyed_table import BUCKETS, stage_absent
from hearthline.sources.messages import MESSAGE, decode
from hearthline.sources.tables import read_table, stamped
from hearthline.streaming.gate import (
    CLEAN_COLUMNS,
    PRICE,
    apply_rules,
    as_audited,
    enrich,
    gate_events,
    known_codes,
    one_price_each,
    typed,
)

ARRIVAL = ["partition", "offset"]
_SOURCE = ["topic", "partition", "offset"]
BATCH_LOG = struct(received=BIG, clean=BIG, inserted=BIG)
AUDIT_LOG = struct(table_name=TEXT, rule=TEXT, severity=TEXT, action=TEXT, n_rows=BIG)
QUARANTINE = struct(
    value=T.BinaryType(), topic=TEXT, partition=WHOLE, offset=BIG, reject_reason=TEXT
)
SILVER = struct(value=TEXT)
BRONZE = T.StructType([*MESSAGE, T.StructField("ingest_date", T.DateType())])
LAYERS = {
    "bronze": BRONZE, "silver": SILVER, "quarantine": QUARANTINE, "clean": CERTIFICATE_FLUX,
    "batch_log": BATCH_LOG, "audit_log": AUDIT_LOG,
}
_DIRECTORY = {"bronze": "ingest_date", "clean": BUCKET}


#: Called after each layer of a batch is written, before the batch counts: (layer, batch id).
OnLayer = Callable[[str, int], None]


@dataclass(frozen=True)
class EventLake:
    """The pipeline's outputs below one root; only whole batches are read."""

    root: str
    buckets: int = BUCKETS

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def commits(self) -> Commits:
        return Commits(self._at("commits"))

    @property
    def checkpoint(self) -> str:
        return self._at("checkpoint")

    def layer(self, name: str) -> CommittedTable:
        return CommittedTable(self._at(name), name, self.commits)

    def _read(self, spark: SparkSession, name: str) -> DataFrame:
        return self.layer(name).read(spark, LAYERS[name])

    def read_bronze(self, spark: SparkSession) -> DataFrame:
        """Original payloads with their source position; the raw count is its count."""
        return self._read(spark, "bronze")

    def read_silver(self, spark: SparkSession) -> DataFrame:
        """Enriched events as JSON lines, before cleaning."""
        return self._read(spark, "silver")

    def read_clean(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "clean")

    def read_quarantine(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "quarantine")

    def read_batch_log(self, spark: SparkSession) -> DataFrame:
        """Per batch: events received, accepted after in-batch dedup, rows inserted."""
        return self._read(spark, "batch_log")

    def read_audit_log(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "audit_log")

    def compact(self, spark: SparkSession, min_parts: int = 8) -> dict[str, int]:
        """Merges the small parts of every layer; batches may go on. Parts replaced by layer."""
        return {
            name: self.layer(name).compact(
                spark, schema, min_parts, by=_DIRECTORY.get(name),
                order="numero_dpe" if name == "clean" else None,
            )
            for name, schema in LAYERS.items()
        }


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Reference prices; an absent table leaves events without a price."""
    return read_table(spark, path, REFERENCE_PRICE)


def start(
    messages: DataFrame,
    lake: EventLake,
    communes: Callable[[SparkSession], DataFrame],
    prices: Callable[[SparkSession], DataFrame],
    interval: str | None = "60 seconds",
    on_layer: OnLayer | None = None,
    rules: list[quality.Rule] | None = None,
) -> StreamingQuery:
    """Start the pipeline; without ``interval`` it stops once the source is drained.

    ``rules`` are counted on every batch and their actions applied to it, those of the audit
    (``audit.event_rules``) unless others are given.

    ``communes`` and ``prices`` are read anew for each batch, so a refreshed reference
    takes effect without a restart.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        process_batch(
            batch, lake, communes(spark), prices(spark), query_id, batch_id, on_layer, rules
        )

    writer = messages.writeStream.foreachBatch(process).option(
        "checkpointLocation", lake.checkpoint
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def process_batch(
    batch: DataFrame,
    lake: EventLake,
    communes: DataFrame,
    prices: DataFrame,
    query_id: str,
    batch_id: int,
    on_layer: OnLayer | None = None,
    rules: list[quality.Rule] | None = None,
) -> None:
    """Writes all layers of a batch and commits them; a batch that was committed is left alone."""
    if batch.isEmpty():
        return
    committed_once(
        lake.commits, batch.sparkSession, query_id, batch_id,
        lambda records: _staged(
            batch, lake, records, communes, prices, query_id, batch_id, on_layer,
            event_rules() if rules is None else rules,
        ),
    )


def _staged(
    batch: DataFrame,
    lake: EventLake,
    records: list[Row],
    communes: DataFrame,
    prices: DataFrame,
    query_id: str,
    batch_id: int,
    on_layer: OnLayer | None,
    rules: list[quality.Rule],
) -> list[Row]:
    """Writes the layers of a batch; returns the records that will make them count."""
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    # One row per code, so that no event is multiplied. Kept before the join: with an
    # aggregation directly below it Spark could not split a hot code.
    references = [
        reduced.persist(StorageLevel.MEMORY_AND_DISK)
        for reduced in (one_price_each(prices), known_codes(communes))
    ]
    events = enrich(decode(batch), references[0])
    acting = any(rule.action != "keep" for rule in rules)
    judged = gate_events(events, references[1]).persist(StorageLevel.MEMORY_AND_DISK)
    acted = apply_rules(judged, rules) if acting else judged
    staged: list[Row] = []

    def stage(name: str, rows: DataFrame) -> None:
        layer = lake.layer(name)
        if name == "clean":
            columns = [*CLEAN_COLUMNS, "traite_le"]
            staged.append(stage_absent(
                rows, layer, records, "numero_dpe", ARRIVAL, query_id, batch_id, columns,
                lake.buckets,
            ))
        else:
            staged.append(layer.stage(rows, query_id, batch_id, by=_DIRECTORY.get(name)))
        if on_layer:
            on_layer(name, batch_id)

    try:
        # The messages as they came, before any join.
        stage("bronze", batch.select(*MESSAGE.names, F.current_date().alias("ingest_date")))
        stage("silver", judged.select(json_row(*EVENT.names, PRICE).alias("value")))
        rejected = acted.where("reject_reason is not null")
        stage("quarantine", rejected.select("value", *_SOURCE, "reject_reason"))
        stage("clean", stamped(typed(acted.where("reject_reason is null"))))
        inserted = lake.layer("clean").read(
            batch.sparkSession, CERTIFICATE_FLUX, staged[-1]["added"]
        )
        stage("batch_log", _batch_counts(acted, inserted))
        if rules:
            seen = dict.fromkeys((r.table for r in rules), as_audited(judged))
            stage("audit_log", quality.rule_counts(seen, rules).coalesce(1))
    finally:
        judged.unpersist()
        for used in (*references, batch):
            used.unpersist()
    return staged


def _batch_counts(judged: DataFrame, inserted: DataFrame) -> DataFrame:
    accepted_keys = F.when(F.col("reject_reason").isNull(), F.col("numero_dpe"))
    counts = judged.agg(
        F.count(F.lit(1)).alias("received"), F.count_distinct(accepted_keys).alias("clean")
    ).unionByName(
        inserted.agg(F.count(F.lit(1)).alias("inserted")), allowMissingColumns=True
    )
    return counts.agg(*[F.max(c).alias(c) for c in BATCH_LOG.names]).coalesce(1)
