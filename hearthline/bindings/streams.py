"""The event pipeline, in batch and as a stream."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthline.bindings import tables as t
from hearthline.bindings.registry import query
from hearthline.operators.metrics import clean_raw_ratio
from hearthline.operators.quality import reason_counts
from hearthline.plans import audit
from hearthline.session import scratch_path
from hearthline.sources.messages import decode, replay
from hearthline.streaming import EventLake, gate_events, start
from hearthline.streaming.gate import CLEAN_COLUMNS, PRICE, enrich
from hearthline.streaming.pipeline import LAYERS

_CLEAN = """
SELECT numero_dpe, code_insee, date_reception_dpe, etiquette_dpe, etiquette_ges,
       CAST(_number AS DOUBLE) AS surface_habitable_logement, prix_m2_commune_reference,
       source_flux
FROM (SELECT *, row_number() OVER (PARTITION BY numero_dpe
                                   ORDER BY _partition DESC, event_id DESC) AS nth
      FROM gated WHERE reject_reason IS NULL) g
WHERE nth = 1"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich(decode(t.messages(spark, sf_dir)), t.prices(spark, sf_dir))
    return gate_events(enriched, t.communes(spark, sf_dir))


def _run(spark: SparkSession, sf_dir: str, **options) -> EventLake:
    """Stream all events through the pipeline into a new lake and wait until done.

    The pattern matches that one name, whether it is a file or a folder of files.
    """
    schema = t.read(spark, sf_dir, "events").schema
    events = replay(spark, f"{sf_dir}/events.parque[t]", schema, max_files=1000)
    lake = EventLake(scratch_path(spark, "lake"))
    _drain(t.as_messages(events), lake, sf_dir, **options)
    return lake


def _drain(
    messages: DataFrame, lake: EventLake, sf_dir: str, on_layer=None, rules=None, interval=None
) -> None:
    """Run the stream until its source is empty; every reference row is given twice."""
    running = start(
        messages,
        lake,
        communes=lambda s: t.communes(s, sf_dir).union(t.communes(s, sf_dir)),
        prices=lambda s: t.prices(s, sf_dir).union(
            t.prices(s, sf_dir).withColumns({
                "nb_mutations": F.lit(1).cast("bigint"), "prix_m2_moyen": F.lit(1.0),
            })
        ),
        interval=interval,
        on_layer=on_layer,
        rules=rules,
    )
    if interval:
        running.processAllAvailable()
        running.stop()
    running.awaitTermination()


def _run_in_parts(
    spark: SparkSession, sf_dir: str, parts: int = 3, drain=_drain, between=None
) -> EventLake:
    """The events in several files, each taken in by a run of its own behind the checkpoint.

    A run in the middle finds a file without rows, the last one nothing new. ``between`` is
    called with the lake after each run.
    """
    events = t.read(spark, sf_dir, "events")
    source, lake = scratch_path(spark, "parts"), EventLake(scratch_path(spark, "lake"))
    part = F.col("event_id") % parts
    taken = [events.where(part == n) for n in range(parts)]
    for rows in (*taken[:-1], events.limit(0), taken[-1], None):
        if rows is not None:
            rows.write.mode("append").parquet(source)
        stream = replay(spark, source, events.schema, max_files=1_000_000)
        drain(t.as_messages(stream), lake, sf_dir)
        if between:
            between(lake)
    return lake


@query("lookup_enrich", t.over(["gated"], f"""
SELECT event_id AS "offset", code_insee, prix_m2_commune_reference AS {PRICE} FROM gated"""))
def lookup_enrich(spark, sf_dir):
    enriched = enrich(decode(t.messages(spark, sf_dir)), t.prices(spark, sf_dir))
    return enriched.select("offset", "code_insee", PRICE)


@query("reject_reasons", t.over(["gated"], """
SELECT coalesce(reject_reason, 'accepted') AS reject_reason, COUNT(*) AS n_rows
FROM gated GROUP BY 1"""))
def reject_reasons(spark, sf_dir):
    return reason_counts(_judged(spark, sf_dir))


@query("stream_pipeline", t.over(["gated"], _CLEAN))
def stream_pipeline(spark, sf_dir):
    """The clean table after the stream has taken in every event."""
    return _run(spark, sf_dir).read_clean(spark).select(*CLEAN_COLUMNS)


_MANY_BATCHES = t.over(["gated"], """
SELECT numero_dpe, code_insee, etiquette_dpe, CAST(_number AS DOUBLE) AS surface_habitable_logement,
       CAST(dense_rank() OVER (ORDER BY event_id % 3) AS BIGINT) AS nth_batch
FROM (SELECT *, row_number() OVER (PARTITION BY numero_dpe
                 ORDER BY event_id % 3, _partition DESC, event_id DESC) AS nth
      FROM gated WHERE reject_reason IS NULL) g
WHERE nth = 1""")


@query("stream_many_batches", _MANY_BATCHES)
def stream_many_batches(spark, sf_dir):
    """First batch wins, last row in a batch wins, over runs that stop and go on."""
    return _by_batch(_run_in_parts(spark, sf_dir).read_clean(spark))


def _drain_with_failures(messages: DataFrame, lake: EventLake, sf_dir: str) -> None:
    """The same, but every second batch dies once after its first layer is written.

    Until the restarted stream has taken the batch in again, readers must see nothing of it.
    """
    spark, failed = messages.sparkSession, set()

    def fail_once(layer: str, batch_id: int) -> None:
        if batch_id % 2 == 0 and layer == "bronze" and batch_id not in failed:
            failed.add(batch_id)
            raise RuntimeError("a batch dies")

    while True:
        before = len(failed)
        try:
            return _drain(messages, lake, sf_dir, fail_once)
        except StreamingQueryException:
            if len(failed) == before:
                raise
        dead = F.col("batch_id") == max(failed)
        for layer in LAYERS:
            if not lake.layer(layer).read(spark, LAYERS[layer]).where(dead).isEmpty():
                raise AssertionError(f"{layer} shows a batch that was not committed")


@query("stream_after_failure", _MANY_BATCHES)
def stream_after_failure(spark, sf_dir):
    """The clean table of a stream whose batches died half-way, each time restarted."""
    lake = _run_in_parts(spark, sf_dir, drain=_drain_with_failures)
    return _by_batch(lake.read_clean(spark))


def _by_batch(rows: DataFrame) -> DataFrame:
    """Clean rows with the ordinal of the batch that inserted them."""
    nth = F.dense_rank().over(Window.orderBy("batch_id"))
    order = rows.select("batch_id").distinct().withColumn("nth_batch", nth.cast("bigint"))
    return rows.join(order, "batch_id").select(
        "numero_dpe", "code_insee", "etiquette_dpe",
        F.col("surface_habitable_logement").cast("double").alias("surface_habitable_logement"),
        "nth_batch",
    )


@query("stream_silver", t.over(["gated"], f"""
SELECT numero_dpe, etiquette_dpe, CAST(prix_m2_commune_reference AS DOUBLE) AS {PRICE}
FROM gated"""))
def stream_silver(spark, sf_dir):
    """The enriched events of the silver layer, before cleaning."""
    value = F.from_json("value", f"numero_dpe string, etiquette_dpe string, {PRICE} double")
    return _run(spark, sf_dir).read_silver(spark).select(value.alias("event")).select("event.*")


@query("stream_compacted", t.over(["gated"], f"""
SELECT numero_dpe, etiquette_dpe, CAST(prix_m2_commune_reference AS DOUBLE) AS {PRICE}
FROM gated"""))
def stream_compacted(spark, sf_dir):
    """The silver layer of a lake whose small files are merged after every second batch."""
    lake = _run_in_parts(
        spark, sf_dir, between=lambda lake: lake.compact(spark, min_parts=2)
    )
    value = F.from_json("value", f"numero_dpe string, etiquette_dpe string, {PRICE} double")
    return lake.read_silver(spark).select(value.alias("event")).select("event.*")


@query("stream_processing_time", """
SELECT CAST(0 AS BIGINT) AS without_time, CAST(1 AS BIGINT) AS times_per_batch""")
def stream_processing_time(spark, sf_dir):
    """Every stored row has a processing time, one per batch."""
    batches = _run_in_parts(spark, sf_dir).read_clean(spark).groupBy("batch_id").agg(
        F.count_if(F.col("traite_le").isNull()).alias("without_time"),
        F.count_distinct("traite_le").alias("times"),
    )
    return batches.agg(
        F.sum("without_time").alias("without_time"), F.max("times").alias("times_per_batch")
    )


@query("stream_quarantine", t.over(["gated"], """
SELECT event_id AS "offset", reject_reason FROM gated WHERE reject_reason IS NOT NULL"""))
def stream_quarantine(spark, sf_dir):
    return _run(spark, sf_dir).read_quarantine(spark).select("offset", "reject_reason")


@query("stream_raw_and_clean", t.over(["gated"], f"""
SELECT (SELECT COUNT(*) FROM gated) AS raw_records,
       (SELECT COUNT(*) FROM clean) AS clean_records,
       ROUND((SELECT COUNT(*) FROM clean) / (SELECT COUNT(*) FROM gated)::DOUBLE, 9)
         AS clean_ratio,
       TRUE AS raw_covers_clean""", clean=_CLEAN))
def stream_raw_and_clean(spark, sf_dir):
    lake = _run(spark, sf_dir)
    ratio = clean_raw_ratio(lake.read_bronze(spark), lake.read_clean(spark))
    return ratio.withColumn("clean_ratio", F.round("clean_ratio", 9))


@query("stream_batch_log", t.over(["gated"], f"""
SELECT (SELECT COUNT(*) FROM gated) AS received,
       (SELECT COUNT(*) FROM clean) AS clean, (SELECT COUNT(*) FROM clean) AS inserted""",
    clean=_CLEAN))
def stream_batch_log(spark, sf_dir):
    """Events received, accepted and inserted, summed over the batches.

    With several batches ``clean`` counts a key once per batch it occurs in.
    """
    log = _run(spark, sf_dir).read_batch_log(spark)
    return log.agg(*[F.sum(c).alias(c) for c in ("received", "clean", "inserted")])


@query("stream_audit", t.over(["gated"], """
SELECT 'missing_area' AS rule, COUNT(*) FILTER (WHERE _number IS NULL) AS n_rows FROM gated
UNION ALL SELECT 'missing_price', COUNT(*) FILTER (WHERE prix_m2_commune_reference IS NULL)
FROM gated
UNION ALL SELECT 'area_above_400', COUNT(*) FILTER (WHERE _number > 400) FROM gated"""))
def stream_audit(spark, sf_dir):
    """Audit rules counted inside the stream, summed over the batches."""
    log = _run(spark, sf_dir).read_audit_log(spark)
    return log.groupBy("rule").agg(F.sum("n_rows").alias("n_rows"))


def _acting_rules():
    """The audit's rules, two of them with an action."""
    return audit.with_action(
        audit.event_rules(), area_above_400="nullify", missing_price="quarantine"
    )


_ACTED = """
SELECT event_id, numero_dpe, _partition, CASE WHEN _number <= 400 THEN _number END AS area,
       coalesce(reject_reason, CASE WHEN prix_m2_commune_reference IS NULL THEN 'missing_price' END)
         AS reason
FROM gated"""


@query("stream_rule_quarantine", t.over(["gated"], """
SELECT event_id AS "offset", reason AS reject_reason FROM acted WHERE reason IS NOT NULL""",
    acted=_ACTED))
def stream_rule_quarantine(spark, sf_dir):
    """What the gate and the rules with the action quarantine hold back."""
    lake = _run(spark, sf_dir, rules=_acting_rules())
    return lake.read_quarantine(spark).select("offset", "reject_reason")


@query("stream_rule_nullified", t.over(["gated"], """
SELECT numero_dpe, CAST(area AS DOUBLE) AS surface_habitable_logement
FROM (SELECT *, row_number() OVER (PARTITION BY numero_dpe
                                   ORDER BY _partition DESC, event_id DESC) AS nth
      FROM acted WHERE reason IS NULL) a
WHERE nth = 1""", acted=_ACTED))
def stream_rule_nullified(spark, sf_dir):
    """The clean table when a rule with the action nullify empties oversized areas."""
    lake = _run(spark, sf_dir, rules=_acting_rules())
    return lake.read_clean(spark).select("numero_dpe", "surface_habitable_logement")


@query("stream_on_trigger", t.over(["gated"], _CLEAN))
def stream_on_trigger(spark, sf_dir):
    """The clean table of a stream that runs on a processing-time trigger until it has caught up."""
    return _run(spark, sf_dir, interval="1 second").read_clean(spark).select(*CLEAN_COLUMNS)
