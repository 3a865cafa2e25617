import json

import pytest
from pyspark.sql import functions as F

from hearthline.schemas import COMMUNE, REFERENCE_PRICE, struct, TEXT
from hearthline.sources.messages import MESSAGE, decode, file_messages, replay
from hearthline.streaming import EventLake, gate_events, start
from hearthline.streaming.gate import enrich
from hearthline.streaming.pipeline import process_batch, read_prices

GOOD = {
    "numero_dpe": "n1", "code_insee": "44109", "date_reception_dpe": "2024-05-01",
    "etiquette_dpe": "A", "etiquette_ges": "B", "surface_habitable_logement": "64.3",
    "source_flux": "live",
}


def payload(**changes):
    return json.dumps({**GOOD, **changes})


def message_rows(spark, payloads, first=0):
    data = [
        (None if p is None else bytearray(p, "utf8"), "t", 0, first + i, None)
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(data, MESSAGE)


def communes(spark):
    data = [(c, c, *[None] * 7) for c in ("44109", "44143")]
    return spark.createDataFrame(data, COMMUNE)


def prices(spark):
    return spark.createDataFrame([("44109", 3778.4, 12)], REFERENCE_PRICE)


@pytest.mark.parametrize(
    "changes, want",
    [
        ({}, None),
        ({"numero_dpe": None}, "missing_key"),
        ({"numero_dpe": ""}, "missing_key"),
        ({"code_insee": ""}, "missing_key"),
        ({"etiquette_dpe": None}, "bad_label"),
        ({"etiquette_dpe": ""}, "bad_label"),
        ({"etiquette_ges": "H"}, "bad_label"),
        ({"code_insee": "99999"}, "unknown_commune"),
        ({"numero_dpe": "x" * 21}, "key_too_long"),
        ({"date_reception_dpe": "2024-13-45"}, "bad_date"),
        ({"date_reception_dpe": ""}, None),
        ({"date_reception_dpe": None}, None),
        ({"surface_habitable_logement": -3}, "negative_area"),
        ({"surface_habitable_logement": "abc"}, None),
        ({"surface_habitable_logement": "nan"}, None),
        ({"surface_habitable_logement": 64.3}, None),
        ({"source_flux": "other"}, "bad_origin"),
        ({"source_flux": None}, "bad_origin"),
        # The first broken rule names the reason.
        ({"numero_dpe": None, "etiquette_dpe": "H", "code_insee": "9"}, "missing_key"),
    ],
)
def test_gate(spark, changes, want):
    events = enrich(decode(message_rows(spark, [payload(**changes)])), prices(spark))
    assert gate_events(events, communes(spark)).first()["reject_reason"] == want


def test_enrichment_without_a_price_table(spark, tmp_path):
    nothing = read_prices(spark, str(tmp_path / "absent"))
    events = enrich(decode(message_rows(spark, [payload()])), nothing)
    assert events.first()["prix_m2_commune_reference"] is None


def run(spark, source, lake):
    query = start(file_messages(spark, source, max_files=1), lake, communes, prices, interval=None)
    query.awaitTermination()
    assert query.exception() is None


def add(spark, source, payloads, first):
    message_rows(spark, payloads, first).coalesce(1).write.mode("append").parquet(source)


def test_stream_batches_restart_and_layers(spark, tmp_path, rows):
    source, lake = str(tmp_path / "in"), EventLake(str(tmp_path / "lake"))
    add(spark, source, [
        payload(), payload(surface_habitable_logement="70"), payload(numero_dpe="n2"),
        "not json {", None, payload(numero_dpe="n3", code_insee="44143"),
    ], 0)
    run(spark, source, lake)

    def clean():
        return rows(lake.read_clean(spark), "numero_dpe", F.col(
            "surface_habitable_logement").cast("double"), F.col(
            "prix_m2_commune_reference").cast("double"))

    # Last occurrence in the batch; no price for the second commune.
    assert clean() == [("n1", 70.0, 3778.4), ("n2", 64.3, 3778.4), ("n3", 64.3, None)]
    assert rows(lake.read_quarantine(spark), "offset", "reject_reason") == [
        (3, "missing_key"), (4, "missing_key"),
    ]

    # A restart takes in only what is new; the first batch's row stays.
    add(spark, source, [payload(surface_habitable_logement="1"), payload(numero_dpe="n4")], 6)
    run(spark, source, lake)
    run(spark, source, lake)
    assert [r[:2] for r in clean()] == [("n1", 70.0), ("n2", 64.3), ("n3", 64.3), ("n4", 64.3)]

    bronze = lake.read_bronze(spark)
    assert bronze.count() == 8
    broken = bronze.where("offset = 3").first()
    assert bytes(broken["value"]) == b"not json {"
    assert broken["ingest_date"] is not None
    silver = rows(lake.read_silver(spark), "value")
    assert len(silver) == 8
    assert sum('"prix_m2_commune_reference":3778.4' in r[0] for r in silver) == 5
    log = rows(lake.read_batch_log(spark), "batch_id", "received", "clean", "inserted")
    assert log == [(0, 6, 3, 3), (1, 2, 2, 1)]
    stamped = lake.read_clean(spark).where("traite_le is not null")
    assert stamped.count() == 4


def test_replayed_batch_changes_nothing(spark, tmp_path, rows):
    lake = EventLake(str(tmp_path / "lake"))
    batch = message_rows(spark, [payload(), payload(numero_dpe="n2"), "bad"])
    for _ in range(2):
        process_batch(batch, lake, communes(spark), prices(spark), "q", 0)
    assert lake.read_clean(spark).count() == 2
    assert lake.read_bronze(spark).count() == 3
    assert lake.read_quarantine(spark).count() == 1
    assert lake.read_silver(spark).count() == 3
    assert rows(lake.read_batch_log(spark), "received", "inserted") == [(3, 2)]


def test_audit_rules_run_in_the_stream(spark, tmp_path, rows):
    lake = EventLake(str(tmp_path / "lake"))
    batch = message_rows(spark, [
        payload(surface_habitable_logement="900"), payload(surface_habitable_logement=""),
        payload(code_insee="44143"),
    ])
    process_batch(batch, lake, communes(spark), prices(spark), "q", 7)
    assert rows(lake.read_audit_log(spark), "batch_id", "rule", "n_rows") == [
        (7, "area_above_400", 1), (7, "missing_area", 1), (7, "missing_price", 1),
    ]


def test_empty_batch_writes_nothing(spark, tmp_path):
    lake = EventLake(str(tmp_path / "lake"))
    process_batch(message_rows(spark, []), lake, communes(spark), prices(spark), "q", 0)
    assert not (tmp_path / "lake").exists()


def test_stream_result_does_not_depend_on_file_splits(spark, tmp_path, rows):
    payloads = [payload(numero_dpe=f"n{i}") for i in range(12)] + ["x"] * 3
    results = []
    for name, step in (("one", 15), ("many", 4)):
        source, lake = str(tmp_path / f"{name}-in"), EventLake(str(tmp_path / f"{name}-lake"))
        for first in range(0, len(payloads), step):
            add(spark, source, payloads[first:first + step], first)
        run(spark, source, lake)
        results.append(rows(lake.read_clean(spark), "numero_dpe", "etiquette_dpe"))
    assert results[0] == results[1] and len(results[0]) == 12


def test_replay_runs_once_per_checkpoint(spark, tmp_path):
    spark.range(10).select(F.col("id").cast("string").alias("v")).repartition(3).write.csv(
        str(tmp_path / "csv"), header=True
    )
    stream = replay(
        spark, str(tmp_path / "csv"), struct(v=TEXT), "csv", max_files=1, header=True
    )
    for _ in range(2):
        (
            stream.writeStream.format("parquet").trigger(availableNow=True)
            .option("checkpointLocation", str(tmp_path / "mark"))
            .start(str(tmp_path / "out")).awaitTermination()
        )
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    with pytest.raises(ValueError):
        replay(spark, "x", struct(v=TEXT), max_files=1, max_bytes="1m")


@pytest.mark.parametrize("changes", [
    {"date_reception_dpe": "2024"}, {"date_reception_dpe": "2024-01"},
    {"date_reception_dpe": "2024-01-05Tx"}, {"surface_habitable_logement": "12345678"},
])
def test_gate_rejects_short_dates_and_overflow(spark, changes):
    events = enrich(decode(message_rows(spark, [payload(**changes)])), prices(spark))
    want = "bad_date" if "date_reception_dpe" in changes else "area_too_large"
    assert gate_events(events, communes(spark)).first()["reject_reason"] == want


def test_repeated_references_do_not_multiply_events(spark, tmp_path):
    lake = EventLake(str(tmp_path / "lake"))
    twice = prices(spark).union(prices(spark).withColumn("prix_m2_moyen", F.lit(1.0)))
    codes = communes(spark).union(communes(spark))
    process_batch(message_rows(spark, [payload()]), lake, codes, twice, "q", 0)
    assert lake.read_bronze(spark).count() == lake.read_silver(spark).count() == 1
    assert lake.read_batch_log(spark).first()["received"] == 1


def test_a_batch_that_dies_is_invisible_until_it_is_done(spark, tmp_path, rows):
    lake, batch = EventLake(str(tmp_path / "lake")), message_rows(spark, [payload(), "bad"])
    layers = []

    def die(layer, batch_id):
        layers.append(layer)
        if len(layers) in (1, 5):  # after the first layer, then after the clean table
            raise RuntimeError("stop")

    for _ in range(2):
        with pytest.raises(RuntimeError):
            process_batch(batch, lake, communes(spark), prices(spark), "q", 0, die)
        for read in (lake.read_bronze, lake.read_silver, lake.read_clean, lake.read_quarantine):
            assert read(spark).count() == 0
    process_batch(batch, lake, communes(spark), prices(spark), "q", 0, die)
    assert layers == [
        "bronze", "bronze", "silver", "quarantine", "clean",
        "bronze", "silver", "quarantine", "clean", "batch_log", "audit_log",
    ]
    assert lake.read_bronze(spark).count() == 2 and lake.read_clean(spark).count() == 1
    assert rows(lake.read_batch_log(spark), "received", "clean", "inserted") == [(2, 1, 1)]


def test_compaction_keeps_rows_and_merges_files(spark, tmp_path, rows):
    lake = EventLake(str(tmp_path / "lake"), buckets=4)

    def take(n):
        batch = message_rows(spark, [payload(numero_dpe=f"n{n}"), payload(), "bad"], 3 * n)
        process_batch(batch, lake, communes(spark), prices(spark), "q", n)

    def files(layer):
        parts = lake.layer(layer).live(spark)
        return sum(len(list((tmp_path / "lake" / layer / p).rglob("*.parquet"))) for p in parts)

    def content():
        return [
            rows(lake.read_bronze(spark), "offset", "batch_id", "ingest_date"),
            rows(lake.read_silver(spark), "value", "batch_id"),
            rows(lake.read_clean(spark).drop("traite_le")),
            rows(lake.read_quarantine(spark), "offset", "reject_reason", "batch_id"),
            rows(lake.read_batch_log(spark)),
        ]

    for n in range(5):
        take(n)
    before, bronze = content(), files("bronze")
    replaced = lake.compact(spark, min_parts=2)
    assert replaced["bronze"] == 4 and replaced["clean"] >= 2
    assert content() == before
    # Two runs of two batches each, and the fifth batch as it was.
    assert len(lake.layer("bronze").live(spark)) == 3 and files("bronze") < bronze
    assert len(lake.layer("clean").live(spark)) <= 4
    older = lake.read_clean(spark)
    take(5)
    assert lake.read_clean(spark).count() == 6 and older.count() == 5
    after = content()
    assert lake.layer("bronze").remove_replaced(spark) == 4
    assert content() == after
    # A batch that was committed is not taken in again, whatever was merged meanwhile.
    take(0)
    assert content() == after


def test_rules_act_on_the_batch(spark, tmp_path, rows):
    from hearthline.plans import audit

    lake = EventLake(str(tmp_path / "lake"))
    batch = message_rows(spark, [
        payload(numero_dpe="big", surface_habitable_logement="900"),
        payload(numero_dpe="none", surface_habitable_logement=""),
        payload(numero_dpe="free", code_insee="44143"), payload(numero_dpe="huge", surface_habitable_logement="1e9"),
        payload(numero_dpe="ok"),
    ])
    rules = audit.with_action(audit.event_rules(), area_above_400="nullify", missing_price="quarantine")
    process_batch(batch, lake, communes(spark), prices(spark), "q", 0, rules=rules)
    area = F.col("surface_habitable_logement").cast("double")
    assert rows(lake.read_clean(spark), "numero_dpe", area) == [
        ("big", None), ("none", None), ("ok", 64.3),
    ]
    # The gate's own reasons come first.
    assert rows(lake.read_quarantine(spark), "offset", "reject_reason") == [
        (2, "missing_price"), (3, "area_too_large"),
    ]
    assert rows(lake.read_audit_log(spark), "rule", "action", "n_rows") == [
        ("area_above_400", "nullify", 2), ("missing_area", "keep", 1), ("missing_price", "quarantine", 1),
    ]
    assert rows(lake.read_batch_log(spark), "received", "clean", "inserted") == [(5, 3, 3)]
    with pytest.raises(ValueError, match="unknown action"):
        odd = audit.with_action(audit.event_rules(), missing_area="delete")
        process_batch(batch, lake, communes(spark), prices(spark), "q", 1, rules=odd)


def test_two_runs_of_a_processing_time_trigger(spark, tmp_path, rows):
    source, lake = str(tmp_path / "in"), EventLake(str(tmp_path / "lake"))
    add(spark, source, [payload()], 0)
    running = start(
        file_messages(spark, source, max_files=1), lake, communes, prices, interval="1 second"
    )
    try:
        running.processAllAvailable()
        add(spark, source, [payload(numero_dpe="n2")], 1)
        running.processAllAvailable()
        assert running.isActive
    finally:
        running.stop()
    assert rows(lake.read_batch_log(spark), "batch_id", "received") == [(0, 1), (1, 1)]
