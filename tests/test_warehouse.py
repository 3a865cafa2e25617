import gzip
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hearthline.plans import audit, market, warehouse
from hearthline.schemas import (
    CERTIFICATE,
    EVENT,
    LIVE_EVENT_COLUMNS,
    RAW_CERTIFICATE,
    RAW_COMMUNE,
    RAW_TRANSACTION,
    REFERENCE_PRICE,
)
from hearthline.sources import files, keyed_table
from hearthline.sources.messages import decode
from hearthline.streaming import producer


def csv_text(schema, records):
    lines = [",".join(schema.names)]
    lines += [",".join(str(r.get(n, "")) for n in schema.names) for r in records]
    return "\n".join(lines) + "\n"


@pytest.fixture
def extracts(tmp_path):
    communes = [
        {"code_insee": "01001", "nom_standard": "A", "dep_code": "01"},
        {"code_insee": "44109", "nom_standard": "Nantes", "dep_code": "44"},
        {"code_insee": "44109", "nom_standard": "again", "dep_code": "44"},
    ]
    lots = [
        {"id_mutation": f"s{i}", "date_mutation": "2025-01-02", "nature_mutation": "Vente",
         "valeur_fonciere": 1000 * (i + 1), "code_commune": "44109" if i % 2 else "01001",
         "type_local": "Maison", "surface_reelle_bati": 10, "nombre_pieces_principales": i}
        for i in range(6)
    ] + [{"id_mutation": "x", "code_commune": "99999", "valeur_fonciere": 1}]
    certs = [
        {"numero_dpe": f"c{i}", "code_insee_ban": "44109", "etiquette_dpe": "FG"[i % 2],
         "etiquette_ges": "A", "date_etablissement_dpe": "2024-01-01",
         "type_batiment": "appartement", "surface_habitable_logement": 100 * (i + 1)}
        for i in range(5)
    ]
    certs.append({**certs[0], "adresse_ban": "late"})
    (tmp_path / "communes.csv").write_text(csv_text(RAW_COMMUNE, communes))
    with gzip.open(tmp_path / "lots.csv.gz", "wt") as out:
        out.write(csv_text(RAW_TRANSACTION, lots))
    (tmp_path / "certs.csv").write_text(csv_text(RAW_CERTIFICATE, certs))
    return warehouse.Extracts(*(str(tmp_path / n) for n in (
        "communes.csv", "lots.csv.gz", "certs.csv")))


def test_load_from_raw_extracts(spark, extracts, tmp_path, rows):
    tables = warehouse.load(spark, extracts, str(tmp_path / "wh"), spread=3)
    assert rows(tables[audit.COMMUNES], "code_insee", "nom_commune") == [
        ("01001", "A"), ("44109", "Nantes"),
    ]
    lots = tables[audit.TRANSACTIONS].orderBy("id_transaction")
    assert [(r["id_transaction"], r["id_mutation"], r["nombre_pieces_principales"])
            for r in lots.collect()] == [
        (1, "s0", None), (2, "s1", 1), (3, "s2", 2), (4, "s3", 3), (5, "s4", 4), (6, "s5", 5),
    ]
    assert rows(tables[audit.CERTIFICATES], "numero_dpe", "surface_habitable_logement",
                "adresse") == [
        ("c0", Decimal("100.00"), None), ("c1", Decimal("200.00"), None),
        ("c2", Decimal("300.00"), None), ("c3", Decimal("400.00"), None), ("c4", None, None),
    ]
    assert rows(tables[warehouse.PRICES]) == [("01001", 300.0, 3), ("44109", 400.0, 3)]
    assert tables[warehouse.PRICES].schema == REFERENCE_PRICE
    assert market.leaky_share_by_commune(
        tables[audit.CERTIFICATES], tables[audit.COMMUNES], at_least=1
    ).first()["pct_f_g"] == 100.0


def test_load_aborts_on_a_broken_constraint(spark, extracts, tmp_path):
    path = tmp_path / "certs.csv"
    path.write_text(path.read_text().replace(",100,", ",-100,"))
    with pytest.raises(ValueError, match="check"):
        warehouse.load(spark, extracts, str(tmp_path / "wh"))


def test_file_order_survives_redistribution(spark, tmp_path):
    path = tmp_path / "many.csv"
    path.write_text("v\n" + "\n".join(str(i) for i in range(2000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        df = files.read_csv_text(spark, str(path), ["v"], spread=5, in_order=True)
        assert df.select("_block").distinct().count() > 1
        ordered = [r["v"] for r in df.orderBy(*files.FILE_ORDER).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == [str(i) for i in range(2000)]


def test_backfill_publishes_once(spark, tmp_path, rows):
    certs = spark.createDataFrame(
        [(f"c{i}", "44109", None, "A", "B", None, None, None, None, None) for i in range(4)],
        CERTIFICATE,
    )
    files.write_csv(certs.repartition(2), str(tmp_path / "staging"))
    topic = str(tmp_path / "topic")
    for _ in range(2):
        producer.backfill(
            spark, str(tmp_path / "staging"), str(tmp_path / "mark"), {"path": topic},
            sink="parquet", max_files=1,
        ).awaitTermination()
    sent = decode(spark.read.parquet(topic)).select("key", *EVENT.names)
    assert rows(sent, "key", "numero_dpe", "source_flux") == [
        (f"c{i}", f"c{i}", "backfill") for i in range(4)
    ]


def test_polling_advances_and_repeats_the_boundary(spark, tmp_path, rows):
    def live(*days):
        data = [(f"n{d}", "44109", f"2026-01-0{d}", "A", "B", "50") for d in days]
        return spark.createDataFrame(data, ", ".join(f"{c} string" for c in LIVE_EVENT_COLUMNS))

    state, topic = str(tmp_path / "state"), {"path": str(tmp_path / "topic")}
    assert producer.poll(live(1, 2, 3), state, topic, "parquet", limit=2) == 2
    assert producer.poll(live(1, 2, 3), state, topic, "parquet") == 2
    assert producer.poll(live(1, 2, 3), state, topic, "parquet") == 1
    assert producer.poll(live(1).where("false"), state, topic, "parquet") == 0
    sent = spark.read.parquet(topic["path"]).groupBy("key").count()
    assert rows(sent) == [("n1", 1), ("n2", 2), ("n3", 2)]


def test_compacted_copy_answers_like_the_original(spark, tmp_path, rows):
    path, target = str(tmp_path / "t"), str(tmp_path / "c")
    for n in range(3):
        batch = spark.createDataFrame([(f"k{n}", n), ("k0", n)], "k string, v int")
        keyed_table.insert_if_absent(batch, path, "k", ["v"], "q", n)
    schema = batch.schema
    keyed_table.compacted_copy(spark, path, target, schema, "k")
    copied = keyed_table.read_keyed(spark, target, schema)
    assert rows(copied, "k", "v") == [("k0", 0), ("k1", 1), ("k2", 2)]
    # The last batch, replayed on the copy, adds nothing.
    keyed_table.insert_if_absent(batch, target, "k", ["v"], "q", 2)
    assert keyed_table.read_keyed(spark, target, schema).count() == 3


def test_polling_passes_a_day_larger_than_the_page(spark, tmp_path):
    rows = [(f"n{i:04}", "44109", "2026-01-02", "A", "B", "50") for i in range(50)]
    rows += [("z1", "44109", "2026-01-03", "A", "B", "50"), ("u1", "44109", None, "A", "B", "50")]
    live = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in LIVE_EVENT_COLUMNS))
    state, topic = str(tmp_path / "state"), {"path": str(tmp_path / "topic")}
    assert producer.poll_to_end(live, state, topic, "parquet", limit=20) >= 52
    sent = spark.read.parquet(topic["path"]).select("key").distinct()
    assert {r["key"] for r in sent.collect()} == {r[0] for r in rows}
    # A row that comes later on the last day is still sent.
    late = live.limit(1).withColumns({
        "numero_dpe": F.lit("a0"), "date_reception_dpe": F.lit("2026-01-03"),
    })
    producer.poll_to_end(live.union(late), state, topic, "parquet", limit=20)
    assert spark.read.parquet(topic["path"]).where("key = 'a0'").count() == 1
