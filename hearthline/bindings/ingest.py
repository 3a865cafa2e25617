"""Sources, sinks, message decoding and keyed inserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.bindings import tables as t
from hearthline.bindings.registry import instant, query
from hearthline.functions import has_key
from hearthline.operators.ordering import with_dense_ids
from hearthline.schemas import EVENT, LIVE_EVENT_COLUMNS, TEXT, TRANSACTION, struct
from hearthline.session import scratch_path
from hearthline.sources import files, incremental, keyed_table, messages, pages, tables
from hearthline.streaming import producer


@query("normalise_two_shapes", t.over(["diagnostic_dpe_flux"], """
SELECT numero_dpe, code_insee, CAST(date_reception_dpe AS VARCHAR) AS date_reception_dpe,
       etiquette_dpe, etiquette_ges,
       CAST(surface_habitable_logement AS VARCHAR) AS surface_habitable_logement, source_flux
FROM diagnostic_dpe_flux"""))
def normalise_two_shapes(spark, sf_dir):
    flux = t.flux(spark, sf_dir)
    replayed = flux.where("source_flux = 'backfill'").withColumnRenamed(
        "date_reception_dpe", "date_etablissement_dpe"
    )
    live = flux.where("source_flux = 'live'").withColumnRenamed("code_insee", "code_insee_ban")
    return messages.normalise(replayed, live.select(*LIVE_EVENT_COLUMNS))


@query("decode_json", t.over(["decoded"], f"""
SELECT event_id AS "offset", {", ".join(EVENT.names)} FROM decoded"""))
def decode_json(spark, sf_dir):
    return messages.decode(t.messages(spark, sf_dir)).select("offset", *EVENT.names)


@query("encode_json", t.over(["diagnostic_dpe_flux"], """
SELECT numero_dpe AS key,
       '{"numero_dpe":"' || numero_dpe || '","etiquette_dpe":"' || etiquette_dpe
       || '","prix":' || coalesce(CAST(prix_m2_commune_reference AS VARCHAR), 'null') || '}'
         AS value
FROM diagnostic_dpe_flux"""))
def encode_json(spark, sf_dir):
    rows = t.flux(spark, sf_dir).select(
        "numero_dpe", "etiquette_dpe", F.col("prix_m2_commune_reference").alias("prix")
    )
    return messages.encode(rows, key="numero_dpe")


def _landed_pages(spark, sf_dir):
    """Pages of 100 events, each with an announced total and one field left out at times."""
    flux = t.flux(spark, sf_dir)
    row = F.struct(
        F.col("numero_dpe"),
        F.col("code_insee").alias("code_insee_ban"),
        F.col("date_reception_dpe").cast("string").alias("date_reception_dpe"),
        F.col("etiquette_dpe"),
        F.col("etiquette_ges"),
        F.col("surface_habitable_logement").cast("string").alias("surface_habitable_logement"),
    )
    page = F.floor(F.col("numero_dpe").cast("bigint") / 100).alias("page")
    total = flux.agg(F.count(F.lit(1))).scalar()
    listed = flux.groupBy(page).agg(F.collect_list(row).alias("results"))
    return listed.select(
        total.alias("total"),
        F.concat(F.lit("?page="), (F.col("page") + 1).cast("string")).alias("next"),
        "results",
    )


def _read_landed(spark, sf_dir):
    """The pages as written to files and read again."""
    path = scratch_path(spark, "pages")
    _landed_pages(spark, sf_dir).write.mode("overwrite").json(path)
    return pages.read_pages(spark, path, LIVE_EVENT_COLUMNS, one_page_per_file=False)


@query("flatten_pages", t.over(["diagnostic_dpe_flux"], """
SELECT numero_dpe, code_insee AS code_insee_ban,
       CAST(date_reception_dpe AS VARCHAR) AS date_reception_dpe, etiquette_dpe, etiquette_ges,
       coalesce(CAST(surface_habitable_logement AS VARCHAR), '') AS surface_habitable_logement
FROM diagnostic_dpe_flux"""))
def flatten_pages(spark, sf_dir):
    return pages.flatten_pages(_read_landed(spark, sf_dir), LIVE_EVENT_COLUMNS)


@query("page_completeness", """
SELECT COUNT(*) AS announced, COUNT(*) AS landed, TRUE AS complete FROM events""")
def page_completeness(spark, sf_dir):
    return pages.page_completeness(_read_landed(spark, sf_dir))


@query("incremental_pull", f"""
SELECT event_id, {instant("ts", "ts")} FROM (
  SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10'
  ORDER BY ts, event_id LIMIT 1000) p""")
def incremental_pull(spark, sf_dir):
    since = F.lit("2024-01-10").cast("timestamp_ntz")
    events = t.read(spark, sf_dir, "events")
    return incremental.pull_since(events, "ts", since, ["event_id"]).select("event_id", "ts")


@query("incremental_watermark", """
SELECT CAST(MAX(CAST(ts AS DATE)) AS VARCHAR) AS watermark FROM (
  SELECT ts FROM events WHERE ts >= TIMESTAMP '2024-01-10' ORDER BY ts, event_id LIMIT 1000) p""")
def incremental_watermark(spark, sf_dir):
    events = t.read(spark, sf_dir, "events")
    since = F.lit("2024-01-10").cast("timestamp_ntz")
    page = incremental.pull_since(events, "ts", since, ["event_id"])
    return incremental.next_watermark(page.withColumn("day", F.col("ts").cast("date")), "day")


@query("surrogate_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey)
         AS id_transaction
FROM lineitem""")
def surrogate_key(spark, sf_dir):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return with_dense_ids(
        t.read(spark, sf_dir, "lineitem").select(*order), order, "id_transaction"
    )


_ROWS = ["l_partkey", "l_suppkey"]


def _keyed_lines(spark, sf_dir):
    key = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key")
    return t.read(spark, sf_dir, "lineitem").select(key, *_ROWS, "l_returnflag")


@query("insert_if_absent", """
SELECT line_key, l_partkey, l_suppkey, l_returnflag FROM (
  SELECT *, row_number() OVER (
           PARTITION BY line_key ORDER BY l_returnflag, l_partkey DESC, l_suppkey DESC) AS nth
  FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_key,
               l_partkey, l_suppkey, l_returnflag FROM lineitem) k) r
WHERE nth = 1""")
def insert_if_absent(spark, sf_dir):
    """All line items in three batches by return flag; the middle one runs twice.

    The last batch takes every row that is in no other, whatever its flag.
    """
    lines, path = _keyed_lines(spark, sf_dir), scratch_path(spark, "keyed")
    place = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1)
    for batch_id in (0, 1, 1, 2):
        batch = lines.where(F.coalesce(place, F.lit(2)) == batch_id)
        keyed_table.insert_if_absent(batch, path, "line_key", _ROWS, "lines", batch_id)
    return keyed_table.read_keyed(spark, path, lines.schema).select(*lines.columns)


@query("insert_null_keys", """
SELECT line_key, l_partkey, l_suppkey, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY line_key ORDER BY l_partkey DESC, l_suppkey DESC)
           AS nth
  FROM (SELECT CASE WHEN l_linenumber > 1 THEN
                 CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END
                 AS line_key, l_partkey, l_suppkey, l_returnflag FROM lineitem) k
  WHERE line_key IS NOT NULL) r
WHERE nth = 1""")
def insert_null_keys(spark, sf_dir):
    """The same rows in two batches; those without a key are never stored."""
    lines, path = _keyed_lines(spark, sf_dir), scratch_path(spark, "null-keys")
    lines = lines.withColumn("line_key", F.when(~F.col("line_key").endswith("-1"), F.col("line_key")))
    for batch_id in (0, 1):
        keyed_table.insert_if_absent(lines, path, "line_key", _ROWS, "lines", batch_id)
    return keyed_table.read_keyed(spark, path, lines.schema).select(*lines.columns)


_TOPIC = struct(key=TEXT, value=TEXT)


@query("poll_to_end", """
SELECT CAST(event_id AS VARCHAR) AS numero_dpe,
       CASE WHEN event_id % 10 <> 0 THEN
         CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) END AS date_reception_dpe
FROM events""")
def poll_to_end(spark, sf_dir):
    """All events by polling through a stored cursor, though months hold more than a page.

    Rows that were sent again at a boundary count once, as in the keyed table downstream.
    """
    events = t.read(spark, sf_dir, "events").withColumns({
        "date_reception_dpe": F.when(
            F.col("event_id") % 10 != 0, F.date_trunc("month", "ts").cast("date").cast("string")
        ),
        "numero_dpe": F.col("event_id").cast("string"),
    })
    rows = events.select(
        "numero_dpe", "date_reception_dpe",
        *(F.lit(None).cast("string").alias(c) for c in LIVE_EVENT_COLUMNS
          if c not in ("numero_dpe", "date_reception_dpe")),
    )
    page = max(1, -(-rows.count() // 9))
    state, sent = scratch_path(spark, "cursor"), scratch_path(spark, "topic")
    tables.create_table(spark, state, incremental.CURSOR)
    tables.create_table(spark, sent, _TOPIC)
    producer.poll_to_end(rows, state, {"path": sent}, "parquet", page)
    topic = tables.read_table(spark, sent, _TOPIC).select(F.from_json("value", EVENT).alias("event"))
    return topic.select("event.numero_dpe", "event.date_reception_dpe").distinct()


_CSV_SQL = t.over(["transaction_dvf"], """
SELECT CAST(id_mutation AS VARCHAR) AS id_mutation,
       CAST(date_mutation AS VARCHAR) AS date_mutation, nature_mutation,
       CAST(valeur_fonciere AS DOUBLE) AS valeur_fonciere, code_insee, type_local,
       CAST(surface_reelle_bati AS DOUBLE) AS surface_reelle_bati,
       CAST(nombre_pieces_principales AS DOUBLE) AS nombre_pieces_principales,
       CAST(surface_terrain AS DOUBLE) AS surface_terrain,
       CAST(longitude AS DOUBLE) AS longitude, CAST(latitude AS DOUBLE) AS latitude
FROM transaction_dvf""")


@query("csv_roundtrip", _CSV_SQL)
def csv_roundtrip(spark, sf_dir):
    """Staging CSV written, loaded with declared types and kept as a Parquet table."""
    staging, table = scratch_path(spark, "staging"), scratch_path(spark, "table")
    files.write_csv(t.transactions(spark, sf_dir).select(*TRANSACTION.names), staging)
    tables.create_table(spark, table, TRANSACTION)
    tables.append(files.load_csv_typed(spark, staging, TRANSACTION), table)
    return tables.read_table(spark, table, TRANSACTION)


_STRICT = {
    "l_linenumber": "int", "l_shipdate": "date", "l_returnflag": "int", "l_comment": "smallint",
    "l_linestatus": "double",
}


@query("strict_cast_aborts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE {holds}) AS BIGINT) AS n_loaded, "
    f"{str(not whole).upper()} AS aborted FROM lineitem"
    for c, whole, holds in (
        ("l_linenumber", True, "TRUE"), ("l_shipdate", True, "TRUE"),
        ("l_returnflag", False, "FALSE"), ("l_comment", False, "FALSE"),
        ("l_linestatus", False, "FALSE"),
    )))
def strict_cast_aborts(spark, sf_dir):
    """Loads with declared types: a column with one bad value stops its load, which stores nothing.

    ``l_comment`` stands for a column of numbers with a single text among them.
    """
    lines = t.read(spark, sf_dir, "lineitem")
    worst = lines.agg(F.max(F.struct("l_orderkey", "l_linenumber"))).first()[0]
    bad = (F.col("l_orderkey") == worst[0]) & (F.col("l_linenumber") == worst[1])
    number = F.col("l_linenumber").cast("string")
    lines = lines.withColumn("l_comment", F.when(bad, F.lit("n/a")).otherwise(number))
    results = []
    for column, kind in _STRICT.items():
        path, schema = scratch_path(spark, "strict"), T.StructType.fromDDL(f"{column} {kind}")
        tables.create_table(spark, path, schema)
        text = lines.select(F.col(column).cast("string").alias(column))
        aborted = False
        try:
            tables.append(tables.cast_to(text, schema), path)
        except Exception as error:
            if "CAST_INVALID_INPUT" not in str(error):
                raise
            aborted = True
        stored = tables.read_table(spark, path, schema)
        results.append(stored.agg(F.count(F.lit(1)).alias("n_loaded")).select(
            F.lit(column).alias("column_name"), "n_loaded", F.lit(aborted).alias("aborted")
        ))
    return reduce(DataFrame.unionByName, results)


@query("csv_text_gzip", t.over(["diagnostic_dpe"], """
SELECT numero_dpe, code_insee,
       CAST(surface_habitable_logement AS VARCHAR) AS surface_habitable_logement,
       '"a, ""b""\\ ' || adresse || chr(10) || '\\' AS adresse
FROM diagnostic_dpe"""))
def csv_text_gzip(spark, sf_dir):
    """Compressed CSV with quotes, commas, backslashes and line ends, read back as text."""
    columns = ["numero_dpe", "code_insee", "surface_habitable_logement", "adresse"]
    path = scratch_path(spark, "gzip")
    rows = t.certificates(spark, sf_dir).select(*columns)
    awkward = F.concat(F.lit('"a, ""b""\\ '), "adresse", F.lit("\n\\"))
    files.write_csv(rows.withColumn("adresse", awkward), path, "gzip")
    return files.read_csv_text(spark, path, columns, multi_line=True)


@query("raw_lines_copy", """
SELECT CAST(s_suppkey AS VARCHAR) || ',' || s_name AS line FROM supplier""")
def raw_lines_copy(spark, sf_dir):
    source, lake = scratch_path(spark, "source"), scratch_path(spark, "raw")
    supplier = t.read(spark, sf_dir, "supplier")
    lines = supplier.select(F.concat_ws(",", "s_suppkey", "s_name").alias("value"))
    lines.write.mode("overwrite").text(source)
    return files.land_raw_lines(spark, source, lake).select("line")


@query("missing_keys", t.over(["decoded"], """
SELECT COUNT(*) AS n_events,
       COUNT(*) FILTER (WHERE coalesce(numero_dpe, '') = '') AS n_without_key
FROM decoded"""))
def missing_keys(spark, sf_dir):
    decoded = messages.decode(t.messages(spark, sf_dir))
    return decoded.agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(~has_key("numero_dpe")).alias("n_without_key"),
    )


@query("known_keys", t.over(["commune"], "SELECT DISTINCT code_insee FROM commune"))
def known_keys(spark, sf_dir):
    return tables.key_set(t.communes(spark, sf_dir), "code_insee")
