import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from hearthline.schemas import COMMUNE, EVENT, LIVE_EVENT_COLUMNS, struct, TEXT, seed_tables
from hearthline.sources import files, incremental, keyed_table, messages, pages, tables
from pyspark.sql import types as T


def test_typed_load_aborts_on_a_bad_row(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b\n1,2024-01-01\nx,2024-01-02\n")
    schema = struct(a=T.IntegerType(), b=T.DateType())
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.load_csv_typed(spark, str(path), schema).collect()
    path.write_text("a,b\n1,2024-01-01\n,\n")
    found = files.load_csv_typed(spark, str(path), schema).collect()
    assert [tuple(map(str, r)) for r in found] == [("1", "2024-01-01"), ("None", "None")]


def test_raw_copy_is_unchanged_and_traceable(spark, tmp_path, rows):
    (tmp_path / "in.csv").write_text('a,b\n1,"x, y"\n')
    landed = files.land_raw_lines(spark, str(tmp_path / "in.csv"), str(tmp_path / "raw"))
    assert rows(landed, "line") == [('1,"x, y"',), ("a,b",)]
    assert landed.first()["source_file"].endswith("in.csv")


def test_table_lifecycle(spark, tmp_path):
    path = str(tmp_path / "commune")
    assert tables.read_table(spark, path, COMMUNE).count() == 0
    tables.create_table(spark, path, COMMUNE)
    tables.append(seed_tables(spark)["commune"], path)
    tables.create_table(spark, path, COMMUNE)
    assert tables.read_table(spark, path, COMMUNE).count() == 3
    tables.create_table(spark, path, COMMUNE, replace=True)
    assert tables.read_table(spark, path, COMMUNE).count() == 0


def test_strict_cast_aborts_and_stamp_is_one_value(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    with pytest.raises(PySparkException):
        tables.cast_to(df, struct(a=T.IntegerType())).collect()
    assert tables.stamped(df).select("traite_le").distinct().count() == 1


def test_pages_from_files(spark, tmp_path, rows):
    first = {"total": 3, "next": "u", "results": [{"numero_dpe": "1", "etiquette_dpe": "A"}]}
    second = {"total": 3, "results": [{"numero_dpe": "2", "other": 5}, {"numero_dpe": "3"}]}
    empty = {"total": 3, "results": []}
    for i, page in enumerate([first, second, empty]):
        (tmp_path / f"{i}.json").write_text(json.dumps(page, indent=1))
    landed = pages.read_pages(spark, str(tmp_path), LIVE_EVENT_COLUMNS)
    found = pages.flatten_pages(landed, LIVE_EVENT_COLUMNS)
    assert rows(found, "numero_dpe", "etiquette_dpe") == [("1", "A"), ("2", ""), ("3", "")]
    assert tuple(pages.page_completeness(landed).first()) == (3, 3, True)
    partly = landed.where(F.size("results") != 1)
    assert tuple(pages.page_completeness(partly).first()) == (3, 2, False)


def test_decode_survives_bad_payloads(spark, rows):
    payloads = [
        '{"numero_dpe":"1","surface_habitable_logement":64.3,"extra":true}',
        "not json {", None, "",
    ]
    raw = spark.createDataFrame(
        [(None if p is None else bytearray(p, "utf8"), "t", 0, i) for i, p in enumerate(payloads)],
        "value binary, topic string, partition int, offset bigint",
    )
    found = messages.decode(raw)
    assert rows(found, "offset", "numero_dpe", "surface_habitable_logement") == [
        (0, "1", "64.3"), (1, None, None), (2, None, None), (3, None, None),
    ]


def test_encode_decode_round_trip(spark, rows):
    event = spark.createDataFrame([("1", "44109", None, "A", "B", "5", "live")], EVENT)
    sent = messages.encode(event, key="numero_dpe")
    assert sent.columns == ["key", "value"]
    back = messages.decode(sent).select(*EVENT.names)
    assert rows(back) == rows(event)


def test_two_shapes_become_one(spark, rows):
    seed = seed_tables(spark)["diagnostic_dpe"]
    live = spark.createDataFrame(
        [("9", "44109", "2026-02-01", "A", "B", "50")], ", ".join(
            f"{c} string" for c in LIVE_EVENT_COLUMNS)
    )
    found = messages.normalise(seed, live)
    assert found.schema.names == EVENT.names
    assert rows(found.groupBy("source_flux").count()) == [("backfill", 3), ("live", 1)]
    replayed = found.where("numero_dpe = '2344E0200001A'").first()
    assert replayed["date_reception_dpe"] == "2023-06-10"
    with pytest.raises(ValueError):
        messages.normalise(None, None)


def days(spark):
    data = [("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-02"), ("d", None),
            ("e", "2024-01-03")]
    return spark.createDataFrame(data, "id string, day string")


def test_pull_repeats_the_boundary_and_keeps_a_watermark(spark, tmp_path, rows):
    path = str(tmp_path / "mark")
    assert incremental.load_watermark(spark, path) is None
    first = incremental.pull_since(days(spark), "day", None, ["id"], limit=2)
    assert [r["id"] for r in first.collect()] == ["a", "b"]
    incremental.save_watermark(first, "day", path)
    mark = incremental.load_watermark(spark, path)
    assert mark == "2024-01-02"
    again = incremental.pull_since(days(spark), "day", mark, ["id"])
    assert rows(again, "id") == [("b",), ("c",), ("e",)]
    incremental.save_watermark(again.where("false"), "day", path)
    assert incremental.load_watermark(spark, path) == "2024-01-02"


def test_full_cursor_passes_a_crowded_day(spark):
    dated = days(spark).where("day is not null")
    cursor, seen = None, []
    while True:
        page = incremental.pull_after(dated, ["day", "id"], cursor, limit=1).collect()
        if not page:
            break
        seen.append(page[0]["id"])
        cursor = (page[0]["day"], page[0]["id"])
    assert seen == ["a", "b", "c", "e"]


def keyed(spark, data):
    return spark.createDataFrame(data, "k string, ord int, v string")


def stored(spark, path, rows):
    schema = struct(k=TEXT, ord=T.IntegerType(), v=TEXT)
    return rows(keyed_table.read_keyed(spark, path, schema), "k", "v")


def test_last_wins_in_a_batch_and_first_batch_wins(spark, tmp_path, rows):
    path = str(tmp_path / "clean")
    first = keyed(spark, [("a", 1, "old"), ("a", 2, "new"), ("b", 1, "b0")])
    inserted = keyed_table.insert_if_absent(first, path, "k", ["ord"], "q", 0)
    assert inserted.count() == 2
    second = keyed(spark, [("a", 9, "late"), ("c", 1, "c1")])
    assert keyed_table.insert_if_absent(second, path, "k", ["ord"], "q", 1).count() == 1
    assert stored(spark, path, rows) == [("a", "new"), ("b", "b0"), ("c", "c1")]


def test_replayed_batch_replaces_itself(spark, tmp_path, rows):
    path = str(tmp_path / "clean")
    batch = keyed(spark, [("a", 1, "x"), ("b", 1, "y")])
    for _ in range(3):
        keyed_table.insert_if_absent(batch, path, "k", ["ord"], "q", 0)
    assert stored(spark, path, rows) == [("a", "x"), ("b", "y")]
    # A lost checkpoint starts at batch 0 under a new query id and overwrites nothing.
    fresh = keyed(spark, [("a", 1, "other"), ("c", 1, "z")])
    keyed_table.insert_if_absent(fresh, path, "k", ["ord"], "q2", 0)
    assert stored(spark, path, rows) == [("a", "x"), ("b", "y"), ("c", "z")]


def test_empty_batch_inserts_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "clean")
    batch = keyed(spark, [("a", 1, "x")])
    keyed_table.insert_if_absent(batch, path, "k", ["ord"], "q", 0)
    none = batch.where("false")
    assert keyed_table.insert_if_absent(none, path, "k", ["ord"], "q", 1).count() == 0
    assert stored(spark, path, rows) == [("a", "x")]


def test_a_batch_without_new_keys_on_a_store_without_empty_folders(
    spark, tmp_path, rows, monkeypatch
):
    write, gone = DataFrameWriter.parquet, []

    def parquet(self, path, *args, **options):
        write(self, path, *args, **options)
        if not os.listdir(path):
            os.rmdir(path)
            gone.append(path)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        path = str(tmp_path / "clean")
        batch = keyed(spark, [("a", 1, "x"), ("b", 1, "y")])
        assert keyed_table.insert_if_absent(batch, path, "k", ["ord"], "q", 0).count() == 2
        assert keyed_table.insert_if_absent(batch, path, "k", ["ord"], "q", 1).count() == 0
        fresh = keyed(spark, [("a", 2, "late"), ("c", 1, "z")])
        assert keyed_table.insert_if_absent(fresh, path, "k", ["ord"], "q", 2).count() == 1
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert len(gone) == 1
    assert stored(spark, path, rows) == [("a", "x"), ("b", "y"), ("c", "z")]


def test_stored_keys_are_scanned_without_a_shuffle(spark, tmp_path):
    from conftest import plan_of

    path = str(tmp_path / "big")
    keyed(spark, [(str(i), 1, "x") for i in range(100)]).write.parquet(path)
    target = spark.read.parquet(path)
    batch = keyed(spark, [("5", 1, "y"), ("z", 1, "y")]).persist()
    plan = plan_of(keyed_table.absent_rows(batch, target, "k"))
    assert "ReadSchema: struct<k:string>" in plan
    assert "GreaterThanOrEqual(k,5)" in plan and "LessThanOrEqual(k,z)" in plan
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_csv_dialect_is_that_of_other_tools(spark, tmp_path, rows):
    import csv
    import io

    text = '1,"a ""b"", c",x\n2,"C:\\",y\n3,"line\nbreak",z\n'
    (tmp_path / "in.csv").write_text("k,v,w\n" + text)
    want = [tuple(r) for r in csv.reader(io.StringIO(text))]
    read = files.read_csv_text(spark, str(tmp_path / "in.csv"), ["k", "v", "w"], multi_line=True)
    assert rows(read) == want
    typed = files.load_csv_typed(
        spark, str(tmp_path / "in.csv"), struct(k=TEXT, v=TEXT, w=TEXT), multi_line=True
    )
    assert rows(typed) == want
    files.write_csv(read.coalesce(1), str(tmp_path / "out"))
    written = next((tmp_path / "out").glob("*.csv")).read_text(newline="")
    assert sorted(map(tuple, csv.reader(io.StringIO(written, newline=""))))[:3] == want


@pytest.mark.parametrize("line", ["1,2", "1,2,3,4"])
def test_rows_of_wrong_width_abort(spark, tmp_path, line):
    (tmp_path / "in.csv").write_text(f"k,v,w\na,b,c\n{line}\n")
    read = files.read_csv_text(spark, str(tmp_path / "in.csv"), ["k", "v", "w"])
    with pytest.raises(Exception, match="(?i)malformed"):
        read.select("k").collect()


def test_rows_without_a_key_are_not_inserted(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, ord int, v string"
    batch = spark.createDataFrame([(None, 1, "x"), ("a", 1, "y")], schema)
    for n in range(3):
        keyed_table.insert_if_absent(batch, path, "k", ["ord"], "q", n)
    assert [r["k"] for r in keyed_table.read_keyed(spark, path, batch.schema).collect()] == ["a"]


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, ord int, v string"
    many = spark.createDataFrame([(f"key{i}", 1, "x") for i in range(200)], schema)
    keyed_table.insert_if_absent(many, path, "k", ["ord"], "q", 0, buckets=8)
    batch = spark.createDataFrame([("key7", 2, "y"), ("new", 2, "y")], schema)
    touched = {r[0] for r in batch.select(keyed_table.bucket_of("k", 8)).collect()}
    table = keyed_table.keyed_table(path)
    parts = keyed_table.in_buckets(table.live(spark), sorted(touched))
    assert len(table.live(spark)) == 8 and len(parts) == len(touched) < 3
    read = {f.rsplit("/", 2)[1] for f in table.read(spark, many.schema, parts).inputFiles()}
    assert read == {f"bucket={b}" for b in touched}
    assert keyed_table.insert_if_absent(batch, path, "k", ["ord"], "q", 1, buckets=8).count() == 1
    with pytest.raises(ValueError, match="buckets"):
        keyed_table.insert_if_absent(batch, path, "k", ["ord"], "q", 2, buckets=2)


def test_insert_reads_no_other_bucket(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), "k string, ord int, v string"
    many = spark.createDataFrame([(f"key{i}", 1, "x") for i in range(200)], schema)
    keyed_table.insert_if_absent(many, path, "k", ["ord"], "q", 0, buckets=8)
    seen, plain = [], keyed_table.absent_rows

    def watched(batch, stored, *more):
        seen.append({f.rsplit("/", 2)[1] for f in stored.inputFiles()})
        return plain(batch, stored, *more)

    monkeypatch.setattr(keyed_table, "absent_rows", watched)
    batch = spark.createDataFrame([("key7", 2, "y")], schema)
    keyed_table.insert_if_absent(batch, path, "k", ["ord"], "q", 1, buckets=8)
    bucket = batch.select(keyed_table.bucket_of("k", 8)).first()[0]
    assert seen == [{f"bucket={bucket}"}]


def test_compaction_of_a_keyed_table_while_batches_go_on(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), "k string, ord int, v string"

    def insert(n):
        data = [(f"k{i}", 1, f"batch{n}") for i in range(n, n + 3)]
        keyed_table.insert_if_absent(
            spark.createDataFrame(data, schema), path, "k", ["ord"], "q", n, buckets=2
        )

    def content():
        kept = keyed_table.read_keyed(spark, path, spark.createDataFrame([], schema).schema)
        return rows(kept, "k", "v", "batch_id")

    for n in range(4):
        insert(n)
    before = content()
    assert keyed_table.compact(spark, path, spark.createDataFrame([], schema).schema, "k", 2) > 2
    assert content() == before and len(keyed_table.keyed_table(path).live(spark)) == 2
    insert(4)
    insert(2)
    assert [r[:2] for r in content()] == [r[:2] for r in before] + [("k6", "batch4")]


def test_a_failed_insert_is_invisible(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), "k string, ord int, v string"
    batch = spark.createDataFrame([("a", 1, "x")], schema)

    def broken(self, spark, records):
        raise OSError("no commit")

    with monkeypatch.context() as patch:
        patch.setattr(keyed_table.Commits, "add", broken)
        with pytest.raises(OSError):
            keyed_table.insert_if_absent(batch, path, "k", ["ord"], "q", 0)
    assert keyed_table.read_keyed(spark, path, batch.schema).count() == 0
    assert keyed_table.insert_if_absent(batch, path, "k", ["ord"], "q", 0).count() == 1
    assert keyed_table.read_keyed(spark, path, batch.schema).count() == 1


def test_page_end_by_range_counts_against_a_sort(spark, monkeypatch):
    import random

    monkeypatch.setattr(incremental, "PAGE_ROWS", 3)
    draw = random.Random(2)
    data = [
        (draw.choice([None, "", "2024-01-01", "2024-01-02", f"2024-02-{draw.randint(10, 28)}", "é"]),
         draw.choice(["k", "hot", "", None, "ü", "中", f"n{draw.randint(0, 60)}", "n" * 40 + str(draw.random())]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(data, "day string, id string").repartition(4)
    order = sorted((d or "", i or "") for d, i in data)
    cursored = incremental.with_cursor(df, "day", "id")
    for limit in (1, 5, 77, 200, 399):
        for buckets in (4, 4096):
            assert incremental.page_end(cursored, limit, buckets) == order[limit - 1]
    assert incremental.page_end(cursored, 400) is None
    for limit in (1, 77, 399, 400, 500):
        bounds = incremental.page_bounds(cursored, limit)
        last = order[min(limit, 400) - 1]
        n = sum(found <= last for found in order)
        assert bounds == (n, order[0][0], last, n == 400)
    assert incremental.page_bounds(cursored.where("false"), 5) is None

    cursor, seen = None, []
    while True:
        page = incremental.next_page(df, "day", "id", cursor, 50)
        found = [(r["_received"], r["_key"]) for r in page.collect()]
        if not found:
            break
        assert len(found) >= 50 or max(found) == order[-1]
        seen += found
        cursor = max(found)
    assert sorted(seen) == order


def test_a_large_page_is_a_range_filter(spark):
    from conftest import plan_of

    df = spark.range(5000).selectExpr("cast(id % 7 as string) as day", "cast(id as string) as id")
    page = incremental.next_page(df, "day", "id", ("2", "5"), 2000)
    plan = plan_of(page)
    assert page.count() == 2000
    assert not any(word in plan for word in ("TakeOrdered", "Sort", "Exchange", "Limit"))
