
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hearthline.llm import cotraining as co


def area(truth, score):
    rank = pd.Series(score).rank().to_numpy()
    ones = (truth == 1).sum()
    return (rank[truth == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(truth) - ones))


def test_held_out_areas_of_the_defaults(spark):
    """What ships, against the same views without any exchange."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    some = docs.where(held).join(labels.select("doc_id"), "doc_id", "left_semi")
    truth = labels.toPandas().rename(columns={"quality": "y", "toxic": "t"})
    areas = []
    for options in ({"rounds": 0}, {}):
        models = co.fit(docs, labels.where(~held), **options)
        rows = co.scores(some, models).toPandas().merge(truth, on="doc_id")
        assert rows.drop(columns="doc_id").stack().between(0, 1).all()
        areas.append([area(rows[a].to_numpy(), rows[b]) for a, b in (
            ("y", "quality"), ("t", "toxic"), ("y", "quality_by_text"),
        )])
    alone, together = areas
    assert together[0] > 0.999 and together[1] > 0.94 and together[2] > 0.99
    assert all(b >= a - 1e-4 for a, b in zip(alone, together))


def test_a_view_that_tells_nothing_hands_nothing_over():
    draw = np.random.default_rng(4)
    truth = (draw.random(2000) < 0.1).astype(float)
    text = draw.poisson(1, (2000, 8))
    text[:, 0] += (5 * truth).astype(int)
    meta = draw.normal(size=(2000, 5))
    given = []
    real = co.Lessons.give
    co.Lessons.give = lambda self, taker, rows, pseudo: (
        given.append((taker, len(rows))), real(self, taker, rows, pseudo)
    )
    try:
        text = co.prepared_text(text)
        calibration = np.arange(600) % 5 == 0
        model = co.CoTrained(text, meta, truth[:600], calibration)
    finally:
        co.Lessons.give = real
    assert given and all(n == 0 for taker, n in given if taker == 0)
    alone = co.CoTrained(text, meta, truth[:600], calibration, rounds=0)
    score = lambda m: area(truth[600:], m.score(text[600:], meta[600:])[0])
    assert score(model) >= score(alone) - 0.005


def test_surest_by_bands_against_brute_force():
    draw = np.random.default_rng(5)
    for _ in range(50):
        n = draw.integers(0, 200)
        given, taken = draw.normal(0, 4, n).round(1), draw.normal(0, 2, n)
        prior, wanted = float(draw.normal()), (int(draw.integers(0, 30)), int(draw.integers(0, 30)))
        rows, pseudo = co.surest(given, taken, prior, wanted)
        want = []
        for one in (1, 0):
            for low, high in zip((0, *co.BANDS), (*co.BANDS, 1.1)):
                held = [
                    i for i in range(n)
                    if low < 1 / (1 + np.exp(-taken[i])) <= high
                    and (given[i] if one else -given[i]) >= np.log(9)
                    and (given[i] - prior if one else prior - given[i]) >= 1
                ]
                held.sort(key=lambda i: (-abs(given[i]), i))
                want += [(i, one) for i in held[: -(-wanted[one] // 5)]]
        assert list(zip(rows, pseudo)) == want


def test_views_exchange_labels():
    draw = np.random.default_rng(0)
    truth = draw.integers(0, 2, 600)
    text = draw.poisson(1, (600, 8)) * 1
    text[:, 0] += 6 * truth
    meta = draw.normal(size=(600, 5))
    meta[:, 1] += 4 * truth
    first = np.arange(600) < 100
    calibration = np.arange(100) % 5 == 0
    text = co.prepared_text(text)
    model = co.CoTrained(text, meta, truth[first].astype(float), calibration)
    both, by_text, by_meta = model.score(text[~first], meta[~first])
    assert area(truth[~first], both) >= max(area(truth[~first], by_text), area(truth[~first], by_meta)) - 0.01
    assert area(truth[~first], both) > 0.97


def test_awkward_labels_and_empty_tables(spark, docs, no_docs):
    schema = "doc_id long, quality int, toxic int, fp int"
    one_class = spark.createDataFrame([(5, 1, 0, 1), (8, 1, None, 1), (99, 0, 1, 1)], schema)
    rows = co.scores(docs, co.fit(docs, one_class)).collect()
    assert len(rows) == docs.count() and {r["quality"] for r in rows} == {1.0}
    none = co.fit(docs, one_class.limit(0))
    assert {r["toxic"] for r in co.scores(docs, none).collect()} == {0.5}
    assert co.scores(no_docs, none).count() == 0
    assert co.fit(no_docs, one_class)["quality"].prior == 0.5


def test_metadata_of_odd_texts():
    for text in ("", "\n\n", "a" * 100_000, "é😀"):
        found = co.metadata_view(text, None, None)
        assert np.isfinite(found).all() and len(found) == co.LAYOUT + 2 * co.BUCKETS


def test_surest_of_all_unlabelled_documents_are_exchanged(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("doc_id % 3 = 0")
    # One unlabelled text many times over: copies must not fill the exchange.
    copied = docs.join(labels, "doc_id", "left_anti").orderBy("doc_id").limit(1)
    docs = docs.unionByName(copied.crossJoin(spark.range(200)).drop("id"))
    given = []
    give = co.Lessons.give
    monkeypatch.setattr(
        co.Lessons, "give", lambda self, *args: (given.append(args), give(self, *args))
    )
    first = co.fit(docs, labels, targets=("quality",), rounds=0)["quality"]
    assert given == []
    co.fit(docs, labels, targets=("quality",), rounds=1)
    others = docs.join(labels, "doc_id", "left_anti").toPandas()
    others = others.drop_duplicates(["text", "lang", "source"])
    text = co.prepared_text(np.array([co.text_view(t or "") for t in others["text"]]))
    meta = np.array([
        co.metadata_view(t or "", l, s)
        for t, l, s in zip(others["text"], others["lang"], others["source"])
    ])
    assert len(others) > co.EXCHANGED
    odds = first.calibrated(text, meta)
    assert any(len(rows) for _, rows, _ in given)
    for (giver, taker), (to, rows, pseudo) in zip(co.EXCHANGES, given):
        want, labelled = co.surest(
            odds[giver], odds[taker], first.prior_odds(), first.wanted(co.EXCHANGED)
        )
        assert to == taker and sorted(pseudo) == sorted(labelled)
        sums = lambda x: np.sort(x.sum(axis=1))
        assert np.allclose(sums(rows), sums((text, meta)[taker][want]), rtol=1e-4)
