import hashlib
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from hearthline.llm import resampling as rs

from .conftest import pairs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(documents, target, shortest=1, longest=1, buckets=10_000, min_words=20, percent=10):
    """(doc_id, n_features, weight, score, rank) of every row by the definition."""

    def features(text):
        held = words(text)
        return [
            zlib.crc32(" ".join(held[i : i + n]).encode()) % buckets
            for n in range(shortest, longest + 1) for i in range(len(held) - n + 1)
        ]

    source = np.bincount([b for _, t in documents for b in features(t)], minlength=buckets)
    wanted = np.bincount([b for t in target for b in features(t)], minlength=buckets)
    total_s, total_t = float(source.sum()), float(wanted.sum())
    rows = []
    for doc_id, text in documents:
        held = features(text)
        gains = [
            math.floor(1000 * math.log(
                (float(wanted[b]) + 1) * (total_s + buckets)
                / ((float(source[b]) + 1) * (total_t + buckets))
            ))
            for b in held
        ]
        weight = math.floor(sum(gains) / len(gains)) if gains else 0
        key = f"2024:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(held), weight, weight + noise, len(words(text)) >= min_words))
    order = sorted(
        (r for r in rows if r[4]),
        key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]),
    )
    k = percent * len(order) // 100
    drawn = [(*r[:4], place + 1) for place, r in enumerate(order[:k])]
    return drawn + [(*r[:4], None) for r in order[k:]] + [(*r[:4], None) for r in rows if not r[4]]


def result(df):
    return sorted(
        map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str
    )


def test_documents_against_brute_force(docs, small, benchmark):
    target = [r["text"] for r in benchmark.collect()]
    for frame, options in (
        (small, {}),
        (docs, {"min_words": 1, "percent": 40}),
        (docs.unionAll(docs), {"min_words": 0, "percent": 50, "longest": 3, "buckets": 97}),
        (small, {"shortest": 2, "longest": 2, "percent": 100, "buckets": 500}),
    ):
        got = result(rs.importance_resample(frame, benchmark, **options))
        assert got == sorted(brute(pairs(frame), target, **options), key=str)


def test_many_ties_at_the_cutoff(spark):
    draw = random.Random(1)
    rows = [(draw.choice([None, *range(40)]), draw.randint(0, 2), draw.randint(0, 1))
            for _ in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, score long, n_words long").repartition(5)
    order = sorted(rows, key=lambda r: (-r[1], r[0] is not None, r[0] or 0, r[2]))
    for k in (1, 299, 300, 301, 899, 900):
        got = rs.draw(frame, F.lit(True), k, 900).orderBy("rank").where("rank is not null").collect()
        assert [r["rank"] for r in got] == [*range(1, k + 1)]
        assert [tuple(r)[:3] for r in got] == order[:k]


def test_bracket_widens_until_it_holds(spark, monkeypatch):
    values = spark.range(20_000).selectExpr("id * id % 1009 as v")
    order = sorted((r[0] for r in values.collect()), reverse=True)
    for margin, sketch in ((0.0, 8), (0.004, 2000), (2.0, 8)):
        monkeypatch.setattr(rs, "_MARGIN", margin or 1e-6)
        monkeypatch.setattr(rs, "_SKETCH", sketch)
        for k in (1, 1000, 19_999, 20_000):
            low, high, above = rs.bracket(values, "v", k, 20_000)
            assert low is None or low <= order[k - 1]
            assert high is None or order[k - 1] <= high
            assert above == (0 if high is None else sum(v > high for v in order))


def test_draw_prefers_the_target(spark):
    rows = [(i, ("wanted words here " if i % 4 == 0 else "other things there ") * 10) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("wanted words here " * 50,)], "text string")
    taken = rs.importance_resample(frame, target).where("rank is not null").collect()
    assert len(taken) == 40 and sum(r["doc_id"] % 4 == 0 for r in taken) > 36


def test_awkward_rows_and_empty_tables(docs, no_docs, benchmark):
    rows = rs.importance_resample(docs, benchmark.limit(0)).collect()
    assert len(rows) == docs.count()
    assert all(r["weight"] == 0 for r in rows if r["doc_id"] in (1, 3, 9))
    assert rs.importance_resample(no_docs, benchmark).count() == 0
    assert rs.importance_resample(no_docs, no_docs).count() == 0
