import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from hearthline.llm import periodic_runs as pr

from .conftest import pairs


def brute_runs(words, min_length=6, min_repeats=4):
    """Every maximal stretch of each period, kept where no smaller period fits it."""
    n, found = len(words), []
    for q in range(1, n // min_repeats + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            block = words[at : at + length]
            smaller = any(block[:-p] == block[p:] for p in range(1, q))
            if length >= max(min_length, min_repeats * q) and not smaller:
                found.append((at, length, q))
            at = end
    return sorted(found, key=lambda r: (r[0], r[2]))


def numbers(words):
    known = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def planted(draw, n, alphabet):
    words = [draw.choice(alphabet) for _ in range(n)]
    for _ in range(draw.randint(0, 4)):
        block = [draw.choice(alphabet) for _ in range(draw.randint(1, 30))]
        if draw.random() < 0.4:  # a block that holds runs itself
            block = block[:2] * draw.randint(2, 6) + block[:1]
        at = draw.randint(0, len(words))
        repeats = draw.randint(2, 7)
        words[at:at] = (block * repeats)[: len(block) * repeats - draw.randint(0, len(block))]
    return words


@pytest.mark.parametrize("min_length, min_repeats", [(6, 4), (1, 4), (6, 3), (20, 5), (9, 3)])
def test_runs_against_every_period(min_length, min_repeats):
    draw = random.Random(min_length * 10 + min_repeats)
    for case in range(150):
        words = planted(draw, draw.randint(0, 120), "ab" if case % 3 else "abcdefghij")
        got = pr.runs_of(numbers(words), min_length, min_repeats)
        assert got == brute_runs(words, min_length, min_repeats), words


def test_long_texts_take_little_time():
    for words in (["ha"] * 200_000, ["a", "b"] * 100_000, [*"aaab"] * 40_000 + [*"aab"] * 40_000):
        began = time.process_time()
        assert pr.runs_of(numbers(words))
        assert time.process_time() - began < 5


def wanted(doc_id, text):
    words = (text or "").encode().split()
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (
        doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def query(monkeypatch, spark, frame):
    monkeypatch.setattr(pr, "table", lambda *_: frame)
    return pr.op13_periodic_runs(spark, "")


def test_query_against_brute_force(spark, monkeypatch, docs, small):
    many = spark.createDataFrame(
        [(i, "x " + f"word{i % 3} and " * (i % 23)) for i in range(300)], "doc_id long, text string"
    )
    short = small.where("n_chars < 6000")
    assert short.count() > 150
    for frame in (docs.where("doc_id <> 10 or doc_id is null"), many, short):
        got = [tuple(r) for r in query(monkeypatch, spark, frame).collect()]
        assert sorted(got, key=str) == sorted((wanted(*p) for p in pairs(frame)), key=str)


def test_awkward_rows_and_empty_tables(spark, docs, no_docs):
    found = {r["doc_id"]: r for r in pr.periodic_runs(docs).collect()}
    assert [tuple(r) for r in found[10]["runs"]] == [(0, 30_000, 1)]
    assert found[10]["collapsed"] == "ha" and found[1]["runs"] == [] and found[9]["n_words"] == 0
    assert pr.periodic_runs(no_docs).count() == 0
