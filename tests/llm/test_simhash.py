import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from hearthline.llm import simhash

from .conftest import pairs


def brute_print(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [words[i : i + size] for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, distance=3):
    """The first position of each fingerprint's class."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (int(a) ^ int(prints[j])).bit_count() <= distance:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def test_fingerprints():
    for text in ("", " \n", "One", "a B", "a b c", "a b c a b c", "É\x85x y z Ö", "x " * 70_000):
        assert simhash.fingerprint(text) == brute_print(text[:3000] if len(text) > 9000 else text)


def near_words(draw, count, bases, flips, width):
    words = draw.integers(0, 1 << 63, size=bases, dtype=np.uint64)[draw.integers(0, bases, count)]
    for _ in range(flips):
        words = words ^ (np.uint64(1) << draw.integers(0, width, count).astype(np.uint64))
    return np.unique(words)


def test_index_against_all_pairs(monkeypatch):
    draw = np.random.default_rng(1)
    for trial in range(60):
        words = near_words(draw, 300, 1 + trial % 9, trial % 6, [8, 20, 64][trial % 3])
        groups = draw.integers(0, 3, len(words))
        rank = words.copy()
        for shift in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(shift)
        order = np.lexsort((rank, groups))
        words, groups = words[order], groups[order]
        monkeypatch.setattr(simhash, "PORTION", [50, 1000, 1 << 20][trial % 3])
        found = simhash.local_links(groups, groups * 0, words, 3)
        want = set()
        for g in range(3):
            inside = words[groups == g]
            signed = inside.view(np.int64)
            first = brute_classes(inside)
            want |= {(int(signed[i]), int(signed[f])) for i, f in enumerate(first) if i != f}
        assert set(zip(found["a"], found["b"])) == want


def test_every_cut_of_the_bits_finds_the_same_classes(spark):
    draw = np.random.default_rng(2)
    words = near_words(draw, 400, 40, 3, 64)
    frame = spark.createDataFrame(
        [(int(i), int(w)) for i, w in enumerate(words.view(np.int64))], "doc_id long, fp long"
    )
    want = dict(zip(words.view(np.int64).tolist(), brute_classes(words)))
    for count in (len(words), 1 << 24, 1 << 34):
        stars = simhash.stars(simhash.links(frame.select("fp"), 3, count)).collect()
        root = {int(w): int(w) for w in words.view(np.int64)} | {r["a"]: r["b"] for r in stars}
        classes = {}
        for w, r in root.items():
            classes.setdefault(r, set()).add(w)
        expected = {}
        for w, r in want.items():
            expected.setdefault(r, set()).add(w)
        assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expected.values()))


def classes_of(words, stars):
    root = {int(w): int(w) for w in words.view(np.int64)} | {r["a"]: r["b"] for r in stars}
    classes = {}
    for w, r in root.items():
        classes.setdefault(r, set()).add(w)
    return sorted(map(sorted, classes.values()))


def test_a_split_front_gives_the_same_classes(spark):
    draw = np.random.default_rng(7)
    # Half of the fingerprints agree on their upper bits, so they meet in one front.
    crowded = near_words(draw, 500, 60, 3, 40) & np.uint64((1 << 40) - 1)
    words = np.unique(np.r_[crowded, near_words(draw, 200, 30, 3, 64)])
    frame = spark.createDataFrame([(int(w),) for w in words.view(np.int64)], "fp long")
    whole = simhash.stars(simhash.links(frame, 3, len(words))).collect()
    ordered = simhash.gray_orders(frame, 3, simhash.bit_blocks(len(words), 3))
    for limit, least in ((150, 3), (20, 10)):
        split = simhash.split_fronts(ordered, 3, limit).where("part > 0")
        parts = split.groupBy("turn", "front").agg(F.count_distinct("part").alias("n"))
        assert parts.agg(F.max("n")).first()[0] >= least
        assert split.groupBy("turn", "front").count().where(f"count <= {limit}").count() == 0
        found = simhash.stars(simhash.links(frame, 3, len(words), limit)).collect()
        assert classes_of(words, found) == classes_of(words, whole)
    first = brute_classes(words)
    want = {}
    for i, f in enumerate(first):
        want.setdefault(f, set()).add(int(words.view(np.int64)[i]))
    assert classes_of(words, whole) == sorted(map(sorted, want.values()))


def test_stars_of_long_chains(spark):
    edges = spark.range(200).select(
        (F.col("id") * 7 % 200).alias("a"), ((F.col("id") + 1) * 7 % 200).alias("b")
    ).where("a <> 0")
    found = simhash.stars(edges).collect()
    assert {r["b"] for r in found} == {0} and {r["a"] for r in found} == set(range(1, 200))


def test_documents_against_brute_force(docs, small):
    for frame in (docs, small):
        rows = [(i, t[:6000]) for i, t in pairs(frame)]
        prints = [brute_print(t) for _, t in rows]
        first = brute_classes(prints)
        ids = {}
        for (i, _), c in zip(rows, first):
            ids.setdefault(c, []).append(i)
        least = {c: min((i for i in v if i is not None), default=None) for c, v in ids.items()}
        cut = frame.withColumn("text", F.substring("text", 1, 6000))
        got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(cut).collect()]
        want = [(i, p, least[c]) for (i, _), p, c in zip(rows, prints, first)]
        assert sorted(got, key=str) == sorted(want, key=str)
        kept = simhash.deduplicated(cut)
        assert kept.columns == frame.columns
        assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(least.values(), key=str)


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.deduplicated(no_docs).count() == 0
