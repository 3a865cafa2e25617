import random
import struct
import time
import zlib

import pytest
from tokenizers import Tokenizer

from hearthline.llm import packing
from hearthline.llm.common import vocabulary_path

from .conftest import pairs


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))


def check_layout(rows, capacity):
    """Every sequence is gapless from 0 and within its capacity; returns their fills."""
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return [sum(n for _, n in parts) for parts in held.values()]


def test_ids_are_those_of_the_library(library):
    texts = [
        "", " ", "a\n\n  b\t", "<|endoftext|> x<|endoftext|><|endof", "don't I'LL 3½ ٣ ²", "ha " * 500,
        "".join(map(chr, range(1, 0x3000))), "😀👩‍👩‍👧  　x y ﻿ z", "x" * 3000,
    ]
    draw = random.Random(5)
    texts += ["".join(chr(draw.choice([32, 10, draw.randrange(33, 0xD800)])) for _ in range(200))
              for _ in range(50)]
    encoding = packing.tokenizer()
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert encoding.encode(text, allowed_special="all") == want


def test_query_against_the_library(spark, monkeypatch, library, docs, small):
    monkeypatch.setattr(packing, "GROUP", 50)
    for frame in (docs, small):
        monkeypatch.setattr(packing, "table", lambda *_, frame=frame: frame)
        rows = packing.op12_best_fit_packing(spark, "").collect()
        want = []
        for doc_id, text in pairs(frame):
            ids = [*library.encode(text, add_special_tokens=False).ids, 2]
            starts = packing.cuts(len(ids), 1024)
            for k, (at, to) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                crc = zlib.crc32(struct.pack(f"<{to - at}I", *ids[at:to]))
                want.append((doc_id, k, at, to - at, crc))
        got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
        assert sorted(got, key=str) == sorted(want, key=str)
        fills = check_layout(rows, 1024)
        assert len(fills) <= -(-sum(fills) // 1024) * 1.03 + 1


def test_cuts():
    assert packing.cuts(5, 4) == [0, 1] and packing.cuts(8, 4) == [0, 4]
    assert packing.cuts(3, 4) == [0] and packing.cuts(4, 4) == [0] and packing.cuts(11, 4) == [0, 3, 7]


def index_holds(found):
    """The index lists exactly the bins with space, under each of their lengths."""
    want = {}
    for b, held in enumerate(found.bins):
        assert found.fill[b] == sum(held) <= found.capacity
        if 0 < found.fill[b] < found.capacity:
            for n in set(held):
                want.setdefault(n, []).append((found.fill[b], b))
    assert {n: h for n, h in enumerate(found.holders) if h} == {n: sorted(h) for n, h in want.items()}
    assert found.lengths == sum(1 << n for n in want)


def helping(bins, capacity):
    """Every move, one-for-one and two-for-one exchange that increases the squared fills."""
    fills = [sum(b) for b in bins]
    for a, x in enumerate(bins):
        for b, y in enumerate(bins):
            if a == b or fills[a] in (0, capacity) or fills[b] in (0, capacity):
                continue
            ones = [0, *x]
            twos = [x[i] + x[j] for i in range(len(x)) for j in range(i)]
            for given in ones + twos:
                for taken in y:
                    fa, fb = fills[a] + taken - given, fills[b] + given - taken
                    if max(fa, fb) <= capacity and fa**2 + fb**2 > fills[a] ** 2 + fills[b] ** 2:
                        yield a, b, given, taken


def test_search_ends_where_no_exchange_helps():
    draw = random.Random(3)
    for case in range(120):
        capacity = draw.choice((7, 20, 64))
        top = capacity if case % 2 else capacity // 2
        lengths = [draw.randint(1, top) for _ in range(draw.randint(0, 40))]
        bins = [[n] for n in lengths] if case % 3 else packing.best_fit(lengths, capacity)
        before = sum(sum(b) ** 2 for b in bins)
        found = packing.OpenBins([list(b) for b in bins], capacity)
        index_holds(found)
        found.search()
        index_holds(found)
        assert sorted(n for b in found.bins for n in b) == sorted(lengths)
        assert sum(f * f for f in found.fill) >= before
        assert next(helping(found.bins, capacity), None) is None


def test_search_empties_bins():
    # Best fit alone leaves [6, 3] [6, 3] [2 ...]: exchanges fill bins and empty others.
    assert len(packing.best_fit([5, 5, 4, 4, 3, 3], 12)) == 3
    found = packing.OpenBins(packing.best_fit([5, 5, 4, 4, 3, 3], 12), 12)
    found.search()
    assert len([f for f in found.fill if f]) == 2


def test_many_pieces_take_little_time_and_space():
    draw = random.Random(8)
    for lengths in (
        [draw.randint(1, 1023) for _ in range(10_000)],
        [draw.randint(300, 340) for _ in range(10_000)],
        [600] * 10_000,
        [1] * 10_000,
        [draw.choice((340, 341, 342, 343, 512, 513, 170, 171)) for _ in range(10_000)],
    ):
        began = time.process_time()
        found = packing.OpenBins(packing.best_fit(lengths, 1024), 1024)
        found.search()
        assert time.process_time() - began < 30
    assert sorted(packing.best_fit([600] * 3, 1024)) == [[600]] * 3


def test_rounds_join_what_groups_leave(spark):
    draw = random.Random(4)
    rows = [(i, draw.randint(1, 900)) for i in range(3000)]
    pieces = spark.createDataFrame(rows, "k long, length long").withColumnRenamed("k", "_id")
    packed = packing.pack(pieces, 1024, group=100).collect()
    fills = check_layout(packed, 1024)
    assert sorted((r["_id"], r["length"]) for r in packed) == rows
    apart = sum(len(packing.best_fit([n for _, n in rows[k::30]], 1024)) for k in range(30))
    assert len(fills) <= 0.98 * apart and len(fills) <= sum(fills) / 1024 * 1.03
    crowded = packing.pack(spark.range(500).selectExpr("id", "600L as length"), 1024, group=50)
    assert len(check_layout(crowded.collect(), 1024)) == 500


def test_sequences_hold_the_ids(spark, docs, library):
    pieces = packing.pieces_of(docs, 64)
    packed = packing.pack(pieces, 64, group=500)
    joined = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    total = 0
    for r in packed.collect():
        ids = joined[r["sequence_id"]]["ids"]
        assert bytes(ids[4 * r["offset"] : 4 * (r["offset"] + r["length"])]) == bytes(r["ids"])
        total += r["length"]
    assert sum(r["n_tokens"] for r in joined.values()) == total
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in joined.values())


def test_awkward_rows_and_empty_tables(spark, docs, no_docs):
    pieces = packing.pieces_of(docs)
    found = {r["doc_id"]: r for r in pieces.where("piece = 0").collect()}
    assert found[1]["length"] == found[3]["length"] == 1 and None in found
    assert bytes(found[1]["ids"]) == struct.pack("<I", 2)
    assert packing.pack(packing.pieces_of(no_docs)).count() == 0
    with pytest.raises(Exception, match="exceeds"):
        packing.pack(pieces, 8).count()
