import random
import re
import time

import numpy as np

from hearthline.llm import decontamination as dec

from conftest import plan_of
from .conftest import pairs


def brute_score(query, passage):
    """Smith-Waterman by its definition."""
    best, above = 0, [0] * (len(passage) + 1)
    for q in query:
        row = [0]
        for j, p in enumerate(passage, 1):
            row.append(max(0, above[j - 1] + (2 if q == p else -1), above[j] - 1, row[-1] - 1))
        best, above = max(best, max(row)), row
    return best


def test_alignment_against_its_definition():
    draw = random.Random(4)
    for _ in range(300):
        query = [draw.randint(1, 5) for _ in range(draw.randint(1, 12))]
        passage = [draw.randint(1, 5) for _ in range(draw.randint(0, 15))]
        score, end = dec.local_alignment(np.array(query), np.array(passage, dtype=int))
        assert score == brute_score(query, passage)
        if score:
            assert brute_score(query, passage[: end + 1]) == score


def found_in(frame, items, **options):
    return {
        (r["doc_id"], r["item_id"]): r["score"]
        for r in dec.contamination(frame, items, **options).collect()
    }


def test_small_documents_against_brute_force(small, benchmark):
    got = found_in(small, benchmark)
    want = {}
    texts = [(i, dec.words_of(t)) for i, t in pairs(small)]
    for item in benchmark.collect():
        query = dec.words_of(item["text"])
        known = set(query)
        for i, words in texts:
            if len(known & set(words)) * 2 < len(known):
                continue
            score = brute_score(query, words) / (2 * len(query))
            if score >= dec.THRESHOLD:
                want[i, item["item_id"]] = score
    assert got == want and got


def test_edited_copies_blocks_and_hot_items(spark, benchmark):
    draw = random.Random(6)
    items = benchmark.limit(12).collect()
    rows = []
    for n, item in enumerate(items):
        words = item["text"].split()
        edited = [w if draw.random() > 0.12 else "changed" for w in words]
        rows.append((n, "before it " * 30 + " ".join(edited) + " after it" * 30))
    rows += [(1000 + n, rows[0][1]) for n in range(60)]
    rows += [(2000 + n, f"clean text number {n} says nothing of it") for n in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    whole = found_in(frame, benchmark)
    assert {i for i, _ in whole} == {i for i, _ in rows if i < 2000}
    assert found_in(frame, benchmark, block_words=50) == whole
    kept = dec.decontaminated(frame, benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows if i >= 2000}


def test_awkward_rows_and_empty_tables(spark, docs, no_docs, benchmark):
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (3, "a b"), (4, "quick brown fox jumps over the lazy dog"),
         (4, "quick brown fox jumps over the lazy dog"), (None, "the same id text another with")],
        "item_id long, text string",
    )
    found = dec.contamination(docs, odd).collect()
    # Half of the item without an id stands in "Another text with the same id".
    want = []
    for doc_id, text in pairs(docs):
        for item in odd.collect():
            query = dec.words_of(item["text"] or "")
            score = brute_score(query, dec.words_of(text)) / max(1, 2 * len(query))
            if len(query) >= 3 and score >= dec.THRESHOLD:
                want.append((doc_id, item["item_id"], score))
    assert sorted(want, key=str) == sorted(
        [(5, 4, 1.0)] * 4 + [(5, None, 0.5)], key=str
    )
    assert sorted(((r[0], r[1], r[2]) for r in found), key=str) == sorted(want, key=str)
    kept = dec.decontaminated(docs, odd)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert dec.contamination(no_docs, benchmark).count() == 0
    assert dec.decontaminated(docs, benchmark.limit(0)).count() == docs.count()


def test_evenly_spaced_edits_against_brute_force(spark):
    draw = random.Random(8)
    items, rows, want = [], [], {}
    # Every item has one copy, so that no document holds the trigrams across its edits.
    for size in (15, 16, 19, 23, 30, 41):
        for shift in range(4):
            item = 100 * size + shift
            words = [f"w{draw.randint(1, 10_000)}" for _ in range(size)]
            items.append((item, " ".join(words)))
            edited = [f"x{k}" if k % 4 == shift else w for k, w in enumerate(words)]
            before = [f"y{k}" for k in range(draw.randint(0, 50))]
            text = before + edited + ["after", "it"]
            rows.append((item, " ".join(text)))
            score = brute_score(words, text) / (2 * size)
            if score >= dec.THRESHOLD:
                want[item, item] = score
    assert len(want) == len(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_in(frame, spark.createDataFrame(items, "item_id long, text string")) == want


def test_short_items_are_their_own_seed(spark):
    rows = [(1, "say yes or no"), (2, "say or yes"), (3, "yes"), (4, "nothing of it"), (5, "or no")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, "Yes!"), (8, "yes, or"), (9, "- ?")], "item_id long, text string")
    assert found_in(frame, items) == {(1, 7): 1.0, (2, 7): 1.0, (3, 7): 1.0, (1, 8): 1.0}


def test_common_openings_cost_little():
    opening = "which of the following words"
    items = [(k, f"{opening} " + " ".join(f"w{k}x{j}" for j in range(15))) for k in range(200)]
    block = dec.ItemBlock(items, dec.N, dec.THRESHOLD)
    text = " ".join([opening] * 2000)
    began = time.process_time()
    assert block.matches(block.ids(text)) == []
    assert time.process_time() - began < 1
    # The same with one true copy at the end, and with the whole item over and over.
    began = time.process_time()
    at = 5 * 2000
    assert block.matches(block.ids(f"{text} {items[3][1]}")) == [(3, 1.0, at, at + 19)]
    assert block.matches(block.ids(" ".join([items[3][1]] * 2000))) == [(3, 1.0, 0, 19)]
    assert time.process_time() - began < 2


def test_seeds_are_counted_and_the_rarest_visited_first(spark):
    items = [(1, "a b c d e f"), (2, "x y z u v w")]
    rows = [(k, "a b c and more") for k in range(5)] + [(9, "d e f"), (9, "a b c a b c"), (10, None)]
    block = dec.ItemBlock(items, 3, 0.5)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    block.frequency = dec.seed_frequency(dec.candidates(frame, block), block)
    counted = dict(zip(block.seeds[0].tolist(), block.frequency[block.seeds[0]].tolist()))
    assert [counted[g] for g in block.seeds[0].tolist()] == [6, 0, 0, 1]
    assert block.frequency[block.seeds[1]].sum() == 0
    ids = block.ids("a b c q q q " * 3 + "d e f")
    proposed = block.proposals(0, ids, *block.hits(ids))
    # The passage of the rare "d e f" first, though it stands last.
    assert [d for d, _ in proposed] == [5, 0, 2, 4]


def test_a_plan_holds_one_block(spark, benchmark):
    """Whatever the number of blocks, no plan has more than one search."""
    frame = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    for words in (50, 10**6):
        plan = plan_of(dec.contamination(frame, benchmark, block_words=words))
        assert "ArrowEvalPython" not in plan and "MapInArrow" not in plan
    for words in (50, 10**6):
        plan = plan_of(dec.decontaminated(frame, benchmark, block_words=words))
        assert len(set(re.findall(r"\(\d+\) ArrowEvalPython", plan))) == 1
