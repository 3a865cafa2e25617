"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The test items are the stated query set. They are read in blocks of bounded size, and every block
meets all documents in plans of its own, whose matches are written: the driver and the executors
hold one block, however large the benchmark is.

* Every n-gram of an item is a seed, so each unedited stretch of ``n`` words holds one, whatever the
  edits beside it. How many documents hold each seed is counted over the whole table.
* An item is dropped for a text whose words, all taken together, cannot reach the threshold in any
  order. This ends most of the work that common n-grams would cause.
* The seeds left propose passages, on the diagonals on which the item would lie. The passage with
  the rarest seed comes first; passages whose words could not reach the threshold or the best score
  so far are left out, and equal passages are aligned once.
* A passage is aligned with the item, word by word (match 2, mismatch and gap -1). The score is
  the best local alignment divided by that of the item with itself.

Documents are not shuffled: one pass counts the seeds and finds the texts to align. A copy of half of an item scores 0.5.

Defined results: a null or empty text has no match, an item without words matches nothing. An item
of fewer than ``n`` words is its own seed, so that only whole copies are found. An item whose id is
null is searched like others and reported with a null id. A repeated item matches under each row, a
repeated document has its matches in each row; with equal scores the first passage counts; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import packed, table, unpacked, whole_text, written

N = 3
THRESHOLD = 0.5
#: Words of the items that meet the documents at once.
BLOCK_WORDS = 200_000
MATCHES = "array<struct<item_id: bigint, score: double, first_word: bigint, last_word: bigint>>"
_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def local_alignment(query: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score (match 2, mismatch and gap -1) and the passage word it ends at."""
    best, at = 0, -1
    row = np.zeros(len(passage) + 1, dtype=np.int32)
    ramp = np.arange(len(passage) + 1, dtype=np.int32)
    for word in query:
        own = np.zeros_like(row)
        own[1:] = row[:-1] + np.where(passage == word, 2, -1)
        np.maximum(own, row - 1, out=own)
        np.maximum(own, 0, out=own)
        # A gap in the query: each cell may continue one to its left.
        row = np.maximum.accumulate(own + ramp) - ramp
        end = int(row.argmax())
        if row[end] > best:
            best, at = int(row[end]), end - 1
    return best, at


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``first[k] .. first[k] + size[k] - 1`` of every k, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


class ItemBlock:
    """Some test items, the seeds by which texts are searched, and how frequent these are."""

    def __init__(self, items: list[tuple[int, str]], n: int, threshold: float):
        self.n, self.threshold = n, threshold
        split = [(i, words) for i, text in items if (words := words_of(text or ""))]
        self.vocabulary: dict[str, int] = {}
        for _, words in split:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        if (len(self.vocabulary) + 1) ** n >= 1 << 63:
            raise ValueError("too many different words in a block of test items")
        self.item_ids = [i for i, _ in split]
        self.items = [np.array([self.vocabulary[w] for w in words]) for _, words in split]
        self.lengths = np.array([len(words) for words in self.items], np.int64)
        self._index_words()
        # Seeds by their length: the numbers of one length's n-grams begin at ``base``.
        self.grams: dict[int, tuple[int, np.ndarray]] = {}
        self.seeds: list[np.ndarray] = [np.zeros(0, np.int64)] * len(self.items)
        self.n_seeds = 0
        for size in sorted({min(n, len(words)) for words in self.items}):
            own = [k for k, words in enumerate(self.items) if min(n, len(words)) == size]
            codes = [self._codes(self.items[k], size) for k in own]
            grams = np.unique(np.concatenate(codes))
            for k, c in zip(own, codes):
                self.seeds[k] = self.n_seeds + np.searchsorted(grams, c)
            self.grams[size] = self.n_seeds, grams
            self.n_seeds += len(grams)
        order = np.argsort(np.concatenate([np.zeros(0, np.int64), *self.seeds]), kind="stable")
        #: The items that hold each seed, from ``seeded_from`` on.
        self.seeded = np.repeat(np.arange(len(self.items)), [len(s) for s in self.seeds])[order]
        seeds = np.concatenate([np.zeros(0, np.int64), *self.seeds])[order]
        self.seeded_from = np.searchsorted(seeds, np.arange(self.n_seeds + 1))
        #: Documents that hold each seed; equally rare as long as they are not counted.
        self.frequency = np.zeros(self.n_seeds, np.int64)

    def _index_words(self) -> None:
        """By word: the items that hold it and how often."""
        held = [np.unique(words, return_counts=True) for words in self.items]
        words = np.concatenate([np.zeros(0, np.int64), *(w for w, _ in held)])
        order = np.argsort(words, kind="stable")
        sizes = [len(w) for w, _ in held]
        self.holder = np.repeat(np.arange(len(held)), sizes)[order]
        self.times = np.concatenate([np.zeros(0, np.int64), *(c for _, c in held)])[order]
        self.held_from = np.searchsorted(words[order], np.arange(len(self.vocabulary) + 2))

    def _codes(self, ids: np.ndarray, size: int) -> np.ndarray:
        """One number per n-gram; -1 where a word is in no item."""
        count = max(0, len(ids) - size + 1)
        codes, known = np.zeros(count, np.int64), np.ones(count, bool)
        for k in range(size):
            part = ids[k : k + count]
            codes = codes * (len(self.vocabulary) + 1) + part
            known &= part > 0
        return np.where(known, codes, -1)

    def ids(self, text: str) -> np.ndarray:
        words = words_of(text)
        found = map(self.vocabulary.get, words, repeat(0))
        return np.fromiter(found, dtype=np.int64, count=len(words))

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and numbers of the seeds in a text."""
        places, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size, (base, grams) in self.grams.items():
            codes = self._codes(ids, size)
            at = np.flatnonzero(codes >= 0)
            gram = np.minimum(np.searchsorted(grams, codes[at]), len(grams) - 1)
            same = grams[gram] == codes[at]
            places.append(at[same])
            numbers.append(base + gram[same])
        return np.concatenate(places), np.concatenate(numbers)

    def reachable(self, ids: np.ndarray, seed: np.ndarray) -> np.ndarray:
        """Items with a seed that a text's words could score the threshold with, in any order."""
        held = np.unique(seed)
        sizes = self.seeded_from[held + 1] - self.seeded_from[held]
        hit = np.unique(self.seeded[_ranges(self.seeded_from[held], sizes)])
        words, counts = np.unique(ids[ids > 0], return_counts=True)
        sizes = self.held_from[words + 1] - self.held_from[words]
        at = _ranges(self.held_from[words], sizes)
        common = np.minimum(self.times[at], np.repeat(counts, sizes))
        matched = np.bincount(self.holder[at], common, minlength=len(self.items))
        return hit[matched[hit] / self.lengths[hit] >= self.threshold]

    def proposals(
        self, item: int, ids: np.ndarray, at: np.ndarray, seed: np.ndarray
    ) -> list[tuple[int, float]]:
        """(diagonal, bound on its score) of an item's passages, that of the rarest seed first.

        Passages with equally rare seeds follow by the number of their seeds, then by place.
        """
        query, own = self.items[item], self.seeds[item]
        step = max(1, len(query) // 2)
        by_seed = np.argsort(own, kind="stable")
        first = np.searchsorted(own[by_seed], seed, "left")
        sizes = np.searchsorted(own[by_seed], seed, "right") - first
        lag = (np.repeat(at, sizes) - by_seed[_ranges(first, sizes)]) // step
        diagonal, which, n_seeds = np.unique(lag, return_inverse=True, return_counts=True)
        rarest = np.full(len(diagonal), np.iinfo(np.int64).max)
        np.minimum.at(rarest, which, np.repeat(self.frequency[seed], sizes))
        begin = np.maximum(0, (diagonal - 1) * step)
        end = np.maximum(begin, np.minimum((diagonal + 2) * step + len(query), len(ids)))
        member = np.zeros(len(self.vocabulary) + 1, bool)
        member[query] = True
        shared = np.cumsum(member[ids[_ranges(begin, end - begin)]])
        until = np.cumsum(end - begin)
        shared = np.concatenate([[0], shared])[np.concatenate([[0], until])]
        most = np.minimum(1.0, np.diff(shared) / len(query))
        order = np.lexsort((diagonal, -n_seeds, rarest))
        order = order[most[order] >= self.threshold]
        return list(zip(diagonal[order].tolist(), most[order].tolist()))

    def best_passage(self, item: int, ids: np.ndarray, proposed) -> tuple | None:
        """(score, first word, last word) of the best passage, the first of equals."""
        query = self.items[item]
        step = max(1, len(query) // 2)
        best, share, before = None, 0.0, 0
        aligned: dict[bytes, tuple[int, int]] = {}
        for diagonal, most in proposed:
            if (most, -diagonal) <= (share, -before):
                continue
            begin = max(0, (diagonal - 1) * step)
            passage = ids[begin : max(0, (diagonal + 2) * step + len(query))]
            key = passage.tobytes()
            if key not in aligned:
                aligned[key] = local_alignment(query, passage)
            score, last = aligned[key]
            reached = score / (2 * len(query))
            if reached >= self.threshold and (reached, -diagonal) > (share, -before):
                share, before, best = reached, diagonal, (begin, last, passage)
        if best is None:
            return None
        begin, last, passage = best
        _, back = local_alignment(query[::-1], passage[: last + 1][::-1])
        return share, begin + last - back, begin + last

    def matches(self, ids: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item_id, score, first word, last word) of each item found, by its place in the block."""
        at, seed = self.hits(ids)
        found = []
        for item in self.reachable(ids, seed).tolist():
            proposed = self.proposals(item, ids, at, seed)
            best = self.best_passage(item, ids, proposed)
            if best:
                found.append((self.item_ids[item], *best))
        return found


def item_blocks(
    benchmark: DataFrame, n: int, threshold: float, block_words: int
) -> Iterator[ItemBlock]:
    """The test items in blocks; the driver holds one block at a time."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(words_of(row["text"] or ""))
        if size >= block_words:
            yield ItemBlock(block, n, threshold)
            block, size = [], 0
    if block:
        yield ItemBlock(block, n, threshold)


def candidates(docs: DataFrame, block: ItemBlock) -> DataFrame:
    """(doc_id, ids) of the documents that may hold an item, and (seed, n) of all documents.

    Both come from one pass over the texts; each task gives its counts of a seed in one row.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(block.n_seeds, np.int64), pa.null()
        for batch in batches:
            kind = batch["doc_id"].type
            rows, held = [], []
            for row, text in enumerate(batch["text"].to_pylist()):
                ids = block.ids(text)
                seed = block.hits(ids)[1]
                counts[np.unique(seed)] += 1
                if len(block.reachable(ids, seed)):
                    rows.append(row)
                    held.append(ids.astype("<i4").tobytes())
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(rows, pa.int64())), pa.array(held, pa.binary()),
                 none, none],
                names,
            )
        seen = np.flatnonzero(counts)
        for first in range(0, len(seen), 8192):
            seeds = seen[first : first + 8192]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(seeds), kind), pa.nulls(len(seeds), pa.binary()),
                 pa.array(seeds), pa.array(counts[seeds])],
                names,
            )

    names = ["doc_id", "ids", "seed", "n"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", whole_text().alias("text"))
    return texts.mapInArrow(find, f"doc_id {id_type}, ids binary, seed long, n long")


def seed_frequency(found: DataFrame, block: ItemBlock) -> np.ndarray:
    """How many of all documents hold each seed of a block, from its ``candidates``."""
    total = np.zeros(block.n_seeds, np.int64)
    counted = found.where("seed is not null").groupBy("seed").agg(F.sum("n").alias("n"))
    # At most one row per seed of the block.
    for row in counted.collect():
        total[row["seed"]] = row["n"]
    return total


def _listed(block: ItemBlock, ids_of: Callable) -> Callable[[Column], Column]:
    names = ("item_id", "score", "first_word", "last_word")

    @F.pandas_udf(MATCHES)
    def search(held: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(names, m)) for m in block.matches(ids_of(h))] for h in held])

    return search


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = N,
    threshold: float = THRESHOLD,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document and test item found in it; the matches of each block are a table."""
    tables = []
    for block in item_blocks(benchmark, n, threshold, block_words):
        possible = written(candidates(docs, block), "seeded")
        block.frequency = seed_frequency(possible, block)
        search = _listed(block, lambda ids: np.frombuffer(ids, "<i4").astype(np.int64))
        found = possible.where("ids is not null").select("doc_id", search("ids").alias("found"))
        tables.append(written(found.select("doc_id", F.inline("found")), "contamination"))
    if not tables:
        nothing = F.array().cast(MATCHES)
        return docs.select("doc_id", nothing.alias("found")).select("doc_id", F.inline("found"))
    return reduce(DataFrame.unionByName, tables)


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = N,
    threshold: float = THRESHOLD,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without the documents in which a test item was found.

    With several blocks, what each of them leaves is a table that the next one searches.
    """
    kept = None
    for block in item_blocks(benchmark, n, threshold, block_words):
        left = packed(docs) if kept is None else written(kept, "decontaminated")
        text = F.coalesce(F.col("row.text"), F.lit(""))
        texts = left.select(F.col("row.doc_id").alias("doc_id"), text.alias("text"))
        block.frequency = seed_frequency(candidates(texts, block), block)
        found = _listed(block, block.ids)(text)
        kept = left.withColumn("found", found).where(F.size("found") == 0).select("row")
    return docs if kept is None else unpacked(kept, docs.columns)


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document that holds a test item or an edited copy of at least half of one."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(documents, table(spark, sf_dir, "benchmark"))
