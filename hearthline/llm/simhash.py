"""SimHash near-duplicates by a Gray-ordered hierarchical index.

A fingerprint has a bit set where more than half of the shingles' XXH64 hashes have it set.
Fingerprints that differ in at most ``distance`` bits are linked; a class is what links reach.

* Equal fingerprints are one node from the start, so copies cost nothing further on.
* The 64 bits are cut into blocks, more than ``distance`` of them. Two linked fingerprints agree
  in all but ``distance`` blocks, so each fingerprint is laid into one order per choice of the
  agreeing blocks, with these bits in front. In such an order the fingerprints are sorted by Gray
  rank; the front bits are the topmost nodes of the index, of which a query needs its own only.
  With more fingerprints the blocks are cut finer, which keeps the topmost nodes small; the links
  found are the same.
* Below a topmost node, runs of ``FANOUT`` neighbours in Gray order form a node, and runs of
  those the next level. A node holds the bits all its fingerprints share, as mask and pattern. A
  query goes down from the top; a node whose shared bits already differ in more than
  ``distance`` places is left out with everything below it. Nodes that can only hold partners, or
  only what is linked to the query already, are not opened either.
* Only links to the smallest member of a local class are passed on, a number linear in the
  fingerprints. Classes are then joined by large-star and small-star rounds over written tables.

Nothing is gathered on the driver. A task holds the fingerprints of one topmost node, 8 bytes
each, and compares them in bounded portions.

Defined results: a null text is empty; texts without words have fingerprint zero and are linked
like any other; repeated rows are nodes of one class; a row with a null ``doc_id`` takes part,
but null is not the smallest id unless it is the only one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import in_portions, packed, table, unpacked, whole_text, written

SHINGLE = 3
DISTANCE = 3
SEED = 42
FANOUT = 8
#: Fingerprints that may share a topmost node on average before blocks are cut finer.
TOP_NODE = 64
#: Fingerprints of one front from which it is split by further bits.
LARGE_FRONT = 20_000
#: Pairs of query and node that a task compares at once.
PORTION = 1 << 20
_HASHES = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats included."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(shingle)))))
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for first in range(0, len(shingles), _HASHES):
        part = shingles[first : first + _HASHES]
        hashes = np.fromiter((digest(s, SEED) for s in part), dtype="<u8", count=len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    majority = np.packbits(2 * counts > len(shingles), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a long of the same 64 bits."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(found.view(np.int64))

    return run(text)


def bit_blocks(fingerprints: int, distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each block, cut so that topmost nodes stay small on average."""
    for blocks in range(distance + 1, 2 * distance + 2):
        front = 64 * (blocks - distance) // blocks
        if fingerprints >> front <= TOP_NODE:
            break
    edges = [64 * k // blocks for k in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def with_gray_rank(df: DataFrame, word: str) -> DataFrame:
    """``word`` replaced by its place in Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        df = df.withColumn(word, F.col(word).bitwiseXOR(F.shiftrightunsigned(word, shift)))
    return df


def gray_orders(nodes: DataFrame, distance: int, blocks: list[tuple[int, int]]) -> DataFrame:
    """(turn, front, below, laid, rank, fp): each fingerprint once per choice of agreeing blocks.

    ``laid`` has the agreeing blocks first and ``below`` other bits behind them.
    """
    orders = []
    for turn, chosen in enumerate(combinations(range(len(blocks)), len(blocks) - distance)):
        rest = [b for b in range(len(blocks)) if b not in chosen]
        word, top, front = F.lit(0).cast("long"), 64, 0
        for b in (*chosen, *rest):
            low, width = blocks[b]
            top -= width
            part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
            word = word.bitwiseOR(F.shiftleft(part, top))
            front += width if b in chosen else 0
        orders.append(F.struct(
            F.lit(turn).alias("turn"), F.lit(64 - front).alias("below"), word.alias("rank")
        ))
    laid = nodes.select("fp", F.explode(F.array(*orders)).alias("order")).select(
        "order.turn", F.expr("shiftrightunsigned(order.rank, order.below)").alias("front"),
        "order.below", F.col("order.rank").alias("laid"), "order.rank", "fp",
    )
    return with_gray_rank(laid, "rank")


class GrayIndex:
    """Hierarchical index over groups of fingerprints, each group in Gray order."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, distance: int):
        self.words, self.distance = words, distance
        self.root = np.arange(len(words))
        #: Levels from the leaves up: lowest leaf, behind the last, shared mask, pattern, children.
        low, group = np.arange(len(words)), np.zeros(len(words), np.int64)
        group[starts] = 1
        group = np.cumsum(group) - 1
        held, any_of = words, words
        self.levels = [(low, low + 1, np.full(len(words), ~np.uint64(0)), words, None)]
        while np.any(group[1:] == group[:-1]):
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            place = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
            cut = np.flatnonzero(place % FANOUT == 0)
            ends = np.r_[cut[1:], len(group)]
            held, any_of = np.bitwise_and.reduceat(held, cut), np.bitwise_or.reduceat(any_of, cut)
            below = self.levels[-1]
            mask = ~(held ^ any_of)
            self.levels.append((below[0][cut], below[1][ends - 1], mask, held & mask, (cut, ends)))
            group = group[cut]
        self.top_of = np.searchsorted(self.levels[-1][0], np.arange(len(words)), "right") - 1

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        """Puts the two ends of each link into one local class."""
        while len(left):
            a, b = self.root[left], self.root[right]
            open_ = a != b
            left, right, a, b = left[open_], right[open_], a[open_], b[open_]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                shorter = self.root[self.root]
                if np.array_equal(shorter, self.root):
                    break
                self.root = shorter

    def link_all(self) -> np.ndarray:
        """The smallest position of each fingerprint's class by links within the groups."""
        top = self.levels[-1]
        near = np.flatnonzero(self.top_of[1:] == self.top_of[:-1])
        close = np.bitwise_count(self.words[near] ^ self.words[near + 1]) <= self.distance
        self.join(near[close], near[close] + 1)
        for low, high, mask, _, _ in self.levels[1:]:
            self._tight(low, high, mask)
        cost = np.cumsum((top[1] - top[0])[self.top_of])
        first = 0
        while first < len(self.words):
            before = cost[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(cost, before + PORTION, "right")))
            self._search(np.arange(first, last))
            first = last
        return self.root

    def _tight(self, low: np.ndarray, high: np.ndarray, mask: np.ndarray) -> None:
        """Fingerprints below a node with few open bits are all linked."""
        tight = 64 - np.bitwise_count(mask).astype(int) <= self.distance
        low, count = low[tight], (high - low)[tight] - 1
        before = np.cumsum(count) - count
        left = np.repeat(low - before, count) + np.arange(count.sum())
        self.join(left, left + 1)

    def _search(self, queries: np.ndarray) -> None:
        """Links the queries with every later fingerprint within the distance."""
        nodes = self.top_of[queries]
        for depth in range(len(self.levels) - 1, -1, -1):
            low, high, mask, pattern, children = self.levels[depth]
            differ = np.bitwise_count((self.words[queries] ^ pattern[nodes]) & mask[nodes]).astype(int)
            # What is behind the query only, and not in the query's class as a whole already.
            keep = (differ <= self.distance) & (high[nodes] > queries + 1)
            if depth:
                least = np.minimum.reduceat(self.root, low)
                most = np.maximum.reduceat(self.root, low)
                keep &= (least[nodes] != self.root[queries]) | (most[nodes] != self.root[queries])
                sure = keep & (differ + 64 - np.bitwise_count(mask[nodes]) <= self.distance)
                self.join(queries[sure], low[nodes[sure]])
                keep &= ~sure
            queries, nodes = queries[keep], nodes[keep]
            if not depth:
                self.join(queries, nodes)
                return
            first, ends = children
            count = (ends - first)[nodes]
            before = np.cumsum(count) - count
            queries = np.repeat(queries, count)
            nodes = np.repeat(first[nodes] - before, count) + np.arange(count.sum())


def local_links(
    turns: np.ndarray, fronts: np.ndarray, words: np.ndarray, distance: int,
    parts: np.ndarray | None = None,
) -> pd.DataFrame:
    """Links (a, b) of each fingerprint to the first one of its class, of whole groups only."""
    new = np.r_[True, (turns[1:] != turns[:-1]) | (fronts[1:] != fronts[:-1])]
    if parts is not None:
        new[1:] |= parts[1:] != parts[:-1]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, len(words)])
    inside = np.repeat(sizes > 1, sizes)
    words, new = words[inside], new[inside]
    if not len(words):
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    root = GrayIndex(words, np.flatnonzero(new), distance).link_all()
    linked = np.flatnonzero(root != np.arange(len(words)))
    signed = words.view(np.int64)
    return pd.DataFrame({"a": signed[linked], "b": signed[root[linked]]})


_GROUP = ["turn", "front", "part"]


def split_fronts(ordered: DataFrame, distance: int, limit: int) -> DataFrame:
    """Appends ``part``: 0, or for fronts of more than ``limit`` fingerprints one of several.

    The bits below a front are cut into ``distance`` + 1 blocks. Two fingerprints of the front that
    are near agree on one of them, so each goes once to the part of every block's value, and no
    link is lost. Fronts that are larger still hold near copies of each other above all, which the
    index joins node by node.
    """
    large = ordered.groupBy("turn", "front").agg(
        F.count(F.lit(1)).alias("_n")
    ).where(F.col("_n") > limit).select("turn", "front", F.lit(True).alias("_large"))
    parts = []
    for k in range(distance + 1):
        low = F.floor(F.col("below") * k / (distance + 1)).cast("int")
        high = F.floor(F.col("below") * (k + 1) / (distance + 1)).cast("int")
        value = F.call_function("shiftrightunsigned", F.col("laid"), low)
        ones = F.call_function("shiftleft", F.lit(1).cast("long"), high - low) - 1
        parts.append(value.bitwiseAND(ones) * (distance + 1) + k + 1)
    marked = ordered.join(large, ["turn", "front"], "left")
    whole = F.array(F.lit(0).cast("long"))
    return marked.withColumn(
        "part", F.explode(F.when(F.col("_large"), F.array(*parts)).otherwise(whole))
    )


def links(
    nodes: DataFrame, distance: int, fingerprints: int, limit: int | None = None
) -> DataFrame:
    """Links between different fingerprints, enough to join every class."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []

        def linked(rows: np.ndarray) -> Iterator[pd.DataFrame]:
            turns, fronts, parts, words = rows.T.copy()
            found = local_links(turns, fronts, words.view(np.uint64), distance, parts)
            yield from in_portions(found)

        for batch in batches:
            rows = batch[[*_GROUP, "fp"]].to_numpy(np.int64)
            same = (rows[:, :3] == rows[-1, :3]).all(axis=1)
            whole = len(rows) - int(same.sum())
            # The last group may go on in the next batch; it is joined once, when it has ended.
            if whole or (held and (held[-1][-1, :3] != rows[0, :3]).any()):
                yield from linked(np.concatenate([*held, rows[:whole]]))
                held = []
            held.append(rows[whole:])
        if held:
            yield from linked(np.concatenate(held))

    ordered = gray_orders(nodes, distance, bit_blocks(fingerprints, distance))
    grouped = (
        split_fronts(ordered, distance, LARGE_FRONT if limit is None else limit)
        .repartition(*_GROUP)
        .sortWithinPartitions(*_GROUP, "rank")
        .select(*_GROUP, "fp")
    )
    return grouped.mapInPandas(run, "a long, b long")


def stars(found: DataFrame) -> DataFrame:
    """(a, b): every linked node ``a`` with the smallest node ``b`` of its class."""
    edges = written(
        found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct(), "links"
    )
    before = None
    while True:
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        if state == before or state["n"] == 0:
            return edges
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")
        )
        large = both.where("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        ).distinct()
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = written(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct(),
            "small-star",
        )


def components(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, root, component_id) for a written table of (doc_id, fp); ``root`` names the class."""
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    joined = stars(links(nodes.select("fp"), distance, nodes.count()))
    rooted = nodes.join(joined, nodes["fp"] == joined["a"], "left").select(
        "fp", "least", F.coalesce("b", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """(doc_id, fp, component_id) of every row; ``fp`` holds the 64 bits as a long."""
    prints = written(
        docs.select("doc_id", fingerprint_column(whole_text(), shingle).alias("fp")), "prints"
    )
    classes = components(prints, distance).select("fp", "component_id")
    return prints.join(classes, "fp")


def deduplicated(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One document of each class: the one with the smallest ``doc_id``.

    Of different texts with that id the one with the smallest hash stays, of equal rows one.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = packed(docs).select(
        "row", F.col("row.doc_id").alias("doc_id"), F.xxhash64(text).alias("text_hash")
    )
    prints = written(
        rows.select("doc_id", "text_hash", fingerprint_column(text, shingle).alias("fp")), "prints"
    )
    leaders = (
        prints.join(components(prints, distance), "fp")
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "component_id").agg(F.min("text_hash").alias("first_hash"))
    )
    # Joined and numbered on the same key: the texts are shuffled once.
    kept = rows.join(
        leaders,
        rows["doc_id"].eqNullSafe(leaders["component_id"])
        & (rows["text_hash"] == leaders["first_hash"]),
    )
    same = Window.partitionBy("doc_id", "text_hash").orderBy("row")
    kept = kept.withColumn("place", F.row_number().over(same)).where("place = 1")
    return unpacked(kept, docs.columns)


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and class of near-duplicates of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
