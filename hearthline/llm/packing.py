"""Best-fit packing of token sequences by a swap-based local search.

Documents become pieces of at most ``capacity`` tokens; pieces go into sequences (bins) of that
capacity. A group of pieces starts from best fit, the longest pieces first. Then bins that are not
full exchange pieces as long as that increases the sum of the squared fills: a piece moves, one
piece is exchanged for one, or two for one, in either direction. Space thus gathers in few bins,
until these are empty.

Groups are dealt at random and searched in tasks of their own. The bins that a round leaves with
space are dealt anew, into as many groups as they need, so that the space left over by thousands of
groups meets in later rounds; only whole bins are dealt, and full ones stay as they are. Rounds end
when one group held all open bins, or when neither the bins nor the groups become noticeably fewer.
Each round is a table in the shared folder; a group holds ``GROUP`` pieces on average, whatever the
input, and the driver sees counts alone.

Defined results: a null or empty text is a document of the closing id alone; repeated rows are
packed each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import table, vocabulary_path, whole_text, written

CAPACITY = 1024
END = 2
GROUP = 20_000
#: Share of the open bins that a round has to empty to be followed by one with as many groups.
_WORTHWHILE = 0.01
#: Rows of pieces that leave a Python worker at once.
_PORTION = 4_096


def tokenizer(ranks_path: str | None = None):
    """The byte-level vocabulary, from its rank file; special strings in a text become their id.

    The ids are those of the same vocabulary in the ``tokenizers`` library, which takes more than
    twice the time.
    """
    import public_tokenizers
    import tiktoken

    with open(ranks_path or vocabulary_path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
        special_tokens={"<|endoftext|>": len(ranks)},
    )


def cuts(length: int, capacity: int) -> list[int]:
    """Where the pieces of a document begin: all but the first are as long as a sequence."""
    first = length % capacity
    return [*([0] if first else []), *range(first, length, capacity)]


def pieces_of(
    docs: DataFrame, capacity: int = CAPACITY, end: int = END, ranks_path: str | None = None
) -> DataFrame:
    """doc_id, piece, start, length and ids (unsigned 32-bit, little-endian) of every piece."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding, rows = tokenizer(ranks_path), []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encoding.encode_to_numpy(text, allowed_special="all"), end)
                ids = ids.astype("<u4")
                starts = cuts(len(ids), capacity)
                for k, (at, to) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append((doc_id, k, at, to - at, ids[at:to].tobytes()))
                    if len(rows) >= _PORTION:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
        yield pd.DataFrame(rows, columns=names)

    names = ["doc_id", "piece", "start", "length", "ids"]
    # As text, since pandas has no whole numbers beside nulls.
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    found = texts.mapInPandas(encode, "doc_id string, piece int, start long, length long, ids binary")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


class OpenBins:
    """Bins of one group and the exchanges between those that have space left.

    ``holders[n]`` lists (fill, bin), sorted, of the bins with space that hold a piece of length
    ``n``; bit ``n`` of ``lengths`` is set if there is one.
    """

    def __init__(self, bins: list[list[int]], capacity: int):
        self.capacity, self.bins = capacity, bins
        self.fill = [sum(b) for b in bins]
        self.holders: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.lengths = 0
        for b in range(len(bins)):
            self._enter(b)

    def _open(self, b: int) -> bool:
        return 0 < self.fill[b] < self.capacity

    def _enter(self, b: int) -> None:
        if self._open(b):
            for n in set(self.bins[b]):
                insort(self.holders[n], (self.fill[b], b))
                self.lengths |= 1 << n

    def _leave(self, b: int) -> None:
        for n in set(self.bins[b]):
            held = self.holders[n]
            held.pop(bisect_left(held, (self.fill[b], b)))
            if not held:
                self.lengths &= ~(1 << n)

    def _exchange(self, a: int, gives: tuple[int, ...], b: int, takes: int) -> None:
        """``a`` gives pieces to ``b`` for one of length ``takes``."""
        self._leave(a)
        self._leave(b)
        for n in gives:
            self.bins[a].remove(n)
            self.bins[b].append(n)
        self.bins[b].remove(takes)
        self.bins[a].append(takes)
        gained = takes - sum(gives)
        self.fill[a] += gained
        self.fill[b] -= gained
        self._enter(a)
        self._enter(b)

    def _take(self, a: int, gives: tuple[int, ...]) -> bool:
        """Gives none, one or two pieces for a longer one that fills ``a`` as far as possible.

        The other bin is the emptiest that has such a piece.
        """
        given, room = sum(gives), self.capacity - self.fill[a]
        wanted = (self.lengths >> (given + 1)) & ((1 << room) - 1)
        while wanted:
            gained = wanted.bit_length()
            fill, b = next((e for e in self.holders[given + gained] if e[1] != a), (math.inf, a))
            if fill < self.fill[a] + gained:
                self._exchange(a, gives, b, given + gained)
                return True
            wanted ^= 1 << (gained - 1)
        return False

    def _hand_over(self, a: int, gives: tuple[int, int]) -> bool:
        """Gives two pieces for a shorter one to a bin that gets fuller than ``a`` was."""
        given = sum(gives)
        shorter = self.lengths & ((1 << min(given, self.capacity + 1)) - 1)
        shorter &= -(1 << max(0, given - self.capacity))
        while shorter:
            n = shorter.bit_length() - 1
            held = self.holders[n]
            at = bisect_left(held, (self.capacity - given + n + 1, -1)) - 1
            if at >= 0 and held[at][1] == a:
                at -= 1
            if at >= 0 and held[at][0] + given - n > self.fill[a]:
                self._exchange(a, gives, held[at][1], n)
                return True
            shorter ^= 1 << n
        return False

    def improve(self, a: int) -> bool:
        """Makes one exchange of ``a`` that increases the sum of squared fills, if there is one."""
        held = sorted(set(self.bins[a]), reverse=True)
        if any(self._take(a, gives) for gives in ((), *((n,) for n in held))):
            return True
        pairs = [
            (n, m) for i, n in enumerate(held) for m in held[i:]
            if n != m or self.bins[a].count(n) > 1
        ]
        return any(self._take(a, p) for p in pairs) or any(self._hand_over(a, p) for p in pairs)

    def search(self) -> None:
        """Exchanges until none is left that helps; in each pass the fullest bins come first."""
        improved = True
        while improved:
            improved = False
            open_bins = filter(self._open, range(len(self.bins)))
            for a in sorted(open_bins, key=lambda b: -self.fill[b]):
                while self._open(a) and self.improve(a):
                    improved = True


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Pieces in decreasing length, each into the fullest bin that has room for it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for n in sorted(lengths, reverse=True):
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(n)
        else:
            room, b = capacity, len(bins)
            bins.append([n])
        by_room[room - n].append(b)
        rooms |= 1 << (room - n)
    return bins


def _packed(group: pa.Table, capacity: int, tag: int) -> pa.Table:
    """The rows of one group with new sequence ids, offsets and fills.

    Pieces of equal length are alike, so the search works on lengths and the rows are dealt out
    afterwards. Bins of an earlier round are where the search begins.
    """
    at, lengths = group["_at"].to_numpy(), group["length"].to_numpy()
    by_length = np.lexsort((at, lengths))[::-1]
    if lengths.max() > capacity:
        raise ValueError(f"a piece of {lengths.max()} tokens exceeds {capacity}")
    earlier: dict[int, list[int]] = {}
    rows: dict[int, list[int]] = {}
    for row, b in zip(by_length.tolist(), group["sequence_id"].to_numpy()[by_length].tolist()):
        earlier.setdefault(b, []).append(int(lengths[row]))
        rows.setdefault(int(lengths[row]), []).append(row)
    bins = best_fit(lengths.tolist(), capacity)
    if tag and len(earlier) <= len(bins):
        bins = list(earlier.values())
    found = OpenBins(bins, capacity)
    found.search()
    first = (tag << 56) | (group["_group"][0].as_py() << 24)
    order, placed = [], []
    for number, held in enumerate(b for b in found.bins if b):
        offset, fill = 0, sum(held)
        for n in sorted(held, reverse=True):
            order.append(rows[n].pop())
            placed.append((first + number, offset, fill))
            offset += n
    columns = np.array(placed, np.int64).T
    result = group.take(order)
    for name, values in zip(("sequence_id", "offset", "_fill"), columns):
        at = result.schema.get_field_index(name)
        result = result.set_column(at, name, pa.array(values))
    return result


def _searching(capacity: int, tag: int):
    def search(group: pa.Table) -> pa.Table:
        return _packed(group, capacity, tag)

    return search


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` with sequence_id and offset, in as few sequences as the search finds.

    Needs a column ``length``; one beyond ``capacity`` fails the job. Columns sequence_id and
    offset, where present, are replaced. ``group`` is the mean number of pieces searched together.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    stored = written(
        pieces.select(*columns).withColumn("_at", F.monotonically_increasing_id()), "pieces"
    )
    # A piece as long as a sequence is one; those of the rounds have ids from 0.
    alone = F.col("length") == capacity
    whole = stored.where(alone).select(
        *columns, (-1 - F.col("_at")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    left = stored.where(~alone).withColumns({
        "sequence_id": F.col("_at"), "offset": F.lit(0).cast("long"),
        "_fill": F.col("length"), "_group": F.lit(0).cast("long"),
    })
    done, tag = [whole], 0
    n_pieces, n_bins = left.count(), math.inf
    while n_pieces:
        groups = -(-n_pieces // group)
        dealt = F.pmod(F.xxhash64("sequence_id", F.lit(tag)), F.lit(groups)).cast("long")
        grouped = left.withColumn("_group", dealt).groupBy("_group")
        packed = written(
            grouped.applyInArrow(_searching(capacity, tag), left.schema), f"packed-{tag}"
        )
        is_open = F.col("_fill") < capacity
        before = n_bins
        counted = packed.where(is_open).agg(
            F.count(F.lit(1)).alias("pieces"), F.count_if(F.col("offset") == 0).alias("bins")
        ).first()
        n_pieces, n_bins = counted["pieces"], counted["bins"]
        stuck = 2 * -(-n_pieces // group) > groups and n_bins > (1 - _WORTHWHILE) * before
        if groups == 1 or stuck:
            done.append(packed.select(*whole.columns))
            break
        done.append(packed.where(~is_open).select(*whole.columns))
        left, tag = packed.where(is_open), tag + 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of every sequence, from packed pieces with their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.expr("aggregate(parts, cast('' as binary), (all, p) -> concat(all, p.ids))")
    found = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    return found.select("sequence_id", "n_tokens", joined.alias("ids"))


def op12_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1,024 tokens."""
    pieces = pieces_of(table(spark, sf_dir, "documents"))
    named = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(named).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
