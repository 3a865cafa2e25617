"""Document fingerprints by I-Match with randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency lies in a band, counted over all
documents: neither the common words nor the rare ones. Each of several random subsets keeps a
term by a hash of the term: all terms in the first, half, a quarter and an eighth of them in the
next six, one in 16 and so on down to one in 2048 in the others. A document's part of a subset is the hash of its sorted distinct terms there; the
fingerprint is the sequence of parts. Large subsets change with any edit, small ones survive
many, so the share of equal parts grades the likeness of two documents of any length.

``MIN_SHARE`` bounds the lexicon: each term is in at least that share of the documents, so there
are at most (distinct terms of an average document) / ``MIN_SHARE`` terms, whatever the number of
documents. That is what the executors are given. The counts are summed in the task before they
are shuffled; no term's documents ever meet.

Defined results: a null text is empty; a text without a term in any
subset has the hash of all its terms in every part, so that texts of other terms have another one; a part without a
term counts for the likeness only where the other document has one; repeated rows are fingerprinted
each; an empty table gives an empty result; other columns are ignored. The next document of
equal ids is the one whose text has the next hash; null ids come first.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import in_portions, table, whole_text

MIN_SHARE, MAX_SHARE = 0.0005, 0.1
#: One subset per entry: it keeps one of so many terms.
SUBSETS = (1, 2, 2, 4, 4, 8, 8) + tuple(1 << k for k in range(4, 12) for _ in range(4))
_NONE = "0" * 16
_TERM = re.compile(r"\w+")
#: Terms a task counts before it passes the counts on.
_COUNTED = 500_000
#: Documents in one stretch of the order of ids, where the shuffle partitions allow so many.
STRETCH = 1024


def terms_of(text: str) -> set[str]:
    return set(_TERM.findall(text.lower()))


def _digest(terms: list[str]) -> str:
    return hashlib.blake2b("\n".join(terms).encode(), digest_size=8).hexdigest()


@lru_cache(maxsize=200_000)
def _kept_in(term: str, subsets: tuple[int, ...]) -> tuple[int, ...]:
    """The subsets that keep a term."""
    import xxhash

    return tuple(
        i for i, one_of in enumerate(subsets) if xxhash.xxh64_intdigest(term, i) % one_of == 0
    )


def parts_of(text: str, lexicon: frozenset[str], subsets=SUBSETS) -> list[str]:
    """The document's hash in each subset."""
    found = terms_of(text)
    kept: list[list[str]] = [[] for _ in subsets]
    for term in sorted(found & lexicon):
        for i in _kept_in(term, subsets):
            kept[i].append(term)
    if not any(kept):
        return [_digest(sorted(found))] * len(subsets)
    return [_digest(terms) if terms else _NONE for terms in kept]


def likeness(a: list[str], b: list[str]) -> float:
    """Share of equal parts, of those where either document has a term."""
    if a == b:
        return 1.0
    seen = [x == y for x, y in zip(a, b) if x != _NONE or y != _NONE]
    return sum(seen) / len(seen) if seen else 0.0


def lexicon(
    docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE
) -> frozenset[str]:
    """Terms in at least ``min_share`` and at most ``max_share`` of all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()

        def given() -> pd.DataFrame:
            return pd.DataFrame({"term": list(counts), "n": list(counts.values())})

        for batch in batches:
            for text in batch["text"]:
                counts.update(terms_of(text))
                if len(counts) > _COUNTED:
                    yield from in_portions(given())
                    counts.clear()
        yield from in_portions(given())

    texts = docs.select(whole_text().alias("text"))
    size = docs.count()
    held = (
        texts.mapInPandas(count, "term string, n long")
        .groupBy("term").agg(F.sum("n").alias("n"))
        .where((F.col("n") >= min_share * size) & (F.col("n") <= max(1.0, max_share * size)))
    )
    return frozenset(held.select("term").toPandas()["term"])


def fingerprints(docs: DataFrame, terms: frozenset[str], subsets=SUBSETS) -> DataFrame:
    """(doc_id, parts) of every row."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([parts_of(t, terms, subsets) for t in texts])

    return docs.select("doc_id", run(whole_text()).alias("parts"))


def in_stretches(docs: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Rows in stretches of the order of ids, each closed by the first row of the next stretch.

    Rows of one id, or of none, are ordered by the hash of their text, so that many of them spread
    over stretches too; only rows equal in both stay together. Only the first id and hash of each
    stretch come to the driver. The texts are shuffled once, compressed (``packed_text``).
    """

    @F.pandas_udf("binary")
    def compressed(texts: pd.Series) -> pd.Series:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        return pd.Series([pack(t.encode()) for t in texts])

    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    # Any number gives the same pairs; a few per shuffle partition keep their sizes even.
    most = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = max(1, min(-(-docs.count() // stretch), most))
    text_hash = F.xxhash64(whole_text())
    firsts = (
        docs.select(order.alias("place"), text_hash.alias("text_hash"))
        .repartitionByRange(count, "place", "text_hash")
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min(F.struct("place", "text_hash")).alias("first"))
        .select("first.*").orderBy("place", "text_hash").toPandas()
    )
    first_places = firsts["place"].to_numpy(dtype=np.int64)
    first_hashes = firsts["text_hash"].astype("int64").tolist()

    @F.pandas_udf("array<struct<stretch: int, closing: boolean>>")
    def stretches(places: pd.Series, hashes: pd.Series) -> pd.Series:
        values, result = places.to_numpy(), []
        lows = np.searchsorted(first_places, values, side="left").tolist()
        highs = np.searchsorted(first_places, values, side="right").tolist()
        for low, high, text_hash in zip(lows, highs, hashes.tolist()):
            # Among the stretches that begin with this very id the hash decides.
            s = bisect_right(first_hashes, text_hash, low, high) - 1
            found = [{"stretch": s, "closing": False}]
            if s >= low and first_hashes[s] == text_hash:
                found.append({"stretch": (s - 1) % len(first_hashes), "closing": True})
            result.append(found)
        return pd.Series(result)

    rows = docs.select(
        "doc_id", order.alias("place"), text_hash.alias("text_hash"),
        compressed(whole_text()).alias("packed_text"),
        stretches(order, text_hash).alias("stretches"),
    )
    # Every row has a stretch; unlike inline, inline_outer adds no filter that runs the function
    # again in a Python worker of its own.
    return (
        rows.select("*", F.inline_outer("stretches")).drop("stretches")
        .repartition("stretch")
        .sortWithinPartitions("stretch", "closing", "place", "text_hash")
    )


def beside_edited(
    docs: DataFrame, terms: frozenset[str], subsets=SUBSETS, stretch: int = STRETCH
) -> DataFrame:
    """Every document with its text of which half is replaced by the next document's beginning."""
    names = [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next",
    ]

    def one(row, text, parts, following, next_parts):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        edited_parts = parts_of(edited, terms, subsets)
        return (
            row.doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(parts),
            "".join(edited_parts), likeness(parts, edited_parts), likeness(parts, next_parts),
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        unpack, before = zstandard.ZstdDecompressor().decompress, None
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False):
                if before is not None and before[0].stretch != row.stretch:
                    before = None
                if before is not None and before[0].closing:
                    # Further rows equal to the one that closes the stretch.
                    continue
                text = unpack(row.packed_text).decode()
                parts = parts_of(text, terms, subsets)
                if before is not None:
                    found.append(one(*before, text, parts))
                before = row, text, parts
            frame = pd.DataFrame(found, columns=names)
            yield from in_portions(frame.astype({"doc_id": "Int64"}))

    return in_stretches(docs, stretch).mapInPandas(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def op1_imatch(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return beside_edited(documents, lexicon(documents))
