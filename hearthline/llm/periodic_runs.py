"""Periodic runs of words: stretches that repeat a block of words at least four times.

A run of period ``q`` and length ``L`` is, at lag ``q``, a stretch of ``L - q`` places whose word
equals the word ``q`` places on. With at least ``e`` repetitions that stretch has ``(e - 1) * q``
places or more, so lags are searched in classes: the first class takes k-grams as long as the
shortest stretch that any run leaves, each further one k-grams three times as long (twice for
``e = 3``), always for the lags up to ``k`` that are not done yet. The least stretch of those lags
is never shorter than ``k``.

* Seeds: pairs of occurrences of one k-gram in the same document, whose distance is a lag of the
  class. As ``k`` is at least the lag, the next occurrence of a k-gram inside a run is exactly one
  smallest period on, so neighbouring occurrences are all the pairs needed, and their number is
  bounded by the words.
* Extension: a seed is extended to both sides on its diagonal, as long as words agree.
* A table of the furthest place covered at each lag skips the seeds inside a stretch already found.

k-grams are numbered exactly, from the numbers of the shorter ones; nothing is hashed. A document is
searched within its row, in O(n log n) for n words; nothing is shuffled or sent to the driver.

Defined results: a null, empty or blank text has no words and no runs; repeated rows are searched
each; an empty table gives an empty result; columns of other names stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import table, whole_text

MIN_LENGTH = 6
MIN_REPEATS = 4
_RUN = ("start", "length", "period")


def _renumbered(keys: np.ndarray) -> np.ndarray:
    """Equal keys as equal numbers below ``len(keys)``."""
    return np.unique(keys, return_inverse=True)[1]


def _grams(ids: np.ndarray, offsets: list[int]) -> np.ndarray:
    """A number for the joined entries of ``ids`` at ``offsets`` from each place, where they fit."""
    n, base = len(ids) - offsets[-1], int(ids.max()) + 1
    found, bound = ids[:n], base
    for offset in offsets[1:]:
        if bound * base >= 1 << 62:
            found = _renumbered(found)
            bound = n
        found = found * base + ids[offset : offset + n]
        bound *= base
    return _renumbered(found)


def _agreeing(words: np.ndarray, at: int, lag: int) -> int:
    """End of the stretch from ``at`` on in which words equal those ``lag`` places on."""
    step, last = 32, len(words) - lag
    while at < last:
        to = min(last, at + step)
        differ = np.flatnonzero(words[at:to] != words[at + lag : to + lag])
        if len(differ):
            return at + int(differ[0])
        at, step = to, 2 * step
    return last


def _begin(words: np.ndarray, at: int, lag: int) -> int:
    """Begin of the stretch that ends before ``at``."""
    step = 32
    while at > 0:
        start = max(0, at - step)
        differ = np.flatnonzero(words[start:at] != words[start + lag : at + lag])
        if len(differ):
            return start + int(differ[-1]) + 1
        at, step = start, 2 * step
    return 0


def _seeds(grams: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(lags, places), sorted, of the neighbouring occurrences ``low`` to ``high`` places apart."""
    order = np.argsort(grams, kind="stable")
    lags = np.diff(order)
    near = (np.diff(grams[order]) == 0) & (lags >= low) & (lags <= high)
    places, lags = order[:-1][near], lags[near]
    sort = np.lexsort((places, lags))
    return lags[sort], places[sort]


def _stretches(words: np.ndarray, lags: np.ndarray, places: np.ndarray, k: int):
    """(lag, begin, end) of the stretches on the diagonals of the seeds, each once."""
    at, covered = 0, {}
    while at < len(lags):
        lag, place = int(lags[at]), int(places[at])
        begin = _begin(words, place, lag)
        covered[lag] = _agreeing(words, place + k, lag)
        yield lag, begin, covered[lag]
        # The next seed at this lag that is not covered, else the first one at the next lag.
        last = int(np.searchsorted(lags, lag, "right"))
        at += int(np.searchsorted(places[at:last], covered[lag]))


def runs_of(
    words: np.ndarray, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS
) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period; ``words`` are numbers.

    A run has its smallest period, at least ``min_length`` words and ``min_repeats`` repetitions
    (2 or more), and no neighbouring word continues it.
    """
    if min_repeats < 3:
        raise ValueError("a run repeats its block at least three times")
    found, n = [], len(words)
    k = min(max(min_repeats * q, min_length) - q for q in range(1, max(2, min_length)))
    longer, low = min(3, min_repeats - 1), 1
    grams, of = words, [*range(k)]
    while len(grams) > of[-1] and low * min_repeats <= n:
        grams = _grams(grams, of)
        if grams.max() == len(grams) - 1:  # no k-gram occurs twice
            break
        for lag, begin, end in _stretches(words, *_seeds(grams, low, k), k):
            length = end - begin + lag
            if length >= max(min_length, min_repeats * lag):
                found.append((begin, length, lag))
        of, low, k = [k * i for i in range(longer)], k + 1, k * longer
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that are in no run, or in one only among its first period."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept)]


def periodic_runs(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS
) -> DataFrame:
    """doc_id, n_words, the runs by start and period, and the text with each run's block once."""

    kind = pa.list_(pa.struct([(name, pa.int64()) for name in _RUN]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, listed, texts = [], [], []
            for text in batch["text"].to_pylist():
                words, numbers = text.encode().split(), {}
                ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
                runs = runs_of(ids, min_length, min_repeats)
                counts.append(len(words))
                listed.append([dict(zip(_RUN, r)) for r in runs])
                texts.append(b" ".join(collapsed(words, runs)).decode())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(listed, kind),
                 pa.array(texts, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    fields = ", ".join(f"{name}: bigint" for name in _RUN)
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        find,
        f"doc_id {id_type}, n_words long, runs array<struct<{fields}>>, collapsed string",
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, a tenth of the texts with a block of words repeated up to their end."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    share = F.floor(checksum / 10)
    words = F.regexp_extract_all(whole_text(), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))

    def repeated(held: Column) -> Column:
        n = F.size(held)
        first = share % n
        period = 1 + F.floor((n - first) / (3 + share % 8))

        def chosen(word: Column, i: Column) -> Column:
            return F.when(i < first, word).otherwise(
                F.get(held, (first + (i - first) % period).cast("int"))
            )

        return F.when(n > 0, F.array_join(F.transform(held, chosen), " ")).otherwise(F.lit(""))

    # Inside a lambda the words are split once, not once per word.
    edited = F.get(F.transform(F.array(words), repeated), F.lit(0))
    planted = F.when(checksum % 10 == 0, edited).otherwise(whole_text())
    return docs.select("doc_id", planted.alias("text"))


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, after a block was repeated in a tenth of them."""
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(
            r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period")
        ))
    )
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
