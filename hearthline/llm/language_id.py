"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text's vector counts its byte bigrams and trigrams, letters only and lower-cased, hashed to
``DIMENSIONS`` places, as ``log(1 + count) * idf``, scaled to length one. Document frequencies
are counted over all learning documents. The vectors of each language in a bounded sample are
clustered into a few centroids (spherical k-means from farthest-first seeds); a text has the
language of the centroid with the largest cosine.

Rejection is by distance: a text is rejected if its cosine lies more than ``margin`` below a low
quantile of what the learning documents of its language and length reach, and so is one without a
letter. These cosines are counted in bins over all learning documents, and at least the lowest of
a class is passed over, so that a few odd texts do not set a bound. Length classes are powers of
two of the number of n-grams; a shorter class never has a higher bound than a longer one. A class
with few learning documents takes the bound of the next shorter one that has enough, a language
without any that of all languages together; classes below all of these reject nothing. A centroid
that stands for few texts of its language is left out.

``sample`` bounds the learning documents that are clustered, for all languages together; which
ones are taken depends on a hash of their id. Everything else covers all documents.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without any
learning document every text is ``und``; equal cosines go to the first language by name;
repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import in_portions, packed, table, unpacked

DIMENSIONS = 4096
CENTROIDS = 4
SAMPLE = 3000
#: Texts are rejected this far below the quantile of the cosines of their class.
MARGIN, QUANTILE = 0.15, 0.005
#: Learning documents that a class needs for a bound of its own.
WELL_KNOWN = 30
#: Equal ranges in which cosines are counted.
BINS = 400
UNDETERMINED = "und"
_LETTERS = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256))
_ROWS = 256
#: Share of a language's sample that a centroid needs.
_COMMON = 0.01


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of hashed byte bigrams and trigrams; None for a text without a letter."""
    words = text.lower().encode().translate(_LETTERS).split()
    if not words or not any(c.isalpha() for c in text):
        return None
    codes = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint32)
    pairs = codes[:-1] << 8 | codes[1:]
    triples = pairs[:-1] << 8 | codes[2:] | np.uint32(1 << 24)
    grams = np.concatenate([pairs, triples]) * np.uint32(2654435761)
    return np.bincount(grams >> np.uint32(20), minlength=DIMENSIONS)


def vectors(counts: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Unit vectors, one per row."""
    found = np.log1p(np.array(counts, dtype=np.float32)) * idf
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)


def clustered(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; the first seed is the point nearest the mean, the next the farthest."""
    chosen = [int((points @ points.mean(axis=0)).argmax())]
    while len(chosen) < min(k, len(points)):
        nearest = (points @ points[chosen].T).max(axis=1)
        if nearest.min() > 1 - 1e-6:
            break
        chosen.append(int(nearest.argmin()))
    centers = points[chosen]
    for _ in range(rounds):
        own = (points @ centers.T).argmax(axis=1)
        centers = np.array([
            points[own == c].mean(axis=0) if (own == c).any() else centers[c]
            for c in range(len(centers))
        ])
        centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
    # Seeds far from everything are often odd texts, which should not stand for a language.
    sizes = np.bincount((points @ centers.T).argmax(axis=1), minlength=len(centers))
    common = sizes >= max(2, _COMMON * len(points))
    return centers[common] if common.any() else centers


def length_class(counts: np.ndarray) -> int:
    return int(counts.sum()).bit_length()


def _bounds(by_size: dict[int, np.ndarray], margin: float) -> list[tuple[int, float]]:
    """(length class, least cosine) of the classes with enough texts, in ascending order."""
    bounds, highest = [], 1.0
    for size in sorted(by_size, reverse=True):
        held = by_size[size]
        if held.sum() >= WELL_KNOWN:
            passed = max(1, int(QUANTILE * held.sum()))
            at = int(np.searchsorted(np.cumsum(held), passed, "right"))
            highest = min(highest, at / BINS - margin)
            bounds.insert(0, (size, highest))
    return bounds


class CentroidModel:
    """Centroids of each language and the least cosine of each of its length classes."""

    def __init__(self, idf: np.ndarray, languages: list[str], counts: list[np.ndarray], k: int):
        self.idf = idf.astype(np.float32)
        self.languages = sorted(set(languages))
        #: By language, the classes with a bound in ascending order.
        self.least: list[list[tuple[int, float]]] = [[] for _ in self.languages]
        self.least_of_all: list[tuple[int, float]] = []
        if not languages:
            return
        points, labels = vectors(counts, self.idf), np.array(languages)
        centers = [clustered(points[labels == name], k) for name in self.languages]
        self.centers = np.concatenate(centers).astype(np.float32)
        self.owner = np.repeat(np.arange(len(centers)), [len(c) for c in centers])

    def nearest(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, int]]:
        """(place, language, cosine, length class) of each text with a letter."""
        if not self.languages:
            return
        for first in range(0, len(texts), _ROWS):
            counts = [gram_counts(t or "") for t in texts[first : first + _ROWS]]
            known = [i for i, c in enumerate(counts) if c is not None]
            if not known:
                continue
            cosines = vectors([counts[i] for i in known], self.idf) @ self.centers.T
            for i, row in zip(known, cosines):
                at = int(row.argmax())
                cosine = min(1.0, max(0.0, float(row[at])))
                yield first + i, int(self.owner[at]), cosine, length_class(counts[i])

    def set_bounds(self, counted: dict[tuple[int, int], np.ndarray], margin: float) -> None:
        """Bounds from the counts of cosines in bins, by language and length class."""
        every: dict[int, np.ndarray] = {}
        for (_, size), held in counted.items():
            every[size] = every.get(size, 0) + held
        self.least = [
            _bounds({z: held for (g, z), held in counted.items() if g == language}, margin)
            for language in range(len(self.languages))
        ]
        self.least_of_all = _bounds(every, margin)

    def bound(self, language: int, size: int) -> float:
        """The bound of the longest class up to ``size``; of all languages if its own has none."""
        for bounds in (self.least[language], self.least_of_all):
            known = [bound for z, bound in bounds if z <= size]
            if known:
                return known[-1]
        return 0.0

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected) of each text."""
        results = [(UNDETERMINED, 0.0, True)] * len(texts)
        for place, language, cosine, size in self.nearest(texts):
            rejected = cosine < self.bound(language, size)
            results[place] = self.languages[language], cosine, rejected
        return results


def held_out() -> Column:
    """Documents that nothing is learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def fit(docs: DataFrame, k: int = CENTROIDS, sample: int = SAMPLE, margin: float = MARGIN) -> CentroidModel:
    """Learns from ``text`` and ``lang`` of the documents that are not held out."""
    learning = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                counts = gram_counts(text)
                if counts is not None:
                    held += counts > 0
                    n += 1
        yield pd.DataFrame({"place": np.arange(-1, DIMENSIONS), "n": np.append(n, held)})

    summed = (
        learning.select("text").mapInPandas(count, "place int, n long")
        .groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    )
    held = np.zeros(DIMENSIONS + 1)
    held[summed["place"].to_numpy(dtype=int) + 1] = summed["n"]
    idf = np.log((1 + held[0]) / (1 + held[1:])) + 1

    sizes = {r["lang"]: r["count"] for r in learning.groupBy("lang").count().collect()}
    share = max(1, sample // max(1, len(sizes)))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30))
    taken = F.lit(False)
    for language, size in sizes.items():
        taken = taken | ((F.col("lang") == language) & (draw < int(min(1, share / size) * (1 << 30))))

    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        found = map(gram_counts, texts)
        return pd.Series([None if c is None else c.astype("<u4").tobytes() for c in found])

    rows = (
        learning.where(taken).orderBy("doc_id", "text").select("lang", features("text").alias("counts"))
        .where("counts IS NOT NULL").toPandas()
    )
    model = CentroidModel(
        idf, rows["lang"].tolist(), [np.frombuffer(c, "<u4") for c in rows["counts"]], k
    )
    model.set_bounds(cosine_counts(learning, model), margin)
    return model


def cosine_counts(learning: DataFrame, model: CentroidModel) -> dict[tuple[int, int], np.ndarray]:
    """Cosines of all learning documents in bins, by predicted language and length class."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[tuple[int, int, int]] = Counter()
        for batch in batches:
            for _, language, cosine, size in model.nearest(batch["text"].tolist()):
                counts[language, size, min(BINS - 1, int(cosine * BINS))] += 1
        rows = [(*key, n) for key, n in counts.items()]
        yield from in_portions(pd.DataFrame(rows, columns=["language", "size", "bin", "n"]))

    found = learning.select("text").mapInPandas(count, "language int, size int, bin int, n long")
    held: dict[tuple[int, int], np.ndarray] = {}
    # At most one row per language, length class and bin.
    for r in found.groupBy("language", "size", "bin").agg(F.sum("n").alias("n")).collect():
        bins = held.setdefault((r["language"], r["size"]), np.zeros(BINS, np.int64))
        bins[r["bin"]] = r["n"]
    return held


def predicted(model: CentroidModel, text: Column) -> Column:
    """A struct of lang_pred, score and rejected."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(
                model.predict(texts.tolist()), columns=["lang_pred", "score", "rejected"]
            )

    return run(text)


def language_id(docs: DataFrame, model: CentroidModel) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row; only the text is looked at."""
    found = predicted(model, F.col("text"))
    return docs.select("doc_id", found.alias("found")).select("doc_id", "found.*")


def accepted(docs: DataFrame, model: CentroidModel) -> DataFrame:
    """``docs`` without those the model rejects."""
    found = packed(docs).withColumn("found", predicted(model, F.col("row.text")))
    return unpacked(found.where(~F.col("found.rejected")), docs.columns)


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id(documents, fit(documents))
    return found.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score",
        "rejected",
    )
