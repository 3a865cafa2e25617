"""Importance resampling of documents towards a target distribution.

Features are runs of consecutive words, hashed into a fixed number of buckets. The counts of both
tables give one gain per bucket, and a document's weight is the floored mean of its features'
gains, read from that array. Weighted drawing without replacement keeps the greatest sums of weight
and Gumbel noise, where the noise depends on the id alone.

The cutoff of the draw is found without sorting all scores: a mergeable quantile sketch proposes a
bracket of scores, exact counts of the rows beyond it confirm that the wanted place lies inside
(else the bracket is widened, at last without bounds), and only the rows of the bracket are sorted,
in range partitions. The rows that are drawn get their ranks in range partitions as well.

Only the bucket counts, the sketch, a few counts and the cutoff row come to the driver; none of them
grows with the documents. Texts are not shuffled.

Defined results: a null or empty text has no features and weight 0; a null id has the noise of an
empty id and stands before all ids of the same score; repeated rows are scored and drawn each; an
empty table gives an empty result, an empty target the counts 0; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import in_portions, ranked, table, whole_text, written

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
#: Accuracy of the sketch; its place in the order is off by less than ``_MARGIN`` as a rule.
_SKETCH = 2_000
_MARGIN = 0.004
#: Words whose checksum a worker remembers.
_REMEMBERED = 500_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class Features(dict):
    """Checksums of words, computed once each, and the feature buckets of whole texts."""

    def __init__(self, shortest: int, longest: int, buckets: int):
        if not 1 <= shortest <= longest or buckets < 1:
            raise ValueError("runs have 1 or more words and there is at least one bucket")
        self.shortest, self.longest, self.buckets = shortest, longest, buckets

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = found = zlib.crc32(word)
        return found

    def of(self, text: str) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of every run of words."""
        words = _WORD.findall(text.encode().lower())
        sums = list(map(self.__getitem__, words))
        found = list(sums) if self.shortest == 1 else []
        for length in range(2, self.longest + 1):
            sums = [zlib.crc32(b" " + w, c) for c, w in zip(sums, words[length - 1 :])]
            if length >= self.shortest:
                found += sums
        return len(words), np.array(found, np.int64) % self.buckets


def bucket_counts(texts: DataFrame, shortest: int, longest: int, buckets: int) -> np.ndarray:
    """How many features of all rows fall into each bucket."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, counts = Features(shortest, longest, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"]:
                counts += np.bincount(features.of(text)[1], minlength=buckets)
        held = np.flatnonzero(counts)
        yield from in_portions(pd.DataFrame({"bucket": held, "n": counts[held]}))

    found = texts.select(whole_text().alias("text")).mapInPandas(count, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    # At most one row per bucket.
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket 1,000 times the log ratio of its smoothed shares of target and source."""
    s, t, n = source.astype(float), target.astype(float), float(len(source))
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """1,000 times a Gumbel variate that depends on the id alone, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((head + 0.5) / 4294967296.0)))


def weighted(docs: DataFrame, gains: np.ndarray, shortest: int, longest: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features = Features(shortest, longest, len(gains))
        for texts in batches:
            rows = []
            for text in texts:
                words, held = features.of(text)
                rows.append((words, len(held), int(gains[held].sum()) // max(1, len(held))))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "weight"])

    return docs.select("doc_id", weigh(whole_text()).alias("found")).select("doc_id", "found.*")


def bracket(values: DataFrame, column: str, k: int, n: int) -> tuple[int | None, int | None, int]:
    """(low, high, rows above high): the ``k``-th greatest of ``n`` values lies within, both
    bounds included; None is no bound. ``values`` is read once for the sketch and once per
    attempt to confirm."""
    sketch = F.kll_sketch_agg_bigint(column, F.lit(_SKETCH))
    place, margin = 1 - k / n, _MARGIN
    while True:
        low_at, high_at = place - margin, place + margin
        bounds = values.agg(sketch.alias("s")).select(
            *[F.kll_sketch_get_quantile_bigint("s", F.lit(min(1.0, max(0.0, at)))).alias(name)
              for name, at in (("low", low_at), ("high", high_at))]
        ).first()
        low = bounds["low"] if low_at > 0 else None
        high = bounds["high"] if high_at < 1 else None
        value = F.col(column)
        above = F.count_if(value > high) if high is not None else F.lit(0)
        below = F.count_if(value < low) if low is not None else F.lit(0)
        counts = values.agg(above.alias("above"), below.alias("below")).first()
        if counts["above"] < k <= n - counts["below"]:
            return low, high, counts["above"]
        margin *= 4


def draw(scored: DataFrame, eligible: Column, k: int, n: int) -> DataFrame:
    """Appends ``rank``, from 1, to the ``k`` of the ``n`` eligible rows with the greatest score.

    Ties go to the smaller id, then to the smaller of the other columns. ``scored`` is a table.
    """
    ties = [c for c in scored.columns if c not in ("score", "doc_id")]
    score, doc_id = F.col("score"), F.col("doc_id")
    order = [score.desc(), doc_id.asc_nulls_first(), *map(F.asc, ties)]
    low, high, above = bracket(scored.where(eligible), "score", k, n)
    inside = eligible
    if low is not None:
        inside = inside & (score >= low)
    if high is not None:
        inside = inside & (score <= high)
    placed = ranked(scored.where(inside), order, "rank", "bracket")
    last = placed.where(F.col("rank") == k - above).first()
    no_later = doc_id.isNull()
    if last["doc_id"] is not None:
        no_later = no_later | (doc_id <= last["doc_id"])
    taken = eligible & ((score > last["score"]) | ((score == last["score"]) & no_later))
    chosen = ranked(scored.where(taken), order, "rank", "drawn")
    # Rows that repeat the last one's score and id may be too many.
    chosen = chosen.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return chosen.unionByName(scored.where(~taken).withColumn("rank", F.lit(None).cast("long")))


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    shortest: int = 1,
    longest: int = 1,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Every document with n_words, n_features, weight, score and its rank in the draw, else NULL.

    ``percent`` of the documents with at least ``min_words`` words are drawn. ``target`` holds the
    texts whose distribution is wanted.
    """
    source = bucket_counts(docs, shortest, longest, buckets)
    gains = gains_of(source, bucket_counts(target, shortest, longest, buckets))
    scores = weighted(docs, gains, shortest, longest).withColumn(
        "score", F.col("weight") + noise(F.col("doc_id"), seed)
    )
    scored = written(scores, "scored")
    eligible = F.col("n_words") >= min_words
    n = scored.where(eligible).count()
    k = percent * n // 100
    if not k:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    return draw(scored, eligible, k, n)


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """Draws a tenth of the documents towards the benchmark's distribution of words."""
    found = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


#: The table of the CRC-32 polynomial, by its rule.
_CRC_TABLE = []
for _byte in range(256):
    for _ in range(8):
        _byte = (_byte >> 1) ^ (0xEDB88320 * (_byte & 1))
    _CRC_TABLE.append(_byte)

OP11_SQL = f"""
WITH words AS (
  SELECT kind, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM (SELECT 'd' AS kind, doc_id, text FROM documents
        UNION ALL SELECT 'b', item_id, text FROM benchmark) t),
features AS (SELECT kind, doc_id, unnest(w) AS word FROM words),
crc_table AS (SELECT {_CRC_TABLE}::BIGINT[] AS crc),
vocabulary AS (
  SELECT word, xor(list_reduce(
           [4294967295::BIGINT] || list_transform(range(1, 2 * octet_length(encode(word)), 2),
             lambda i: ('0x' || substr(hex(encode(word)), i, 2))::BIGINT),
           lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)
           % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT word FROM features) v, crc_table),
bucketed AS (SELECT kind, doc_id, bucket FROM features JOIN vocabulary USING (word)),
gains AS (
  SELECT bucket, floor(1000 * ln(
           ((t + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS})::DOUBLE)
           / ((s + 1)::DOUBLE * (sum(t) OVER () + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM (SELECT bucket, count(*) FILTER (WHERE kind = 'd') AS s,
               count(*) FILTER (WHERE kind = 'b') AS t FROM bucketed GROUP BY bucket) c),
weights AS (
  SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM bucketed JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((
           ('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN weights USING (doc_id)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= {MIN_WORDS}
                               ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_features >= {MIN_WORDS}) AS n
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= {MIN_WORDS} AND place <= {PERCENT} * n // 100 THEN place END AS rank
FROM placed"""
