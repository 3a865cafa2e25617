"""Token counts of whole documents, huge ones by overlapping chunks that resynchronise.

A text of at most ``chunk`` characters is encoded at once. A longer one is encoded in chunks
that overlap by ``overlap`` characters, with offsets. Neighbouring chunks are spliced at a
*stable* boundary inside the overlap: a position between two characters that stand side by side
in no piece of the vocabulary. No merge can reach over such a position, so the encodings of its
two sides do not depend on each other, and the pieces of a chunk between two stable boundaries
are those of the whole text. Where an overlap has no stable boundary, or the two encodings do
not both begin a piece there, the overlap is doubled, at the worst to the whole text. Memory is
bounded by the chunk where stable boundaries occur, as in any text with spaces; a text without one
is encoded whole, as its pieces may depend on all of it.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted each;
an empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import vocabulary_path, whole_text

VOCABULARY = "piece_bpe_32k.model"
CHUNK = 24_576
OVERLAP = 256
_SPACE = "▁"


class ChunkedCounter:
    """Counts the pieces of a text with a sentencepiece BPE model that has no text rewriting."""

    def __init__(self, model_file: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        if not 0 < overlap < chunk:
            raise ValueError("the overlap must be positive and below the chunk's length")
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.chunk, self.overlap = chunk, overlap
        self.joined = {
            pair
            for i in range(self.model.get_piece_size())
            if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))
            for piece in [self.model.id_to_piece(i)]
            for pair in zip(piece, piece[1:])
        }

    def counts(self, texts: list[str]) -> list[int]:
        short = [t if len(t) <= self.chunk else "" for t in texts]
        found = self.model.encode(short, num_threads=1)
        return [
            len(ids) if len(t) <= self.chunk else self.count_long(t)
            for t, ids in zip(texts, found)
        ]

    def count_long(self, text: str) -> int:
        """Pieces of ``text``, of which no more than about a chunk is encoded at a time."""
        start, end = 0, min(len(text), self.chunk)
        begins, total, done = self._begins(text[start:end]), 0, 0
        while end < len(text):
            overlap = self.overlap
            while True:
                next_start = max(start, end - overlap)
                next_end = min(len(text), next_start + max(self.chunk, 2 * overlap))
                following = self._begins(text[next_start:next_end])
                cut = self._splice(text, start, begins, next_start, following, done, end)
                if cut is not None:
                    break
                if next_start == start and next_end == len(text):
                    # No boundary at all: the last encoding holds all that is left.
                    cut = done
                    break
                overlap *= 2
                if next_start == start:
                    # The overlap is the whole chunk: make the chunk itself longer.
                    begins, end = following, next_end
                    if end == len(text):
                        break
            if cut is None:
                break
            total += self._before(begins, text, start, cut) - self._before(begins, text, start, done)
            start, end, begins, done = next_start, next_end, following, cut
        return total + len(begins) - self._before(begins, text, start, done)

    def _begins(self, text: str) -> list[int]:
        pieces = self.model.encode(text, return_type="proto").pieces
        return [p.begin for p in pieces]

    @staticmethod
    def _before(begins: list[int], text: str, start: int, position: int) -> int:
        """Pieces of the chunk at ``start`` that begin before ``position``."""
        from bisect import bisect_left

        if position == start:
            return 0
        return bisect_left(begins, len(text[start:position].encode()))

    def stable(self, text: str, position: int) -> bool:
        pair = text[position - 1 : position + 1].replace(" ", _SPACE)
        return (pair[0], pair[1]) not in self.joined

    def _splice(self, text, start, begins, next_start, following, done, end) -> int | None:
        """The first position of the overlap that is stable and begins a piece in both chunks."""
        both = None
        for position in range(max(next_start + 1, done + 1), end):
            if not self.stable(text, position):
                continue
            if both is None:
                both = set(begins), set(following)
            if (
                len(text[start:position].encode()) in both[0]
                and len(text[next_start:position].encode()) in both[1]
            ):
                return position
        return None


@lru_cache(maxsize=4)
def _counter(name: str, chunk: int, overlap: int) -> ChunkedCounter:
    return ChunkedCounter(vocabulary_path(name), chunk, overlap)


def token_counts(
    docs: DataFrame, vocabulary: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs``."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(vocabulary, chunk, overlap)
        for texts in batches:
            yield pd.Series(counter.counts(texts.tolist()), dtype="int64")

    text = whole_text()
    return docs.select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        count(text).alias("n_tokens"),
    )


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether it exceeds a context of 4096 tokens."""
    from hearthline.llm.common import table

    counts = token_counts(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)
