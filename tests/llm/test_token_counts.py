import random

import sentencepiece
from pyspark.sql import functions as F

from hearthline.llm.common import vocabulary_path
from hearthline.llm.token_counts import VOCABULARY, ChunkedCounter, token_counts

from .conftest import pairs


def library():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(VOCABULARY))


def test_chunks_agree_with_the_library():
    model, draw = library(), random.Random(7)
    counter = ChunkedCounter(vocabulary_path(VOCABULARY), chunk=40, overlap=4)
    for n in range(400):
        if n % 2:
            text = "".join(draw.choice("ab  the 中😀\n a▁") for _ in range(draw.randint(0, 300)))
        else:
            text = draw.choice(["a", "=", "ha", " ", "\n", "▁"]) * draw.randint(0, 300)
        assert counter.count_long(text) == len(model.encode(text)), text


def test_awkward_documents(docs, small):
    model = library()
    for frame in (docs, small):
        got = token_counts(frame, chunk=1000, overlap=8)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
        want = [(i, len(t.encode()), len(model.encode(t))) for i, t in pairs(frame)]
        key = lambda r: str(r)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_empty_table(no_docs):
    assert token_counts(no_docs).where(F.col("n_tokens") >= 0).count() == 0
