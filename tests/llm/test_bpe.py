import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from hearthline.llm import bpe
from hearthline.llm.common import vocabulary_path

from .conftest import pairs


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path(bpe.VOCABULARY))


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_random_texts_agree_with_the_library(library):
    coder, draw = bpe.encoder(bpe.VOCABULARY), random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz" * 3 + "ABC 0'.  !éßÀ\n\x1c\x85 中😀ΣİǅḰ"
    labels = [t.replace("</w>", "") for t in coder.automaton.labels]
    for n in range(4000):
        if n % 3:
            text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 25)))
        else:
            text = "".join(draw.choice(labels) for _ in range(4))
        if n % 50 == 0:
            text = f"{text}<|endoftext|>{text}<|startoftext|>"
        want = library.encode(text, add_special_tokens=False).ids
        got = coder.encode(text)
        assert ids_of(got) == want, text
        assert coder.decode(got) == library.decode(want, skip_special_tokens=False)


def test_the_automaton_of_a_few_merges():
    symbols = ["a", "b", "c"]
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "c</w>"), ("ab", "c</w>"), ("aa", "ab")]
    tokens = symbols + [s + "</w>" for s in symbols] + [a + b for a, b in merges]
    automaton = bpe.Automaton({t: i for i, t in enumerate(tokens)}, merges, "</w>")

    def merged(word):
        parts = [*word[:-1], word[-1] + "</w>"]
        for left, right in merges:
            i = 0
            while i + 1 < len(parts):
                if (parts[i], parts[i + 1]) == (left, right):
                    parts[i : i + 2] = [left + right]
                i += 1
        return parts

    draw = random.Random(1)
    for _ in range(3000):
        word = "".join(draw.choice("aaabc") for _ in range(draw.randint(1, 12)))
        assert [tokens[i] for i in automaton.encode(word.encode())] == merged(word), word


def test_memory_bound_does_not_change_ids(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "ENTRIES", 20)
    coder = bpe.WordEncoder(vocabulary_path(bpe.VOCABULARY))
    text = " ".join(f"word{n} therouou{n}" for n in range(50))
    for _ in range(2):
        assert ids_of(coder.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_awkward_documents(docs, no_docs, library):
    for row in bpe.encoded(docs).collect():
        texts = [t for i, t in pairs(docs) if i == row["doc_id"]]
        encodings = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids_of(row["ids"]) in encodings
        assert row["decoded"] in [library.decode(e, skip_special_tokens=False) for e in encodings]
    assert bpe.digests(docs).count() == docs.count()
    assert bpe.digests(no_docs).count() == 0
