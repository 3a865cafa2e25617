"""BPE with word ends as a tokenization automaton.

``Automaton`` compiles the merge list by one merge gadget after another. Before the first
merge the automaton reads any sequence of base symbols. The gadget of merge ``(u, v) -> w``

* adds an arc ``w`` wherever the automaton can read ``u`` and then ``v``: its state is entered
  from where ``u`` is entered and left like that of ``v``;
* removes the arc ``v`` behind ``u``; with ``u == v`` it also removes ``w`` behind ``u``, since
  the leftmost pair merges first.

A state is thus the last token read, and whether an arc leaves a state is settled by the gadgets
that made the two tokens and the one that joins them. ``arc`` replays these few gadgets and keeps
the answer in the transition table, so the table only ever holds arcs that texts have asked for.
A gadget whose pair cannot be read when its turn comes adds nothing (``live``).

Encoding is table-driven: over bytes the automaton is made deterministic as far as texts ask for
it. Each prefix of a word has exactly one path, so every transition names the token that ends
there, and the path is read off backwards. Decoding emits the labels of the arcs.

Normalisation and word splitting follow the vocabulary file: plain Latin texts by one pattern,
any other text by the file's own normaliser and splitter.

Defined results: a null text is the empty text, without ids; repeated rows are encoded each; an
empty table gives an empty result. Special strings inside a text become their special id.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import table, vocabulary_path, whole_text

VOCABULARY = "word_bpe_49k.json"
#: Words and table entries that a Python worker keeps before it starts anew: its memory's bound.
REMEMBERED, ENTRIES = 300_000, 500_000


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Automaton:
    """Tokenization automaton of a merge list; words are byte strings."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], word_end: str):
        to_byte = byte_symbols()
        self.labels = [""] * (max(vocabulary.values(), default=-1) + 1)
        inner: dict[bytes, int] = {}
        final: dict[bytes, int] = {}
        for token, i in vocabulary.items():
            self.labels[i] = token
            ends = token.endswith(word_end) and token != word_end
            core = token[: -len(word_end)] if ends else token
            if all(c in to_byte for c in core):
                (final if ends else inner)[bytes(to_byte[c] for c in core)] = i
        #: Label tree: node and next byte to node; a node is a multiple of 256.
        self.step: dict[int, int] = {}
        self.inner_at = self._tree(inner)
        self.final_at = self._tree(final)
        self.inside = {node & ~255 for node in self.step}
        self.lengths = [0] * len(self.labels)
        for label, token in (*inner.items(), *final.items()):
            self.lengths[token] = len(label)
        self._reset()
        size = len(self.labels)
        self.made = array("l", [-1]) * size
        self.left = array("l", [-1]) * size
        self.right = array("l", [-1]) * size
        self.joins: dict[tuple[int, int], int] = {}
        self.live = bytearray(b"\x01") * size
        self.table: dict[int, bool] = {}
        for rank, (a, b) in enumerate(merges):
            self._gadget(rank, vocabulary[a], vocabulary[b], vocabulary[a + b])
        self.table.clear()

    def _tree(self, tokens: dict[bytes, int]) -> dict[int, int]:
        """Adds the labels to the tree; the token that ends at a node, by node."""
        ends = {}
        for label, token in tokens.items():
            node = 0
            for byte in label:
                node = self.step.setdefault(node | byte, (len(self.step) + 1) << 8)
            ends[node] = token
        return ends

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        if self.made[w] >= 0:
            raise ValueError(f"two merges make the token {self.labels[w]!r}")
        readable = self.live[u] and self.live[v] and self._arc(u, v, rank)
        self.made[w], self.left[w], self.right[w] = rank, u, v
        self.live[w] = bool(readable)
        if readable:
            self.joins[u, v] = rank

    def _arc(self, x: int, y: int, before: int) -> bool:
        """Whether ``y`` can follow ``x`` in the automaton of the merges below ``before``."""
        made, left, right, joins = self.made, self.left, self.right, self.joins
        while True:
            if joins.get((x, y), before) < before:
                return False
            if made[y] > made[x]:
                # The gadget of y: entered where its left part was entered.
                before = made[y]
                if x == left[y] == right[y]:
                    return False
                y = left[y]
            elif made[x] > made[y]:
                # The gadget of x: left like its right part.
                before = made[x]
                x = right[x]
            elif made[x] < 0:
                return True
            else:
                # x == y: w behind w needs u behind v.
                before = made[x]
                x, y = right[x], left[x]

    def arc(self, x: int, y: int) -> bool:
        key = x * len(self.labels) + y
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= ENTRIES:
                self.table.clear()
            known = self.table[key] = bool(self.live[y]) and self._arc(x, y, 1 << 60)
        return known

    def _reset(self) -> None:
        """Forgets the transitions over bytes; state 0 is the beginning of a word."""
        self.members: list[tuple[tuple[int, int], ...]] = [((0, -1),)]
        self.numbers = {self.members[0]: 0}
        self.moves: dict[int, int] = {}
        self.stops: dict[int, int] = {}

    def _read(self, state: int, byte: int, ends_here: dict[int, int]) -> tuple[list, int]:
        """The arcs that ``byte`` carries on, and the one token that ends behind it."""
        still, found = [], -1
        for node, last in self.members[state]:
            node = self.step.get(node | byte)
            if node is None:
                continue
            if found < 0:
                token = ends_here.get(node)
                if token is not None and (self.live[token] if last < 0 else self.arc(last, token)):
                    found = token
            if node in self.inside:
                still.append((node, last))
        if found < 0:
            raise ValueError(f"no path behind byte {byte}")
        return still, found

    def _move(self, state: int, byte: int) -> int:
        """Next state and the token that ends behind ``byte``, as one number."""
        still, token = self._read(state, byte, self.inner_at)
        member = (*still, (0, token))
        number = self.numbers.setdefault(member, len(self.members))
        if number == len(self.members):
            self.members.append(member)
        packed = self.moves[state << 8 | byte] = number << 20 | token
        return packed

    def _stop(self, state: int, byte: int) -> int:
        token = self.stops[state << 8 | byte] = self._read(state, byte, self.final_at)[1]
        return token

    def encode(self, word: bytes) -> list[int]:
        """Ids of the one path that reads ``word`` up to its end.

        Over bytes the automaton is made deterministic as texts ask for it: a state is the set
        of arcs being read, each a node of the label tree and the token before it. Every prefix
        has one path, so each move names the token that ends there.
        """
        if len(self.moves) + len(self.stops) > ENTRIES:
            self._reset()
        moves, state, tokens = self.moves, 0, []
        for byte in word[:-1]:
            packed = moves.get(state << 8 | byte)
            if packed is None:
                packed = self._move(state, byte)
            tokens.append(packed & 0xFFFFF)
            state = packed >> 20
        token = self.stops.get(state << 8 | word[-1])
        if token is None:
            token = self._stop(state, word[-1])
        ids, lengths = [token], self.lengths
        end = len(tokens) - lengths[token]
        while end >= 0:
            token = tokens[end]
            ids.append(token)
            end -= lengths[token]
        ids.reverse()
        return ids


class _Words(dict):
    """Packed ids by word; an unknown word is encoded."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> bytes:
        ids = self.automaton.encode(word.encode("utf-8", "surrogateescape"))
        packed = self[word] = array("I", ids).tobytes()
        return packed


class WordEncoder:
    """Whole texts to ids and back, for a vocabulary file whose words end in a suffix."""

    #: Texts of these characters need no library: composed already, simple case pairs.
    PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ſ]*")
    LETTERS = "a-zß-öø-ſ"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.library = Tokenizer.from_file(path)
        self.automaton = Automaton(
            model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"]
        )
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = list(self.automaton.labels)
        for content, i in self.special.items():
            self.labels += [""] * (i + 1 - len(self.labels))
            self.labels[i] = content
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.words = re.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d|[{self.LETTERS}]+|[0-9]|[^\s0-9{self.LETTERS}]+"
        )
        self.known = _Words(self.automaton)
        self.to_byte = byte_symbols()

    def split(self, text: str) -> list[bytes] | list[str]:
        """The words of a text without special strings."""
        if self.PLAIN.fullmatch(text):
            return self.words.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(self.to_byte[c] for c in p).decode("utf-8", "surrogateescape") for p, _ in pieces]

    def _plain(self, text: str) -> bytes:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if "<|" not in text:
            return self._plain(text)
        special = self.special
        return b"".join(
            special[p].to_bytes(4, "little") if p in special else self._plain(p)
            for p in self.cut.split(text)
        )

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, joined as the file asks for: it has no decoder, so by spaces."""
        import numpy as np

        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(name: str) -> WordEncoder:
    return WordEncoder(vocabulary_path(name))


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, decoded) of every row; ids are packed as little-endian 32-bit integers."""

    @F.pandas_udf("ids binary, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = encoder(vocabulary)
        for texts in batches:
            ids = [coder.encode(t) for t in texts]
            yield pd.DataFrame({"ids": ids, "decoded": [coder.decode(i) for i in ids]})

    return docs.select("doc_id", run(whole_text()).alias("coded")).select("doc_id", "coded.*")


def digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256); the ids do not leave the Python worker."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = encoder(vocabulary)
        for texts in batches:
            rows = []
            for text in texts:
                ids = coder.encode(text)
                decoded = coder.decode(ids).encode("utf-8")
                rows.append((
                    len(ids) // 4,
                    hashlib.sha256(ids).hexdigest(),
                    hashlib.sha256(decoded).hexdigest(),
                ))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", run(whole_text()).alias("coded")).select("doc_id", "coded.*")


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return digests(table(spark, sf_dir, "documents"))
