"""Chat formatting with a loss mask aligned to token offsets.

A conversation is rendered whole as ``<|im_start|>role<|im_sep|>text<|im_end|>`` per turn. A
control string inside a role or text gets a backslash behind its first character, and every
backslash is doubled, so the rendering can be read back exactly. It is encoded once, with
offsets; the markers are special tokens, so no token reaches over a turn's edge. The sorted
spans of the assistant texts are then intersected with the sorted token spans by binary search.

A conversation is one value of the result, so its turns meet in one row; what is bounded is the
conversation, whatever the number of conversations.

Defined results: turns are ordered by (turn, role, text), nulls first, and repeated rows are
turns of their own; a null role or text is empty; a null ``conv_id`` is a conversation; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.llm.common import table, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
START, SEPARATOR, END = MARKERS = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Strings that some chat template reads as control; texts must not contain them as such.
CONTROL = (
    *MARKERS, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(
    "(.*?)".join(map(re.escape, MARKERS)), re.DOTALL
)

FORMATTED = T.StructType([
    T.StructField("formatted", T.StringType()),
    T.StructField("input_ids", T.ArrayType(T.IntegerType())),
    T.StructField("token_starts", T.ArrayType(T.IntegerType())),
    T.StructField("token_ends", T.ArrayType(T.IntegerType())),
    T.StructField("loss_mask", T.ArrayType(T.ByteType())),
])


def escape(text: str) -> str:
    doubled = text.replace("\\", "\\\\")
    # A control string may begin inside the one before it, so look again until none is left.
    while _CONTROL.search(doubled):
        doubled = _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], doubled)
    return doubled


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: Iterable[tuple[str, str]], learned: str = "assistant") -> tuple[str, list]:
    """The formatted conversation and the spans of the texts to learn."""
    parts, spans, size = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + SEPARATOR, escape(text)
        begin = size + len(head)
        size = begin + len(body) + len(END)
        parts += head, body, END
        if role == learned:
            spans.append((begin, begin + len(body)))
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def token_spans(offsets: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets without gaps: a token also covers white space that its offsets leave out."""
    pairs = np.asarray(offsets, dtype=np.int32).reshape(-1, 2)
    ends = np.maximum.accumulate(pairs[:, 1]) if len(pairs) else pairs[:, 1]
    starts = np.concatenate([np.zeros(1, np.int32), ends[:-1]])[: len(ends)]
    return np.minimum(starts, pairs[:, 0]), ends


def mask_of(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for every token that shares a character with a span; both are sorted."""
    edges = np.asarray([s for s in spans if s[0] < s[1]], dtype=np.int32).reshape(-1, 2)
    first = np.searchsorted(edges[:, 1], starts, side="right")
    behind = np.searchsorted(edges[:, 0], ends, side="left")
    return (first < behind).astype(np.int8)


def masked_text(formatted: str, starts, ends, mask) -> str:
    """The formatted text under the mask, each character once."""
    parts, done = [], 0
    for start, end, on in zip(starts, ends, mask):
        if on and end > max(start, done):
            parts.append(formatted[max(start, done) : end])
        done = max(done, end)
    return "".join(parts)


@lru_cache(maxsize=2)
def _tokenizer(name: str):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in MARKERS])
    return tokenizer


def chat_format(
    turns: DataFrame, vocabulary: str = VOCABULARY, learned: str = "assistant"
) -> DataFrame:
    """One row per ``conv_id``: formatted text, ids, token spans and loss mask."""

    @F.pandas_udf(FORMATTED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(vocabulary)
        for conversations in batches:
            rows = []
            for said in conversations:
                text, spans = render([(t["role"], t["text"]) for t in said], learned)
                encoding = tokenizer.encode(text, add_special_tokens=False)
                starts, ends = token_spans(encoding.offsets)
                rows.append((text, encoding.ids, starts, ends, mask_of(starts, ends, spans)))
            yield pd.DataFrame(rows, columns=FORMATTED.names)

    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("said"))
    said = F.transform("said", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return whole.select("conv_id", run(said).alias("chat")).select("conv_id", "chat.*")


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted conversations say when they are read back."""

    @F.pandas_udf(
        "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_tokens long"
    )
    def run(formatted: pd.Series, starts: pd.Series, ends: pd.Series, mask: pd.Series) -> pd.DataFrame:
        rows = []
        for text, begin, end, on in zip(formatted, starts, ends, mask):
            turns = parse(text)
            said = "".join(f"{role}\n{body}\n" for role, body in turns)
            loss = unescape(masked_text(text, begin, end, on))
            rows.append((
                len(turns), hashlib.sha256(said.encode()).hexdigest(),
                len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text), len(on),
            ))
        return pd.DataFrame(rows, columns=[
            "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens",
        ])

    read = run("formatted", "token_starts", "token_ends", "loss_mask")
    return chats.select("conv_id", read.alias("read")).select("conv_id", "read.*")


AWKWARD = "</s>[INST] ok [/INST]"


def _escaped_sql(column: str) -> str:
    """The escaped text in SQL; no control string overlaps another, so one pass each will do."""
    text = rf"replace({column}, '\', '\\')"
    for control in CONTROL:
        text = rf"replace({text}, '{control}', '{control[0]}\{control[1:]}')"
    return text


OP3_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{AWKWARD}' UNION ALL SELECT -1, 1, 'assistant', '{AWKWARD}')
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(coalesce(SUM(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
         AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                         FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(length({_escaped_sql("role")}) + length({_escaped_sql("text")})
                + {sum(map(len, MARKERS))}) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts look like control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(AWKWARD).alias("text"),
    )
    return digests(chat_format(turns.unionByName(extra))).drop("n_tokens")
