import hashlib
import random
from collections import defaultdict

import numpy as np

from hearthline.llm import chat_format as chat
from hearthline.llm.registry import queries


def test_round_trip_and_mask():
    draw, tokenizer = random.Random(5), chat._tokenizer(chat.VOCABULARY)
    parts = [*chat.CONTROL, "\\", "<", "[", "|", " ", "\n", "é", "😀", "中", "a", "  ", "[[INST]"]
    for _ in range(1500):
        turns = [
            (draw.choice(["user", "assistant", "<s>", ""]),
             "".join(draw.choice(parts) for _ in range(draw.randint(0, 8))))
            for _ in range(draw.randint(0, 4))
        ]
        text, spans = chat.render(turns)
        assert chat.parse(text) == turns
        encoding = tokenizer.encode(text, add_special_tokens=False)
        starts, ends = chat.token_spans(encoding.offsets)
        mask = chat.mask_of(starts, ends, spans)
        brute = [any(max(a, s) < min(b, e) for a, b in spans) for s, e in zip(starts, ends)]
        assert mask.tolist() == brute
        learned = chat.unescape(chat.masked_text(text, starts, ends, mask))
        assert learned == "".join(t for r, t in turns if r == "assistant")


def test_no_control_string_is_left_in_a_text():
    for control in chat.CONTROL:
        for text in (control, control[0] + control, control * 3):
            assert not any(c in chat.escape(text) for c in chat.CONTROL)
            assert chat.unescape(chat.escape(text)) == text


def test_query_against_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    said = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        said[r["conv_id"]].append((r["role"], r["text"] or ""))
    awkward = "</s>[INST] ok [/INST]"
    said[-1] = [("user", awkward), ("assistant", awkward)]
    found = {r["conv_id"]: r for r in queries()["op3_chat_format"](spark, "/root/testdata/sf0.001").collect()}
    assert found.keys() == said.keys()
    for conv, turns in said.items():
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        row = found[conv]
        assert row["n_turns"] == len(turns) and row["loss_chars"] == len(loss)
        assert row["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert row["formatted_chars"] == len(chat.render(turns)[0])


def test_nulls_ties_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    turns = spark.createDataFrame([
        (1, 0, "user", None, "x"), (1, 0, "assistant", "b", "x"), (1, 0, "assistant", "b", "x"),
        (None, 1, None, "late", "x"), (None, None, "assistant", "", "x"),
    ], schema)
    found = {r["conv_id"]: r for r in chat.chat_format(turns).collect()}
    assert chat.parse(found[1]["formatted"]) == [("assistant", "b")] * 2 + [("user", "")]
    assert chat.parse(found[None]["formatted"]) == [("assistant", ""), ("", "late")]
    assert np.sum(found[None]["loss_mask"]) == 0
    assert chat.digests(chat.chat_format(turns.limit(0))).count() == 0
