import hashlib
import importlib.util
import re
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from hearthline.llm import bpe, decontamination, language_id, registry
from hearthline.llm.common import vocabulary_path

from .test_decontamination import brute_score
from .test_secret_scan import brute_base
from .test_simhash import brute_classes, brute_print

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns, by name, over the smallest documents."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = found[name] = stage(spark, docs, SF_DIR).checkpoint()
    return found


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stage_order_and_columns(stages):
    assert list(stages)[1:] == [
        "language_id", "near_duplicates", "decontamination", "secret_scan", "bpe"
    ]
    for name in list(stages)[1:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_each_stage_against_brute_force(spark, stages):
    before = rows_of(stages["documents"])
    model = language_id.fit(stages["documents"])
    rejected = {i for i, r in before.items() if model.predict([r["text"]])[0][2]}
    known = rows_of(stages["language_id"])
    assert known.keys() == before.keys() - rejected

    ids = sorted(known)
    first = brute_classes([brute_print(known[i]["text"] or "") for i in ids])
    kept = rows_of(stages["near_duplicates"])
    assert kept.keys() == {ids[f] for f in first} and len(kept) < len(known)
    assert all(kept[i] == known[i] for i in kept)

    items = [
        decontamination.words_of(r["text"])
        for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    ]
    leaked = set()
    for i, r in kept.items():
        words = decontamination.words_of(r["text"] or "")
        for item in items:
            if len(set(item) & set(words)) * 2 < len(set(item)):
                continue
            if brute_score(item, words) >= decontamination.THRESHOLD * 2 * len(item):
                leaked.add(i)
    clean = rows_of(stages["decontamination"])
    assert leaked and clean.keys() == kept.keys() - leaked

    masked = rows_of(stages["secret_scan"])
    assert masked.keys() == clean.keys()
    changed = 0
    for i, r in masked.items():
        text = clean[i]["text"]
        merged = []
        for start, _, end in brute_base(text):
            if merged and start < merged[-1][1]:
                merged[-1][1] = max(end, merged[-1][1])
            else:
                merged.append([start, end])
        for start, end in reversed(merged):
            text = text[:start] + "[SECRET]" + text[end:]
        changed += bool(merged)
        assert r["text"] == text and r["n_chars"] == (len(text) if merged else clean[i]["n_chars"])
    assert changed

    library = Tokenizer.from_file(vocabulary_path(bpe.VOCABULARY))
    last = rows_of(stages["bpe"])
    assert last.keys() == masked.keys()
    for i, r in last.items():
        found = library.encode(masked[i]["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(found, skip_special_tokens=False)
        assert r["n_tokens"] == len(found)
        assert r["ids_sha256"] == hashlib.sha256(
            b"".join(t.to_bytes(4, "little") for t in found)
        ).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    got = registry.queries()["pipeline"](spark, SF_DIR)
    assert sorted(got.collect()) == sorted(stages["bpe"].collect())


def test_awkward_rows_pass_every_stage(spark, docs, no_docs):
    for start in (docs, no_docs):
        some = start
        for name, stage in corpus_pipeline.STAGES:
            some = stage(spark, some, SF_DIR).checkpoint()
            if name != "bpe":
                assert some.columns == start.columns
        assert some.count() <= start.count()


def test_every_operator_is_registered_once():
    names = registry.queries()
    numbers = defaultdict(int)
    for name in names:
        found = re.match(r"op(\d+)_", name)
        numbers[int(found[1]) if found else name] += 1
    assert numbers == {**{n: 1 for n in range(1, 14)}, "pipeline": 1}


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(importlib.util.find_spec("hearthline").origin).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "hearthline.llm" not in path.read_text(), path
