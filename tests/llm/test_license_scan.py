import random

from hearthline.llm import license_scan as scan

from .conftest import pairs


def brute_matches(words, templates, threshold, sizes):
    """Every block over the threshold, without any filter."""
    found = set()
    for label, text in templates:
        wanted = scan.words_of(text)
        size = min((s for s in sizes if s >= len(wanted)), default=len(wanted))
        for begin in range(0, max(1, len(words)), size):
            common = len(set(wanted) & set(words[begin : begin + 2 * size]))
            if common / len(set(wanted)) >= threshold - 1e-12:
                found.add((label, common / len(set(wanted)), begin))
    return found


def test_filters_lose_nothing():
    draw = random.Random(2)
    vocabulary = sorted({w for _, t in scan.TEMPLATES for w in scan.words_of(t)})
    for threshold in (0.5, 0.8, 0.9, 1.0):
        counts = {w: draw.randint(0, 20) for w in vocabulary}
        index = scan.TemplateIndex(scan.TEMPLATES, counts, threshold, (4, 16, 32))
        for _ in range(40):
            words = [draw.choice([*vocabulary, "x", "y"]) for _ in range(draw.randint(0, 60))]
            label, text = draw.choice(scan.TEMPLATES)
            at = draw.randint(0, len(words))
            words[at:at] = [w for w in scan.words_of(text) if draw.random() < 0.9]
            got = list(index.matches(words))
            assert len(got) == len({(g[0], g[1], g[2]) for g in got}) or len(got) >= 1
            assert set(got) == brute_matches(words, scan.TEMPLATES, threshold, (4, 16, 32))


def test_documents_against_brute_force(docs, small):
    for frame in (docs, small):
        rows = [tuple(r)[:8] for r in scan.license_scan(frame).collect()]
        want = []
        for i, text in pairs(frame):
            words = scan.words_of(text)
            places = [
                (k, label) for phrase, label in scan.PHRASES for k in range(len(words))
                if words[k : k + len(phrase.split())] == phrase.split()
            ]
            blocks = brute_matches(words, scan.TEMPLATES, scan.THRESHOLD, scan.BLOCK_SIZES)
            base, starts = {p[1] for p in places}, [p[0] for p in places]
            want.append((
                i, len(words), len(places), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | {b[0] for b in blocks})),
                1.0 if places else max((b[1] for b in blocks), default=0.0),
            ))
        assert sorted(rows, key=str) == sorted(want, key=str)


def test_notices_across_lines_and_empty_tables(spark, no_docs):
    notice = scan.TEMPLATES[1][1]
    text = "word " * 37 + notice.replace(" ", "\n  * ") + " word" * 200
    rows = scan.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert rows[0]["labels"] == "mit" and rows[0]["score"] == 1.0
    assert scan.license_scan(no_docs).count() == 0


def test_only_ascii_letters_are_lowered():
    assert scan.words_of("CC-BY ÀB 0x_É") == ["cc", "by", "Àb", "0x", "É"]
