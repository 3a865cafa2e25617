import hashlib
from collections import Counter

import xxhash

from hearthline.llm import fingerprints as fp

from .conftest import pairs


def brute_lexicon(texts, low, high):
    counts = Counter(w for t in texts for w in fp.terms_of(t))
    return {w for w, n in counts.items() if low * len(texts) <= n <= max(1.0, high * len(texts))}


def ordered(frame):
    """By id, then by the signed hash of the text."""

    def place(row):
        digest = xxhash.xxh64_intdigest(row[1].encode(), 42)
        return row[0] is not None, row[0] or 0, digest - (digest >> 63 << 64)

    return sorted(pairs(frame), key=place)


def check_neighbours(frame, terms, stretch):
    rows = ordered(frame)
    want = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (fp.parts_of(t, terms) for t in (text, edited, following))
        want.append((
            i, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b),
            fp.likeness(a, b), fp.likeness(a, c),
        ))
    got = list(map(tuple, fp.beside_edited(frame, terms, stretch=stretch).collect()))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_lexicon_counts_all_documents(docs, small):
    for frame in (docs, small):
        texts = [t for _, t in pairs(frame)]
        assert fp.lexicon(frame, 0.02, 0.3) == brute_lexicon(texts, 0.02, 0.3)


def test_neighbours_against_brute_force(docs, small):
    terms = fp.lexicon(small)
    for stretch in (1, 7, 1000):
        check_neighbours(small, terms, stretch)
    check_neighbours(docs, frozenset(["dog", "text", "ha"]), 2)
    check_neighbours(docs.limit(1), frozenset(), 5)


def test_empty_table_and_words_outside_the_lexicon(no_docs):
    assert fp.lexicon(no_docs) == frozenset()
    assert fp.beside_edited(no_docs, frozenset()).count() == 0
    a, b = fp.parts_of("b a", frozenset()), fp.parts_of("A  b b", frozenset())
    assert a == b != fp.parts_of("a c", frozenset())


def test_likeness_grades_edits(small):
    terms = fp.lexicon(small)
    for _, text in sorted(pairs(small), key=lambda p: -len(p[1]))[:20]:
        words = text.split()
        parts = fp.parts_of(text, terms)
        light = fp.parts_of(" ".join(words[:-3]), terms)
        heavy = fp.parts_of(" ".join(words[: len(words) // 4]), terms)
        assert fp.likeness(parts, parts) == 1.0
        assert fp.likeness(parts, light) > fp.likeness(parts, heavy)


def test_short_texts_of_other_terms_differ():
    terms = frozenset(f"w{n}" for n in range(400))
    sparse = (1 << 12, 1 << 12)
    for subsets in (fp.SUBSETS, sparse):
        parts = [fp.parts_of(f"w{n}", terms, subsets) for n in range(400)]
        assert len(set(map(tuple, parts))) == 400
        assert max(fp.likeness(parts[0], other) for other in parts[1:]) == 0.0
    ten = fp.parts_of(" ".join(sorted(terms)[:10]), terms)
    assert sum(p != fp._NONE for p in ten[:7]) >= 5


def test_parts_and_likeness_against_their_definition(small):
    """Parts by sets and hashes written out here, not by the operator's own functions."""
    texts = [t for _, t in pairs(small)][:60] + ["", "one two", "Ä ß x", "same words same"]
    lexicon = frozenset(brute_lexicon(texts, 0.02, 0.4))
    rates = [1, 2, 2, 4, 4, 8, 8] + [2**k for k in range(4, 12) for _ in range(4)]
    assert list(fp.SUBSETS) == rates
    want = []
    for text in texts:
        terms = set()
        for word in "".join(c if c.isalnum() or c == "_" else " " for c in text.lower()).split():
            terms.add(word)
        groups = [
            sorted(t for t in terms & lexicon if xxhash.xxh64(t.encode(), seed=i).intdigest() % r == 0)
            for i, r in enumerate(rates)
        ]
        if not any(groups):
            groups = [sorted(terms)] * len(rates)
            want.append([hashlib.blake2b("\n".join(g).encode(), digest_size=8).hexdigest() for g in groups])
        else:
            want.append([
                hashlib.blake2b("\n".join(g).encode(), digest_size=8).hexdigest() if g else "0" * 16
                for g in groups
            ])
    plain = [k for k, t in enumerate(texts) if all(c.isascii() or c.isalpha() for c in t)]
    for k in plain:
        assert fp.parts_of(texts[k], lexicon) == want[k]
    for a in plain[:25]:
        for b in plain[:25]:
            both = [x == y for x, y in zip(want[a], want[b]) if (x, y) != ("0" * 16, "0" * 16)]
            share = 1.0 if want[a] == want[b] else both.count(True) / len(both)
            assert fp.likeness(want[a], want[b]) == share


def test_rows_of_one_id_spread_over_stretches(spark):
    rows = [(None, f"null {k}") for k in range(40)] + [(7, f"seven {k % 30}") for k in range(60)]
    rows += [(k, f"own {k}") for k in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    terms = frozenset(["null", "seven", "own"])
    for stretch in (5, 13, 1000):
        check_neighbours(frame, terms, stretch)
    spread = fp.in_stretches(frame, 10).where("not closing")
    held = {tuple(r) for r in spread.select("doc_id", "stretch").distinct().collect()}
    assert len([s for i, s in held if i == 7]) > 2 and len([s for i, s in held if i is None]) > 2
