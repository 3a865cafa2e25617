import numpy as np
from pyspark.sql import functions as F

from hearthline.llm import language_id as lid
from hearthline.llm.registry import queries


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries()["op4_language_id"](spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 200
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.98
    assert found.where("score < 0 OR score > 1").count() == 0
    assert found.where("rejected").count() < 10


def test_nothing_is_learned_from_held_out_or_unlabelled_rows(small):
    changed = small.withColumn(
        "lang", F.when(lid.held_out(), F.lit("zz")).otherwise(F.col("lang"))
    )
    odd = changed.limit(3).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit("xyz xyz").alias("text"),
        F.lit("qq").alias("lang"), "source", "n_chars",
    )
    model = lid.fit(changed.unionByName(odd))
    plain = lid.fit(small)
    assert model.languages == plain.languages
    assert np.array_equal(model.centers, plain.centers) and np.array_equal(model.idf, plain.idf)


def test_texts_without_letters_and_far_texts(small):
    model = lid.fit(small)
    assert model.predict([None, "", "12 +- 3"]) == [("und", 0.0, True)] * 3
    clean = small.orderBy(F.desc("n_chars")).first()["text"]
    far = "".join(chr(0x4E00 + k % 900) for k in range(len(clean)))
    (_, near, kept), (_, low, dropped) = model.predict([clean, far])
    assert near > low and not kept and dropped


def test_awkward_and_empty_tables(docs, no_docs, small):
    model = lid.fit(small)
    found = lid.language_id(docs, model)
    assert found.count() == docs.count()
    assert found.where("doc_id IN (1, 3, 9, 12) AND lang_pred = 'und'").count() == 4
    kept = lid.accepted(docs, model)
    assert kept.columns == docs.columns
    assert kept.where("doc_id = 5").count() == 3 and kept.where("doc_id IN (1, 3, 9)").count() == 0
    empty = lid.fit(no_docs)
    assert [r["lang_pred"] for r in lid.language_id(docs, empty).collect()] == ["und"] * docs.count()
    assert lid.accepted(no_docs, model).count() == 0


def test_clusters_are_unit_centroids():
    points = np.eye(6, dtype=np.float32)[[0, 0, 1, 1, 2, 2]]
    centers = lid.clustered(points, 3)
    assert np.allclose(sorted(centers.argmax(axis=1)), [0, 1, 2])
    assert len(lid.clustered(points[:2], 4)) == 1


def brute_vector(text, idf):
    """The unit vector of a text by the definition, gram by gram."""
    raw = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in text.lower().encode())
    padded = b" " + b" ".join(raw.split()) + b" "
    counts = {}
    for size, tag in ((2, 0), (3, 1 << 24)):
        for i in range(len(padded) - size + 1):
            code = int.from_bytes(padded[i : i + size]) | tag
            place = code * 2654435761 % 2**32 >> 20
            counts[place] = counts.get(place, 0) + 1
    found = {place: np.log(1 + n) * idf[place] for place, n in counts.items()}
    norm = sum(v * v for v in found.values()) ** 0.5
    return {place: v / norm for place, v in found.items()}, sum(counts.values())


def test_vectors_cosines_and_bounds_against_brute_force(small):
    model = lid.fit(small)
    rows = [r for r in small.where(~lid.held_out()).collect() if r["lang"] and r["text"]]
    with_letters = [r for r in rows if any(c.isalpha() for c in r["text"])]
    held = np.zeros(lid.DIMENSIONS)
    for r in with_letters:
        places, _ = brute_vector(r["text"], np.ones(lid.DIMENSIONS))
        held[list(places)] += 1
    idf = np.log((1 + len(with_letters)) / (1 + held)) + 1
    assert np.allclose(model.idf, idf, atol=1e-5)
    classes = {}
    for r in with_letters:
        vector, grams = brute_vector(r["text"], idf)
        cosines = [sum(v * c[p] for p, v in vector.items()) for c in model.centers]
        best = int(np.argmax(cosines))
        name, cosine, _ = model.predict([r["text"]])[0]
        assert abs(cosine - min(1, cosines[best])) < 1e-4
        assert name == model.languages[model.owner[best]]
        classes.setdefault((name, grams.bit_length()), []).append(cosines[best])
    for language, bounds in zip(model.languages, model.least):
        known = {z: sorted(c) for (g, z), c in classes.items()
                 if g == language and len(c) >= lid.WELL_KNOWN}
        assert [z for z, _ in bounds] == sorted(known)
        least = {z: int(c[max(1, int(lid.QUANTILE * len(c)))] * lid.BINS) / lid.BINS
                 for z, c in known.items()}
        for size, bound in bounds:
            want = min(v for z, v in least.items() if z >= size) - lid.MARGIN
            assert abs(bound - want) <= 1.01 / lid.BINS


def test_one_noisy_learning_document_sets_no_bound(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(
        "lang = 'en' and n_chars between 600 and 1000"
    ).select("doc_id", "text", "lang")
    noise = "".join(chr(97 + (k * k * 7 + k // 3) % 26) + " " * (k % 4 == 0) for k in range(700))
    planted = spark.createDataFrame([(10**9, noise, "en")], "doc_id long, text string, lang string")
    assert planted.where(~lid.held_out()).count() == 1
    assert documents.count() > 2 * lid.WELL_KNOWN
    model = lid.fit(documents.unionAll(planted))
    assert model.predict([noise])[0][2]
    clean = [r["text"] for r in documents.collect()]
    assert sum(rejected for _, _, rejected in model.predict(clean)) <= 1
