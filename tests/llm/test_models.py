import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from odd_rows import ODD
from panelkit.llm import language_id, quality
from panelkit.llm.common import table

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_gram_buckets_by_brute_force():
    texts = ["Abc", "", "é", "ab\0cd " * 5]
    buckets, count = language_id.gram_buckets(texts)
    assert list(count) == [sum(max(len(t) - k + 1, 0) for k in language_id.ORDERS) for t in texts]
    first = np.cumsum(count) - count
    for t, a, n in zip(texts, first, count):
        alone, m = language_id.gram_buckets([t])
        assert list(m) == [n] and np.array_equal(buckets[a:a + n], alone)


def test_languages_of_held_out_documents(spark):
    docs = table(spark, MEDIUM, "documents")
    got = language_id.identify(docs).collect()
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == len(lang)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_cases(spark, make_docs):
    docs = table(spark, SMALL, "documents").select("doc_id", "text", "lang")
    odd = make_docs(ODD).select("doc_id", "text", F.lit(None).cast("string").alias("lang"))
    got = {}
    for r in language_id.identify(docs.union(odd).union(odd)).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    for i in (10100, 10101, 10102, 10103):
        assert got[i] == [("und", 0.0)] * 2
    assert len(got[10106]) == 4 and len(set(got[10106])) == 1 and got[10104][0][0] != "und"
    assert language_id.identify(docs.limit(0)).count() == 0
    kept = language_id.keep_known(docs.union(odd))
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns and not ids & {10100, 10101, 10102, 10103} and {10104, 10106, None} <= ids


def test_keep_known_without_labels(make_docs):
    docs = make_docs([(i, t, None) for i, t in ODD] + [(1, "漢"), (2, "a 1")]).withColumn("lang", F.lit(None).cast("string"))
    kept = language_id.keep_known(docs)
    assert kept.columns == docs.columns
    want = [i for i, t in ODD if t is not None and any(c.isalpha() for c in t)] + [1, 2]
    assert sorted([r["doc_id"] for r in kept.collect()], key=str) == sorted(want, key=str)


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = table(spark, SMALL, "documents")
    spoiled = docs.withColumn("lang", F.when(language_id.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert language_id.identify(docs).collect() == language_id.identify(spoiled).collect()
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(none).collect()} == {"und"}


def test_temperature_cools_and_heats():
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 3, 3000)
    logits = rng.normal(0, 1, (3000, 3))
    logits[np.arange(3000), labels] += 1.0
    fitted = language_id.temperature(logits, labels)
    assert abs(language_id.temperature(4 * logits, labels) / fitted - 4) < 0.1


def test_machine_equals_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    size = quality.BUCKETS + len(quality.STATISTICS)
    m = quality.Machine(0.3, rng.normal(0, 1, size), rng.normal(0, 0.3, (size, quality.FACTORS)),
                        np.zeros(len(quality.STATISTICS)), np.ones(len(quality.STATISTICS)))
    texts = [b"one two three two", b"", b"a B c! 5\n" * 4]
    index, value, first = m.rows(*quality.features(texts))
    raw, _ = m.score(index, value, first)
    for t, (lo, hi) in enumerate(zip(first, np.append(first[1:], len(index)))):
        i, x = index[lo:hi], value[lo:hi]
        want = m.bias + (m.w[i] * x).sum()
        for a in range(len(i)):
            for b in range(a):
                want += (m.v[i[a]] @ m.v[i[b]]) * x[a] * x[b]
        assert abs(want - raw[t]) < 1e-9


def test_quality_of_held_out_documents(spark):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    got = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    marked = [(got[r["doc_id"]], r["quality"]) for r in labels.collect()]
    held = [(r["predicted"], q) for r, q in marked if r["held_out"]]
    assert sum(p == q for p, q in held) / len(held) > 0.92
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in got.items())
    spoiled = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.classify(docs, spoiled).collect()}
    assert again == {i: r["score"] for i, r in got.items()}


def test_quality_cases(make_docs, spark):
    rng = random.Random(1)
    good = [(i, " ".join(rng.choice(["sun", "sea", "sky"]) for _ in range(20))) for i in range(60)]
    bad = [(60 + i, " ".join(rng.choice(["###", "$$$", "WIN!!"]) for _ in range(20))) for i in range(60)]
    docs = make_docs(good + bad + ODD)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)] + [(None, 1, 0), (3, None, 1)],
                                   "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == 120 + len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["doc_id"] < 60) for r in got if r["doc_id"] is not None and r["doc_id"] < 120)
    assert len({r["score"] for r in got if r["doc_id"] in (10100, 10101)}) == 1
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_a_repeated_id_cannot_fill_the_sample(spark, make_docs, monkeypatch):
    from panelkit.llm import quality

    monkeypatch.setattr(quality, "PER_LABEL", 10)
    seen = []
    train = quality.train
    monkeypatch.setattr(quality, "train", lambda examples, weights: seen.append(len(examples)) or train(examples, weights))
    docs = make_docs([(1, f"one {i}") for i in range(500)] + [(2, f"two {i}") for i in range(3)])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    from pyspark.sql import functions as F

    quality.fit(docs, labels, F.lit(True))
    assert seen == [2]


def test_many_labels_are_bounded(spark, make_docs, monkeypatch):
    from pyspark.sql import functions as F

    from panelkit.llm import language_id

    monkeypatch.setattr(language_id, "LANGUAGES", 5)
    rows = [(i, f"word{i % 20} text{i % 20} of{i % 20}", f"l{i % 20:02d}" if i % 20 < 6 or i < 40 else "l00") for i in range(400)]
    model = language_id.fit(make_docs(rows), F.lit(True))
    assert len(model.languages) == 5 and "l00" in model.languages
