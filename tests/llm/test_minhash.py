import hashlib

import numpy as np
import pytest

from odd_rows import ODD
from panelkit.llm import minhash


def shingles(t, k=5):
    w = (t or "").encode().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_texts_and_likeness(make_docs):
    rows = [(i * 7 % 1000, " ".join(f"w{(i * j) % 97}" for j in range(3 + i % 60)) + "é" * (i % 3)) for i in range(900)]
    rows += [r for r in ODD if r[0] is not None and r[1] != "same row"]
    got = sorted(minhash.fingerprints(make_docs(rows)).collect(), key=lambda r: r["doc_id"])
    want = sorted((i, t or "") for i, t in rows)
    assert len(got) == len(want)
    error = []
    for n, (r, (i, t)) in enumerate(zip(got, want)):
        following = want[(n + 1) % len(want)][1]
        changed = minhash.edited(t, following)
        assert (r["doc_id"], r["n_chars"]) == (i, len(t))
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        error.append(abs(r["near_edited"] - jaccard(t, changed)))
        error.append(abs(r["near_next"] - jaccard(t, following)))
    assert np.mean(error) < 0.03 and max(error) < 0.25


def test_edited_takes_all_of_a_short_follower():
    assert minhash.edited("abcdefgh", "x") == "abcdefx"
    assert minhash.edited("abc", "xyz") == "abc"
    assert minhash.edited("", "xyz") == ""


def test_equal_texts_repeated_and_null_ids(make_docs):
    rows = ODD + [(1, "a b c d e f g"), (2, "a  b\tc d e f g"), (3, "a b c d e f g")]
    got = minhash.fingerprints(make_docs(rows)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] == by[3]["fingerprint"]
    assert by[10100]["fingerprint"] == by[10102]["fingerprint"] == "0" * (minhash.PERMUTATIONS * 4)
    assert [r["fingerprint"] for r in got if r["doc_id"] == 10106][0] == [r["fingerprint"] for r in got if r["doc_id"] == 10106][1]


def test_rows_of_one_id_and_of_none_are_dealt_over_ranges(make_docs):
    from pyspark.sql import functions as F

    rows = [(77 if n % 3 else None, f"text {n} of many words and more {n * n}") for n in range(3000)] + [(n, f"other {n}") for n in range(300)]
    docs = make_docs(rows)
    sizes = minhash._ranges(docs.select(F.col("doc_id").alias("id"), "text")).groupBy("part").count().collect()
    assert max(r["count"] for r in sizes) < 1000
    order = [(r["doc_id"], r["text"]) for r in docs.sort(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()]
    want = [(i, hashlib.sha256(minhash.edited(t, order[(n + 1) % len(order)][1]).encode()).hexdigest()) for n, (i, t) in enumerate(order)]
    got = [(r["doc_id"], r["edited_sha256"]) for r in minhash.fingerprints(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_single_row_and_empty_table(make_docs):
    (r,) = minhash.fingerprints(make_docs([(5, "one two three four five six")])).collect()
    assert r["near_next"] == 1.0 and r["n_chars"] == 27
    assert minhash.fingerprints(make_docs([])).count() == 0


def test_signature_does_not_depend_on_the_batch():
    texts = [" ".join(f"t{(i * j) % 31}" for j in range(i)).encode() for i in range(60)] + [b"long " * 30_000]
    whole = minhash.signatures(texts)
    assert all(np.array_equal(minhash.signatures([t])[0], s) for t, s in zip(texts, whole))


def near_rows():
    import random

    rng = random.Random(8)
    base = [[f"w{rng.randrange(500)}" for _ in range(80)] for _ in range(12)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    for i in range(12, 120):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(80)] = f"edit{rng.randrange(50)}"
        rows.append((i, ("  " if i % 5 == 0 else " ").join(words)))
    return rows


def test_similar_pairs_equal_brute_force(make_docs, monkeypatch):
    rows = near_rows() + [r for r in ODD if r[1] != "same row"]
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(tuple((t or "").encode().split()), i)
    reps = sorted(first.values())
    text = dict(rows)
    want = {(u, v) for n, u in enumerate(reps) for v in reps[n + 1:]
            if shingles(text[u]) and jaccard(text[u], text[v]) >= 0.8}
    assert len(want) > 25
    docs = make_docs(rows)
    got = minhash.similar_pairs(docs).collect()
    assert {(r["u"], r["v"]) for r in got} == want and len(got) == len(want)
    assert all(abs(r["jaccard"] - jaccard(text[r["u"]], text[r["v"]])) < 1e-12 for r in got)
    monkeypatch.setattr(minhash, "BUCKET", 4)  # every bucket of more than four in pairs of blocks
    assert {(r["u"], r["v"]) for r in minhash.similar_pairs(docs).collect()} == want
    member = {r["id"]: r["class_id"] for r in minhash.classes(minhash.signature_table(docs)).collect()}
    assert set(member.values()) == set(reps) and all(shingles(text[i]) == shingles(text[c]) for i, c in member.items())


def test_similar_pairs_of_all_texts_of_a_repeated_id(make_docs):
    base = [" ".join(f"{n}w{i}" for i in range(100)) for n in range(6)]
    docs = make_docs([(n, b) for n, b in enumerate(base)] + [(50, b + " more") for b in base] + [(50, base[0] + " yet more")])
    got = minhash.similar_pairs(docs).collect()
    assert sorted((r["u"], r["v"]) for r in got) == [(n, 50) for n in range(6)]
    assert all(abs(r["jaccard"] - 96 / 97) < 1e-12 for r in got)


@pytest.mark.parametrize("bucket", [512, 8])  # 8: components and buckets in pairs of blocks
def test_near_links_equal_brute_force(make_docs, monkeypatch, bucket):
    monkeypatch.setattr(minhash, "BUCKET", bucket)
    rows = near_rows() + [(i + 1000, t) for i, t in near_rows()[::7]] + [r for r in ODD if r[1] != "same row"]
    first, text = {}, dict(rows)
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(tuple((t or "").encode().split()), i)
    near = {c: {} for c in first.values()}
    for u in near:
        for v in near:
            if u != v and shingles(text[u]) and jaccard(text[u], text[v]) >= 0.8:
                near[u][v] = jaccard(text[u], text[v])
    want = []
    for i, t in rows:
        c = None if i is None else first[tuple((t or "").encode().split())]
        best = min(((-j, o) for o, j in near.get(c, {}).items()), default=None)
        want.append((i, c, len(near.get(c, {})), best and best[1], best and round(-best[0], 12)))
    got = [(*r[:4], r[4] and round(r[4], 12)) for r in minhash.near_links(make_docs(rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and sum(w[2] > 0 for w in want) > 50


def test_forest_connects_what_the_pairs_connect():
    rng = np.random.default_rng(5)
    for n in (1, 5, 40):
        pairs = rng.integers(0, n, (60, 2))

        def groups(edges):
            label = list(range(n))
            for i, j in edges:
                label = [label[i] if x == label[j] else x for x in label]
            return {frozenset(k for k in range(n) if label[k] == x) for x in label}

        kept = minhash._forest(pairs)
        assert groups(kept) == groups(pairs) and len(kept) == n - len(groups(pairs))


def test_near_links_of_texts_of_a_repeated_id(make_docs):
    base = " ".join(f"w{i}" for i in range(100))
    got = minhash.near_links(make_docs([(7, base), (7, base + " more"), (8, base)])).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"], r["near_id"]) for r in got) == [(7, 7, 1, 7), (7, 7, 1, 7), (8, 7, 1, 7)]


def test_near_links_of_nothing(make_docs):
    assert minhash.near_links(make_docs([])).count() == 0


def test_blocks_cut_by_batches_give_the_same_pairs():
    import pandas as pd

    rng = np.random.default_rng(3)
    base = rng.integers(0, 9, minhash.PERMUTATIONS, dtype=np.uint16)
    rows = []
    for h in range(40):
        for i in range(1 + h % 5):
            signature = base.copy()
            signature[rng.integers(4, 128, 20)] = 99
            rows.append((0, h, 10 * h + i, 0, 0, 0, signature.astype(">u2").tobytes()))
    whole = pd.DataFrame(rows, columns=["band", "h", "id", "own", "a", "b", "signature"])

    def found(size):
        parts = [whole.iloc[i:i + size] for i in range(0, len(whole), size)]
        return sorted(tuple(map(int, p)) for f in minhash._compare(iter(parts), 0.5) for p in f.to_numpy())

    want = sum(n * (n - 1) // 2 for n in (1 + h % 5 for h in range(40)))
    assert len(found(1000)) == want and found(1) == found(3) == found(1000)


def test_similar_pairs_of_nothing(make_docs):
    assert minhash.similar_pairs(make_docs([])).count() == 0
    assert minhash.similar_pairs(make_docs(ODD[:2])).count() == 0


def test_links_are_registered_and_read_the_whole_table(spark):
    import __spark_entry__ as entry
    from paths import SMALL

    got = entry.queries()["minhash_links"](spark, SMALL)
    assert got.columns == ["doc_id", "class_id", "n_links", "near_id", "near_jaccard"]
    assert got.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
