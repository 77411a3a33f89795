import hashlib
import random

import numpy as np

from panelkit.llm import recompression as rc
from panelkit.llm.textnum import Words

from odd_rows import ODD


def brute(rows):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        if i is not None:
            for p in range(len(w) - 49):
                k = tuple(w[p:p + 50])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in split:
        gone = set()
        if i is not None:
            for p in range(len(w) - 49):
                if first[tuple(w[p:p + 50])] < i:
                    gone.update(range(p, p + 50))
        kept = [x for n, x in enumerate(w) if n not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def rows_with_repeats(seed, words=30, n=60):
    """Short alphabets make runs and chance repeats; passages of 45 to 120 words are planted."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(words)]
    passages = [[rng.choice(vocab) for _ in range(rng.randrange(45, 120))] for _ in range(6)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(0, 5)):
            text += [rng.choice(vocab) for _ in range(rng.randrange(0, 40))]
            if rng.random() < 0.6:
                p = rng.choice(passages)
                lo = rng.randrange(0, 20)
                text += p[lo:len(p) - rng.randrange(0, 20)]
            if rng.random() < 0.2:
                text += [rng.choice(vocab)] * rng.randrange(1, 130)
        rows.append((i * 3, " ".join(text)))
    rows.append((1, rows[5][1].replace(" ", "\t")))
    rows.append((999, rows[7][1]))
    return rows


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


def test_equals_brute_force(make_docs):
    for seed, words in ((1, 3), (2, 30), (3, 2000)):
        rows = rows_with_repeats(seed, words) + ODD
        got = [tuple(r) for r in rc.dedup_digests(make_docs(rows)).collect()]
        assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_repeated_ids_with_unlike_texts(make_docs):
    rows = rows_with_repeats(4, 30)
    rows = [(i // 6, t) for i, t in rows]
    got = [tuple(r) for r in rc.dedup_digests(make_docs(rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_remove_repeats_keeps_rows_and_columns(make_docs):
    rows = rows_with_repeats(2) + ODD
    docs = make_docs(rows)
    got = rc.remove_repeats(docs)
    assert got.columns == docs.columns and got.count() == len(rows)
    want = {i: (n, gone, sha) for i, n, gone, sha in brute(rows)}
    before = dict(rows)
    for r in got.collect():
        n, gone, sha = want[r["doc_id"]]
        if gone:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == sha and r["n_chars"] == len(r["text"])
        else:
            assert r["text"] == before[r["doc_id"]]


def test_empty_table(make_docs):
    assert rc.dedup_digests(make_docs([])).count() == 0
    assert rc.remove_repeats(make_docs([])).count() == 0


def test_equal_windows_share_an_anchor():
    """The margin of the parsing holds: every equal window of two texts has a common anchor inside it."""
    rng = random.Random(9)
    for trial in range(200):
        vocab = [f"v{i}" for i in range(rng.choice([2, 5, 500]))]
        shared = [rng.choice(vocab) for _ in range(rc.WINDOW)]
        texts = []
        for _ in range(2):
            left = [rng.choice(vocab) for _ in range(rng.randrange(80))]
            texts.append(left + shared + [rng.choice(vocab) for _ in range(rng.randrange(80))])
        w = Words([" ".join(t).encode() for t in texts])
        a = rc._anchors(w)
        inside = []
        for d, t in enumerate(texts):
            at = next(i for i in range(len(t)) if t[i:i + rc.WINDOW] == shared) + w.first[d]
            # the groups inside the window, by the place of the anchor relative to it
            own = (a.doc == d) & (a.at >= at) & (a.stop <= at + rc.WINDOW)
            inside.append({(n, p - at) for n, p in zip(a.name[own].tolist(), a.at[own].tolist())})
        assert inside[0] & inside[1], trial


def test_rounds_shrink_the_text():
    w = Words([" ".join(f"w{i % 701}" for i in range(20_000)).encode()])
    s = rc.recompress(w.hashes(11), w.doc)
    assert s.size.sum() == 20_000 and len(s.name) < 10_000 and s.size.max() <= rc.HEAVIEST
    assert np.array_equal(s.first, np.cumsum(s.size) - s.size)
