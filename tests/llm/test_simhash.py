import random

import xxhash

from panelkit.llm import simhash
from panelkit.llm.components import components

from odd_rows import ODD


def brute(rows, radius=2):
    prints = []
    for _, t in rows:
        words = (t or "").encode().lower().split()
        shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        bits = [0] * 64
        for s in shingles:
            h = xxhash.xxh64_intdigest(s, 42)
            for b in range(64):
                bits[b] += h >> b & 1
        prints.append(sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles)))
    label = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(len(rows)):
                if rows[b][0] is not None and (prints[a] ^ prints[b]).bit_count() <= radius and label[b] is not None:
                    if label[a] is None or label[b] < label[a]:
                        if rows[a][0] is not None:
                            label[a] = label[b]
                            changed = True
    out = []
    for i, (own, _) in enumerate(rows):
        if own is None:
            same = [label[j] for j in range(len(rows)) if rows[j][0] is not None and prints[j] == prints[i]]
            label[i] = min(same, default=None)
        out.append((own, format(prints[i], "016x"), label[i]))
    return out


def near_rows(seed=3):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("alpha beta gamma delta rho tau phi chi psi".split()) + str(rng.randrange(40)) for _ in range(60)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(30, 90):
        words = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "edit" + str(rng.randrange(9))
        rows.append((i, " ".join(words).upper() if i % 7 == 0 else "  ".join(words)))
    return rows


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[2] or 0)


def test_equals_brute_force(make_docs):
    rows = near_rows() + ODD
    got = [tuple(r) for r in simhash.near_duplicates(make_docs(rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_large_shards_take_the_exact_way(make_docs, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 1)
    rows = near_rows(5)
    got = [tuple(r) for r in simhash.near_duplicates(make_docs(rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    one = [tuple(r) for r in simhash.near_duplicates(make_docs(rows), radius=1).collect()]
    assert sorted(one, key=key) == sorted(brute(rows, 1), key=key)


def test_keep_one_keeps_columns_and_one_of_each_group(make_docs):
    rows = near_rows() + ODD
    docs = make_docs(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({r[2] for r in brute(rows) if r[0] is not None})
    assert ids.count(None) == 1


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.keep_one(make_docs([])).count() == 0


def test_bk_tree_follows_only_edges_within_radius():
    rng = random.Random(1)
    words = list({rng.getrandbits(64) for _ in range(300)})
    words += [w ^ (1 << rng.randrange(64)) for w in words[:100]]
    tree = simhash.BKTree()
    for w in words:
        tree.add(w)
    for w in words[:50]:
        assert sorted(tree.within(w, 2)) == [i for i, x in enumerate(words) if (w ^ x).bit_count() <= 2]


def test_components_of_a_chain_a_star_and_a_pair(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (300, 299)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(51))
    assert all(got[100 + i] == 100 for i in range(40))
    assert got[300] == got[299] == 299 and len(got) == 51 + 40 + 2
