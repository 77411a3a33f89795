import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from odd_rows import ODD
from panelkit.llm import curriculum


def fill(sizes):
    """Targets by the words of the contract: share by weight, cap at twice the size, reshare until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def docs_of(make_docs):
    rows = [(i, "w " * (1 + i * 13 % 50), "en", None if i % 11 == 0 else f"s{i * i % 7}") for i in range(400)]
    rows += [(1000 + i, "v " * (i % 90), "en", "S0") for i in range(300)]
    rows += [(*r, "en", "tiny") for r in ODD]
    return rows, make_docs(rows)


def test_targets_and_taken(make_docs):
    rows, docs = docs_of(make_docs)
    got = curriculum.mix_plan(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want, taken = fill(sizes), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert (r["position"] is None) == (r["taken"] == 0) or r["size"] == 0
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == int(want[s] + 1e-9) for s in sizes)
    again = curriculum.mix_plan(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_schedule_is_inverted(spark):
    grid = spark.range(1001).select((F.col("id") / 1000.0).alias("u"))
    for points in curriculum.SCHEDULES + (((0.0, 0.0), (0.2, 2.0), (1.0, 0.1)),):
        parts, whole = curriculum.segments(points)

        def area(t):
            out = 0.0
            for t0, w0, slope, before, own in parts:
                if t >= t0:
                    x = t - t0
                    out = before + w0 * x + slope * x * x / 2
            return out / whole

        for r in grid.select("u", curriculum.demand_time(F.col("u"), points).alias("t")).collect():
            assert area(r["t"]) == pytest.approx(r["u"], abs=1e-9)


def test_stream_is_sorted_and_whole(make_docs):
    rows, docs = docs_of(make_docs)
    plan = curriculum.mix_plan(docs)
    stream = curriculum.mix(docs)
    assert stream.columns == docs.columns
    words = defaultdict(int)
    for r in stream.collect():
        words[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert r["n_chars"] == len(r["text"])
    want = {r["source"]: r["t"] for r in plan.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert dict(words) == {s: t for s, t in want.items() if t}
    order = {r["doc_id"]: (r["position"], r["again"]) for r in plan.collect()}
    seen, last = set(), -1.0
    for r in stream.select("doc_id").collect():
        if r["doc_id"] not in (None, 10106):
            first, second = order[r["doc_id"]]
            now = second if r["doc_id"] in seen or first is None else first
            seen.add(r["doc_id"])
            assert now >= last
            last = now


def test_without_words_or_rows(make_docs):
    assert curriculum.mix_plan(make_docs([])).count() == 0
    assert curriculum.mix(make_docs([])).count() == 0
    (r,) = curriculum.mix_plan(make_docs([(1, None)])).collect()
    assert (r["size"], r["target"], r["taken"], r["position"]) == (0, 0.0, 0, None)
    one = curriculum.mix_plan(make_docs([(1, "a b c")])).collect()[0]
    assert (one["target"], one["taken"]) == (4.5, 4)
