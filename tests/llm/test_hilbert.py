import itertools
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from odd_rows import ODD
from panelkit.llm import hilbert


def test_curve_visits_neighbours(spark):
    for dims, bits in ((2, 3), (3, 3)):
        points = list(itertools.product(range(1 << bits), repeat=dims))
        df = spark.createDataFrame(points, [f"c{i}" for i in range(dims)])
        got = df.select("*", hilbert.hilbert_index([F.col(f"c{i}") for i in range(dims)], bits).alias("h")).collect()
        by = {r["h"]: r[:dims] for r in got}
        assert sorted(by) == list(range(len(points)))
        assert all(sum(abs(a - b) for a, b in zip(by[i], by[i + 1])) == 1 for i in range(len(points) - 1))


def test_shards(make_docs):
    rows = [(i, f"text {i % 300} " + "é" * (i % 50), "en" if i % 3 else "de", f"src{i % 9}") for i in range(1000)] + ODD
    got = hilbert.hilbert_shards(make_docs(rows)).collect()
    assert len(got) == len(rows)
    text = dict(rows_by_id(rows))
    count, slots = Counter(), defaultdict(list)
    for r in got:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
        count[r["shard"]] += 1
        slots[r["shard"]].append(r["slot"])
    assert set(count) == set(range(40)) and max(count.values()) - min(count.values()) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # equal texts stand side by side in the order of (shard, slot)
    order = [text[r["doc_id"]] or "" for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert len([1 for a, b in zip(order, order[1:]) if a != b]) + 1 == len(set(order))


def rows_by_id(rows):
    return {r[0]: r[1] for r in rows}


def test_shards_prune(make_docs):
    rows = [(i, "w " * (i * 37 % 1000), "en", f"src{i * 11 % 16:02d}") for i in range(4000)]
    docs = make_docs(rows)
    got = hilbert.hilbert_shards(docs, dims=("source",)).join(docs.select("doc_id", "source"), "doc_id")
    sources = got.groupBy("shard").agg(F.countDistinct("source").alias("n"), (F.max("size") - F.min("size")).alias("w")).collect()
    assert sum(r["n"] for r in sources) / 40 < 8 and sum(r["w"] for r in sources) / 40 < 1500


def test_few_rows_and_none(make_docs):
    assert hilbert.hilbert_shards(make_docs([])).count() == 0
    got = hilbert.hilbert_shards(make_docs([(1, "a"), (2, None), (None, "")])).collect()
    assert sorted(r["slot"] for r in got) == [0, 0, 0] and len({r["shard"] for r in got}) == 3


def test_write_shards(make_docs, tmp_path):
    rows = [(i, f"t{i}") for i in range(200)]
    docs = make_docs(rows)
    hilbert.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_write_shards_keeps_null_and_repeated_ids(make_docs, tmp_path):
    rows = [(i, f"t{i}") for i in range(50)] + [(None, f"n{i}") for i in range(7)] + [(3, "t3")] * 4 + [(4, f"r{i}") for i in range(6)] + [(None, None)] * 2
    docs = make_docs(rows)
    hilbert.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*docs.columns, "shard", "slot"}
    assert Counter(map(tuple, back.select(docs.columns).collect())) == Counter(map(tuple, docs.collect()))
    placed = lambda df: Counter(map(tuple, df.select("doc_id", "shard", "slot").collect()))
    assert placed(back) == placed(hilbert.hilbert_shards(docs, shards=4))


def test_text_levels_look_at_whole_values(make_docs):
    rows = [(i, f"t{i}", "en", None if i % 10 == 9 else f"https://example.com/é/{i * 7 % 64:03d}") for i in range(1280)]
    docs = make_docs(rows)
    got = docs.select("source", hilbert.text_levels(docs, "source", 4).alias("level")).collect()
    values = sorted((r["source"] for r in got if r["source"] is not None), key=str.encode)
    through = {v: i + 1 for i, v in enumerate(values)}
    assert all(r["level"] == (None if r["source"] is None else min(through[r["source"]] * 16 // len(values), 15)) for r in got)


def test_shards_prune_on_sources_with_one_beginning(make_docs):
    rows = [(i, "w " * (i * 37 % 1000), "en", f"common_crawl_{i * 11 % 16:02d}") for i in range(4000)]
    docs = make_docs(rows)
    got = hilbert.hilbert_shards(docs, dims=("source",)).join(docs.select("doc_id", "source"), "doc_id")
    sources = got.groupBy("shard").agg(F.countDistinct("source").alias("n")).collect()
    assert sum(r["n"] for r in sources) / 40 < 8
