import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from odd_rows import ODD  # noqa: E402
from panelkit.llm import curriculum, pieces, recompression, simhash  # noqa: E402
from panelkit.llm.common import materialize, table  # noqa: E402
from panelkit.llm.queries import ORACLE, QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_stages_in_turn(spark, make_docs):
    docs = table(spark, SMALL, "documents")
    docs = docs.unionByName(make_docs([(*r, None) for r in ODD]).select(docs.columns))
    columns = docs.columns
    whole = {r["doc_id"]: r for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SMALL), name)
        kept.append(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    language, single, cut, mixed, last = kept
    ids = {r["doc_id"] for r in language.collect()}
    assert set(whole) - ids == {10100, 10101, 10102, 10103}
    groups = simhash.near_duplicates(language).filter("doc_id is not null")
    want = {r["component_id"] for r in groups.collect()}
    assert {r["doc_id"] for r in single.filter("doc_id is not null").collect()} == want and single.count() == len(want) + 1
    digest = {r["doc_id"]: r for r in recompression.dedup_digests(single).collect()}
    for r in cut.collect():
        gone = digest[r["doc_id"]]["n_removed"]
        assert r["text"] == whole[r["doc_id"]]["text"] if not gone else len(r["text"].encode().split()) == digest[r["doc_id"]]["n_words"] - gone
    taken = {r["doc_id"]: r["taken"] for r in curriculum.mix_plan(cut).collect() if r["taken"]}
    got = {}
    for r in mixed.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(r["text"].encode().split())
    assert got == taken
    assert last.count() == mixed.count() and last.filter("NOT round_trip").count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    want = want.fetchall()
    df = QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, want))


def test_registered():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {int(q[2:].split("_")[0]) for q in QUERIES} <= set(range(1, 14)) and pieces.MODEL


HELPERS = ["_p", "_k", "_i", "_j", "_id", "_n", "_nth", "_size", "_src", "_time", "_times", "_text", "_new", "_short", "_starts", "_whole", "_kept",
           "_number", "_placed", "_rank", "_part", "_row", "id", "k", "shard", "slot", "part", "row", "kind", "position", "taken", "target"]


def test_stages_leave_columns_of_any_name_alone(spark, make_docs):
    rows = [(i, " ".join(f"word{(i * 7 + j) % 50}" for j in range(80)), ["en", "de"][i % 2], f"s{i % 3}") for i in range(40)] + [(3, "once more", "en", "s1"), (None, "no id", "de", "s1")]
    docs = make_docs(rows).select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(n).alias(h) for n, h in enumerate(HELPERS)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SMALL)
        assert got.columns == docs.columns, name
        kept = got.collect()
        assert kept and all(r[h] == n for r in kept for n, h in enumerate(HELPERS)), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == len(rows)


def test_shards_are_written_for_columns_of_any_name(spark, make_docs, tmp_path):
    from panelkit.llm import hilbert

    docs = make_docs([(i, f"t{i}") for i in range(30)]).select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(n).alias(h) for n, h in enumerate(HELPERS)])
    hilbert.write_shards(docs, str(tmp_path / "out"), shards=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 30 and {"shard", "slot", "shard_", "slot_", "_number"} <= set(back.columns)
    assert {(r["shard_"], r["_number"]) for r in back.collect()} == {(HELPERS.index("shard"), HELPERS.index("_number"))}


def test_tables_made_on_the_way_are_released(spark):
    import os

    from panelkit.llm.common import released

    paths = []
    with released() as keep:
        a = materialize(spark.range(3).toDF("x"), "spent")
        b = materialize(a.filter("x > 0"), "kept")
        keep(b)
        paths = [t._scratch.removeprefix("file:") for t in (a, b)]
    assert [os.path.exists(p) for p in paths] == [False, True] and b.count() == 2
