"""The commit log of snapshot stores and the memoised tables."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from panelkit.session import scratch_dir
from panelkit.sources import colocated, snapshots
from paths import SMALL

ROWS = "id long, t string, n int"


@pytest.fixture
def store(spark):
    return scratch_dir(spark, "test-store")


def local(path):
    return path.removeprefix("file:")


def frame(spark, n, t="a"):
    return spark.createDataFrame([(i, t, None) for i in range(n)], ROWS)


def test_an_empty_version_counts(spark, store):
    snapshots.write_snapshot(frame(spark, 3), store, "1")
    snapshots.write_snapshot(frame(spark, 0), store, "2")
    got = snapshots.latest_snapshot(spark, store)
    assert got.count() == 0 and got.dtypes == frame(spark, 0).dtypes
    assert snapshots.snapshot(spark, store, "1").count() == 3


def test_a_store_of_empty_versions_alone(spark, store):
    assert snapshots.latest_snapshot(spark, store) is None
    snapshots.write_snapshot(frame(spark, 0), store, "1")
    assert snapshots.latest_snapshot(spark, store).count() == 0


def test_empty_fetch_and_empty_refresh(spark, store):
    calls = []

    def fetch(n):
        calls.append(n)
        return frame(spark, n)

    assert snapshots.load(spark, store, lambda: fetch(0)).count() == 0
    assert snapshots.load(spark, store, lambda: fetch(3)).count() == 0 and calls == [0]
    assert snapshots.load(spark, store, lambda: fetch(3), force=True).count() == 3
    assert snapshots.load(spark, store, lambda: fetch(0), force=True).count() == 0
    assert snapshots.load(spark, store, lambda: fetch(9)).count() == 0 and calls == [0, 3, 0]


def test_a_half_written_version_is_not_there(spark, store):
    snapshots.write_snapshot(frame(spark, 3), store, "1")
    # files without a manifest, and a manifest that was not renamed
    frame(spark, 5).write.parquet(f"{store}/2-dead")
    with open(f"{local(store)}/_log/.abc", "w") as f:
        f.write(json.dumps({"stamp": "2", "folder": "2-dead"}))
    assert snapshots.snapshot_stamps(spark, store) == ["1"] and snapshots.latest_snapshot(spark, store).count() == 3


def test_a_failing_write_commits_nothing(spark, store):
    snapshots.write_snapshot(frame(spark, 3), store, "1")
    bad = frame(spark, 3).withColumn("n", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        snapshots.write_snapshot(bad, store, "2")
    assert snapshots.snapshot_stamps(spark, store) == ["1"]
    snapshots.write_snapshot(frame(spark, 4), store, "2")
    assert snapshots.latest_snapshot(spark, store).count() == 4


def test_a_stamp_is_committed_once(spark, store):
    snapshots.write_snapshot(frame(spark, 3), store, "1")
    with pytest.raises(FileExistsError):
        snapshots.write_snapshot(frame(spark, 4), store, "1")
    assert snapshots.latest_snapshot(spark, store).count() == 3


def test_versions_keep_their_own_schema(spark, store):
    snapshots.write_snapshot(frame(spark, 2), store, "1")
    snapshots.write_snapshot(frame(spark, 2).withColumn("more", F.lit(1.5)).drop("t"), store, "2", partition_by=["id"])
    assert snapshots.snapshot(spark, store, "1").columns == ["id", "t", "n"]
    assert sorted(snapshots.latest_snapshot(spark, store).select("id", "more").collect()) == [(0, 1.5), (1, 1.5)]


def test_prune(spark, store):
    for i in range(4):
        snapshots.write_snapshot(frame(spark, i), store, str(i))
    frame(spark, 5).write.parquet(f"{store}/9-dead")
    assert len(snapshots.prune(spark, store, keep=2)) == 3
    assert snapshots.snapshot_stamps(spark, store) == ["2", "3"] and snapshots.latest_snapshot(spark, store).count() == 3
    assert len([n for n in os.listdir(local(store)) if not n.startswith((".", "_"))]) == 2
    with pytest.raises(ValueError):
        snapshots.prune(spark, store, keep=0)


def test_latest_per_object_keeps_null_objects_and_unstamped_ones(spark):
    rows = [("a", 1, 1), ("a", 2, 2), (None, 3, 3), (None, 1, 4), ("b", None, 5), ("c", None, 6), ("c", 1, 7)]
    df = spark.createDataFrame(rows, "o string, s int, id int")
    for few in (10_000, 1):
        assert sorted(r["id"] for r in snapshots.latest_per_object(df, "o", "s", few=few).collect()) == [2, 3, 5, 7]
    p = snapshots.latest_per_object(df, "o", "s")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


# --- memoised tables -------------------------------------------------------------


def jobs(spark, run):
    """Number of Spark jobs that ``run`` starts, and its result."""
    sc = spark.sparkContext
    group = f"count-{os.urandom(4).hex()}"
    sc.setJobGroup(group, group)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group)), out


def test_the_second_copy_starts_no_job(spark, store):
    frame(spark, 4).write.parquet(store)
    read = lambda: spark.read.schema(ROWS).parquet(store).filter("id > 0").select("id")
    first, a = jobs(spark, lambda: snapshots.materialize(read(), "memo-a"))
    second, b = jobs(spark, lambda: snapshots.materialize(read(), "memo-a"))
    assert first > 0 and second == 0
    assert sorted(a.collect()) == sorted(b.collect()) == [(1,), (2,), (3,)]
    assert len(snapshots.memoised(spark, "memo-a")) == 1


def test_a_changed_input_or_plan_is_written_anew(spark, store):
    frame(spark, 4).write.parquet(store)
    read = lambda: spark.read.schema(ROWS).parquet(store)
    assert snapshots.materialize(read(), "memo-b").count() == 4
    frame(spark, 2, "b").write.mode("append").parquet(store)
    assert snapshots.materialize(read(), "memo-b").count() == 6
    assert snapshots.materialize(read().filter("id = 1"), "memo-b").count() == 2
    assert snapshots.materialize(read().filter("id = 2"), "memo-b").count() == 1
    assert len(snapshots.memoised(spark, "memo-b")) == 4
    gone = snapshots.forget(spark, "memo-b", but=read())
    assert len(gone) == 3 and len(snapshots.memoised(spark, "memo-b")) == 1
    assert jobs(spark, lambda: snapshots.materialize(read(), "memo-b"))[0] == 0
    assert len(snapshots.forget(spark, "memo-b")) == 1 and snapshots.memoised(spark, "memo-b") == []


def test_two_files_that_change_places_are_told_apart(spark, store):
    frame(spark, 4).write.parquet(f"{store}/x")
    frame(spark, 4, "b").write.parquet(f"{store}/y")
    of = lambda p: spark.read.schema(ROWS).parquet(f"{store}/{p}")
    key = lambda a, b: snapshots.content_key(of(a).join(of(b).select("id"), "id", "left_semi"))
    assert key("x", "y") == key("x", "y") != key("y", "x")


def test_what_has_no_key(spark, store):
    frame(spark, 4).write.parquet(store)
    read = spark.read.schema(ROWS).parquet(store)
    assert snapshots.content_key(read) and snapshots.content_key(spark.range(5))
    assert snapshots.content_key(read.withColumn("r", F.rand())) is None
    assert snapshots.content_key(frame(spark, 3)) is None
    assert snapshots.content_key(read.withColumn("u", F.udf(lambda x: x, "string")("t"))) is None
    assert snapshots.content_key(read.filter(F.col("id") < spark.range(3).select(F.max("id")).scalar())) is None
    a = snapshots.materialize(frame(spark, 3), "memo-c")
    b = snapshots.materialize(frame(spark, 3, "b"), "memo-c")
    assert {r["t"] for r in a.collect()} == {"a"} and {r["t"] for r in b.collect()} == {"b"}


def test_a_wide_plan_is_keyed_by_all_its_columns(spark, store):
    frame(spark, 4).write.parquet(store)
    read = spark.read.schema(ROWS).parquet(store)
    wide = lambda last: read.select("id", *[F.lit(i).alias(f"c{i}") for i in range(60)], F.lit(last).alias("z"))
    assert snapshots.content_key(wide(1)) != snapshots.content_key(wide(2))


def test_study_finds_its_panel_again(spark):
    from panelkit.plans.study import PanelStudy
    from panelkit.sources import panel

    study = lambda: PanelStudy(panel.survey_roster(spark, SMALL), panel.responses(spark, SMALL), book=panel.BOOK)
    study().materialized("memo-study")
    n, again = jobs(spark, lambda: study().materialized("memo-study"))
    assert n == 0 and again.root().count() == study().root().count()


def test_the_written_panel_shuffles_no_answers(spark, monkeypatch):
    """Only ids, row numbers and the roster's fields are exchanged, and nothing wide is sorted or broadcast."""
    from panelkit.plans.study import PanelStudy
    from panelkit.sources import panel

    plans, write = [], snapshots.write_snapshot

    def noted(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args, **kwargs)

    monkeypatch.setattr(snapshots, "write_snapshot", noted)
    before = {k: spark.conf.get(k, None) for k in colocated._ATTACH_CONF}
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        study = PanelStudy(panel.survey_roster(spark, SMALL), panel.responses(spark, SMALL), book=panel.BOOK)
        got, wanted = study.materialized(f"memo-{os.urandom(4).hex()}").joined(), study.joined()
        assert sorted(got.columns) == sorted(wanted.columns)
        assert got.select(wanted.columns).exceptAll(wanted).isEmpty() and got.count() == wanted.count() > 0
    finally:
        spark.conf.unset(threshold) if before[threshold] is None else spark.conf.set(threshold, before[threshold])
    moved = [node for node in re.split(r"\n[ :+-]*", plans[0]) if "Exchange" in node]
    assert len(plans) == 1 and len(moved) == 3  # ids, roster fields, fields by block
    wide = next(node for node in plans[0].split("\n") if "FileScan" in node and "Bucketed: true" in node and "demo_sex" in node)
    above = plans[0][: plans[0].index(wide)].rsplit("Join", 1)[1]
    assert "Exchange" not in above and "Broadcast" not in plans[0]
    assert {k: spark.conf.get(k, None) for k in before} == before


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_attached_fields_are_those_of_the_join(spark, adaptive):
    """Keys that repeat on either side, that are missing, or that have no partner; blocks of few rows."""
    wide = spark.createDataFrame([(i % 40 if i % 7 else None, i, f"a{i % 3}" if i % 5 else None) for i in range(300)],
                                 "k long, n int, `a.b` string").repartition(5)
    narrow = spark.createDataFrame([(i % 50 if i % 6 else None, f"x{i}", None) for i in range(10, 90)], "k long, t string, none date")
    wanted = wide.join(narrow, "k")
    tables = spark.catalog.listTables()
    adaptive_key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(adaptive_key)
    spark.conf.set(adaptive_key, adaptive)
    try:
        for rows in (1, 7, 1000):
            with colocated.attached(wide, narrow, "k", block_rows=rows) as got:
                assert got.dtypes == wanted.dtypes
                assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect())) != []
    finally:
        spark.conf.set(adaptive_key, before)
    assert spark.catalog.listTables() == tables  # what was written on the way is gone


def test_nothing_is_left_of_a_failed_attachment(spark):
    tables = spark.catalog.listTables()
    bad = frame(spark, 3).withColumn("n", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"), colocated.attached(bad, frame(spark, 3).select("id"), "id") as got:
        got.count()
    assert spark.catalog.listTables() == tables
