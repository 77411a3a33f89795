"""Rows accounted for in filters and joins, tables in buckets, medians over ranges."""

import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from panelkit.operators import aggregate, joins
from panelkit.plans import pipeline
from panelkit.sources import colocated, panel
from paths import SMALL


def test_join_panel_reports_what_found_no_partner(spark):
    roster, responses = panel.survey_roster(spark, SMALL), panel.responses(spark, SMALL)
    counts = Observation()
    got = pipeline.join_panel(roster, responses, panel.BOOK, counts=counts)
    plain = pipeline.join_panel(roster, responses, panel.BOOK)
    assert got.columns == plain.columns and sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
    want = {"matched": plain.count(), "no_roster": responses.join(roster, "response_id", "left_anti").count(),
            "no_response": roster.join(responses, "response_id", "left_anti").count()}
    assert counts.get == want and min(want.values()) > 0


def test_counted_join_with_null_and_repeated_keys(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d"), (None, "c")], "k int, x string")
    b = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 3.0), (3, 4.0)], "k int, y double")
    counts = Observation()
    got = joins.counted_inner_join(a, b, ["k"], counts)
    assert sorted(map(tuple, got.collect())) == [(1, "a", 1.0), (1, "a", 2.0), (1, "b", 1.0), (1, "b", 2.0)]
    assert counts.get == {"matched": 4, "left_only": 3, "right_only": 2}


def test_counted_filter(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (5,)], "x int")
    counts = Observation()
    assert sorted(r[0] for r in joins.counted_filter(df, F.col("x") > 1, counts).collect()) == [2, 5]
    assert counts.get == {"kept": 2, "dropped": 1, "unknown": 1}
    none = Observation()
    assert joins.counted_filter(df.limit(0), F.col("x") > 1, none).count() == 0


def test_bucketed_tables(spark):
    a = colocated.bucketed(spark.range(100).selectExpr("id AS k", "id % 7 AS x"), "left_side", ["k"], buckets=4)
    b = colocated.bucketed(spark.range(50, 150).selectExpr("id AS k", "id % 5 AS y"), "right_side", ["k"], buckets=4)
    assert a.join(b, "k").count() == 50
    p = a.hint("merge").join(b, "k").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p
    name = a._bucketed
    colocated.drop(a)
    assert not spark.catalog.tableExists(name)


@pytest.mark.parametrize("seed", [1, 2])
def test_median_over_many_ranges(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.choice([None, rng.gauss(0, 9), round(rng.gauss(0, 3))])) for _ in range(4000)]
    rows += [("one", 1, 5.0), ("two", 1, 1.0), ("two", 1, 2.0), ("none", 1, None)] + [("same", 1, 7.0)] * 500
    rows = [(g, v, None if x is None else float(x)) for g, v, x in rows]
    want = defaultdict(list)
    for g, v, x in rows:
        if x is not None:
            want[g, v].append(x)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = aggregate.median_by_group(spark.createDataFrame(rows, "g string, v int, x double"), ["g", "v"], "x").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {(r["g"], r["v"]): r["median"] for r in got} == {k: statistics.median(v) for k, v in want.items()}
