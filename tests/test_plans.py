"""Plan checks: no Python on the row path, pruned scans, partial aggregation,
top-n instead of a global sort, no single-partition window."""

import json
import re

import pytest

from paths import SMALL
from panelkit.queries import QUERIES

SKIP = {"snapshot_roundtrip", "snapshot_versions", "csv_roundtrip", "csv_crosstab", "read_through", "materialized_panel", "landed_responses", "colocated_panel", "accounted_join"}  # read back a written table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def window_partition_specs(df):
    """partitionSpec of every physical Window node (pre-AQE physical plan)."""
    nodes = json.loads(df._jdf.queryExecution().sparkPlan().toJSON())
    return [n.get("partitionSpec") for n in nodes if n["class"].endswith("WindowExec")]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_python_udf_and_no_unpartitioned_window(spark, name):
    df = QUERIES[name](spark, SMALL)
    p = plan(df)
    assert "EvalPython" not in p and "PythonUDF" not in p
    for spec in window_partition_specs(df):
        assert spec, f"unpartitioned window in {name}"


def test_consolidation_is_partial_then_final(spark):
    p = plan(QUERIES["consolidate_baseline"](spark, SMALL))
    assert "partial_min(" in p


def test_flagship_reads_only_needed_columns(spark):
    df = QUERIES["quarterly_table"](spark, SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    orders_scan = [l for l in p.splitlines() if "orders.parquet" in l]
    assert orders_scan and all("o_totalprice" not in l for l in orders_scan)


def test_drop_last_uses_top_n(spark):
    p = plan(QUERIES["drop_last_rows"](spark, SMALL))
    assert "TakeOrderedAndProject" in p


def test_window_check_sees_windows(spark):
    specs = window_partition_specs(QUERIES["category_crosstab"](spark, SMALL))
    assert specs and all(specs)


def test_relationship_extract_pushes_in_list_to_scan(spark):
    p = plan(QUERIES["relationship_extract"](spark, SMALL))
    scan = [l for l in p.splitlines() if "customer.parquet" in l]
    assert scan and any("PushedFilters" in l and "In(c_mktsegment" in l for l in scan)


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


def test_baseline_scans_each_side_once_and_shuffles_three_times(spark):
    for name in ("consolidate_baseline", "recency_flag"):
        p = plan(QUERIES[name](spark, SMALL))
        assert p.count("FileScan parquet") == 2
    # responses and roster on the response id, then the participant aggregate
    assert shuffles(QUERIES["consolidate_baseline"](spark, SMALL)) <= 3


def test_outcome_tables_come_from_one_pass(spark):
    for name, most in (("employment_status", 5), ("compensation", 5), ("scale_by_wave", 6)):
        df = QUERIES[name](spark, SMALL)
        assert exchanges(df) <= most, name
        assert plan(df).count("orders.parquet") <= 2 and plan(df).count("Join") <= 2


def test_participants_in_one_pass(spark):
    p = plan(QUERIES["assemble_participant"](spark, SMALL))
    orders = [line for line in p.splitlines() if "FileScan" in line and "orders.parquet" in line]
    # roster rows, responses, and the best answer of each survey
    assert len(orders) <= 3
    # both sides and the repair file on the response id, surveys, then two folds of the participants
    assert shuffles(QUERIES["assemble_participant"](spark, SMALL)) <= 6
    assert p.count("SortMergeJoin") <= 2


def test_landed_surveys_are_read_in_one_scan(spark):
    p = plan(QUERIES["landed_responses"](spark, SMALL))
    # the files of all surveys, and the catalogue
    assert p.count("FileScan parquet") == 2


def exchanges(df):
    """Exchanges of rows, broadcasts apart; those that reuse another one's rows count too."""
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hashpartitioning|SinglePartition|rangepartitioning|RoundRobin)", plan(df)))


@pytest.mark.parametrize("name,most", [("quarter_demographics", 5), ("sample_table", 5), ("education_distribution", 5)])
def test_reports_read_the_participants_once(spark, name, most):
    df = QUERIES[name](spark, SMALL)
    assert plan(df).count("FileScan parquet") == 2 and exchanges(df) <= most


def test_colocated_tables_join_without_an_exchange(spark):
    # the size-based broadcast would hide the buckets on these small tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(QUERIES["colocated_panel"](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in p[p.index("SortMergeJoin"):] and "Bucketed: true" in p


def test_median_runs_over_ranges_not_groups(spark):
    specs = window_partition_specs(QUERIES["median_amount"](spark, SMALL))
    # one window runs over a group's ranges, a row each; the running sum over values stays within a range
    text = json.dumps([s for s in specs if "__part" in json.dumps(s)])
    assert "__part" in text and len(specs) >= 2
