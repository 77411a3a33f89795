"""Unit fixtures for the semantic decisions (missing values, ties, ranges, formats)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelkit import codebook as cb
from panelkit.functions import dates, formatting, logic, text
from panelkit.operators import aggregate, joins, reshape, schema
from panelkit.plans import harmonise, scales
from panelkit.sources import files, records, snapshots


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_golden_percent_cells_half_even(spark):
    # Formats of the saved quarterly output: 12/32, 4/32, 5/8, 0/32.
    df = spark.createDataFrame([(12, 32), (4, 32), (5, 8), (0, 32), (3, 0)], "n int, N_all int")
    got = [r[0] for r in df.select(formatting.pct_cell(F.col("n"), F.col("N_all"))).collect()]
    assert got == ["38% (12/32)", "12% (4/32)", "62% (5/8)", "0% (0/32)", None]


def test_consolidate_first_non_missing_in_order(spark):
    df = spark.createDataFrame(
        [(1, 2, 1, 10, None, "b"), (1, 1, 2, 11, 5, None), (1, 1, 1, 12, None, "a"), (2, 1, 1, 13, None, None)],
        "id int, wave int, version int, rid int, x int, s string")
    out = aggregate.consolidate(df, ["id"], ["wave", "version", "rid"])
    got = sorted(rows(out, "id", "x", "s"))
    assert got == [(1, 5, "a"), (2, None, None)]


def test_fill_within_keeps_rows_and_null_keys(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, None), (1, 1, 2, 7), (1, 2, 3, None), (None, 1, 4, 3), (None, 1, 5, None)],
        "id int, wave int, rid int, x int")
    out = aggregate.fill_within(df, ["id", "wave"], ["rid"], ["x"])
    got = sorted(rows(out, "rid", "x"))
    assert got == [(1, 7), (2, 7), (3, None), (4, 3), (5, 3)]


def test_rows_update_overwrites_including_nulls(spark):
    x = spark.createDataFrame([(1, 1.0, 1.0), (2, 2.0, 2.0), (3, 3.0, 3.0)], "id int, a double, b double")
    y = spark.createDataFrame([(2, None, 9.0), (4, 4.0, 4.0)], "id int, a double, b double")
    got = sorted(rows(joins.rows_update(x, y, ["id"]), "id", "a", "b"))
    assert got == [(1, 1.0, 1.0), (2, None, 9.0), (3, 3.0, 3.0)]


def test_strict_max(spark):
    df = spark.createDataFrame([(1, 3), (1, None), (2, 4), (2, 1)], "g int, v int")
    got = sorted(rows(df.groupBy("g").agg(aggregate.strict_max("v").alias("m")), "g", "m"))
    assert got == [(1, None), (2, 4)]


def test_right_closed_bands_outside_is_null(spark):
    df = spark.createDataFrame([(0,), (1,), (20,), (21,), (60,), (61,), (100,), (101,), (None,)], "a int")
    got = [r[0] for r in df.select(logic.right_closed_bands("a", cb.AGE_BREAKS, cb.AGE_LABELS)).collect()]
    assert got == [None, "20 or younger", "20 or younger", "21 to 30", "41 to 60", "61 or older",
                   "61 or older", None, None]


def test_dates_from_parts_and_truncation(spark):
    df = spark.createDataFrame([(2000, 13), (2000, 2), (None, 2)], "y int, m int")
    got = [r[0] for r in df.select(dates.date_from_parts("y", "m")).collect()]
    assert got == [None, dt.date(2000, 2, 1), None]
    d = spark.createDataFrame([(dt.date(2000, 3, 1), dt.date(2020, 2, 29)), (dt.date(2000, 3, 1), dt.date(2020, 3, 1))],
                              "s date, e date")
    assert [r[0] for r in d.select(dates.completed_years("s", "e")).collect()] == [19, 20]


def test_tenure_weeks_average_month_vs_exact(spark):
    d = spark.createDataFrame([(dt.date(2022, 1, 1), dt.date(2024, 3, 15))], "s date, e date")
    r = d.select(dates.period_weeks("s", "e").alias("avg"), dates.period_weeks("s", "e", exact=True).alias("ex")).first()
    assert round(r["avg"], 2) == 115.05 and round(r["ex"], 2) == 114.86


def test_fiscal_quarter(spark):
    d = spark.createDataFrame([(dt.date(2024, 3, 15),), (dt.date(2024, 2, 1),), (dt.date(2024, 4, 1),)], "d date")
    got = rows(d.select(dates.fiscal_year("d", 3).alias("y3"), dates.fiscal_quarter("d", 3).alias("q3"),
                        dates.fiscal_year("d", 4).alias("y4"), dates.fiscal_quarter("d", 4).alias("q4")),
               "y3", "q3", "y4", "q4")
    assert got == [(2025, 1, 2024, 4), (2024, 4, 2024, 4), (2025, 1, 2025, 1)]


def test_parse_number_and_integer(spark):
    d = spark.createDataFrame([("$45,000.50 CAD",), ("none",), ("-12",), (None,)], "t string")
    got = rows(d.select(text.parse_number("t").alias("x"), text.parse_integer("t").alias("i")), "x", "i")
    assert got == [(45000.5, None), (None, None), (-12.0, -12), (None, None)]


def test_arm_label_trims_before_extract_and_remove(spark):
    d = spark.createDataFrame([("A - Program",), ("B - Comparison ",), ("C",)], "cohort_name string")
    got = rows(harmonise.clean_roster(d), "cohort_name", "assignment_label_fct", "program_eligible")
    assert got == [("A", "Program", True), ("B", "Comparison", False), ("C", "Non-RCT", True)]


def test_select_all_flags(spark):
    d = spark.createDataFrame([(None, None, None), ("x", None, None), ("x", "y", None), (None, "y", None),
                               (None, None, "z")], "o1 string, o2 string, o3 string")
    got = rows(d.select(harmonise.select_all_flag(["o1", "o2", "o3"], "o2", only=False).alias("a"),
                        harmonise.select_all_flag(["o1", "o2", "o3"], "o2", only=True).alias("b")), "a", "b")
    assert got == [(None, None), (True, True), (False, True), (False, False), (True, True)]


def test_block_means_strict(spark):
    d = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0), (1.0, None, 3.0, 4.0)], "a double, b double, c double, d double")
    cols = logic.block_means(["a", "b", "c", "d"], [("x", 1, 2), ("y", 3, 4)])
    got = rows(d.select(*cols), "x", "y")
    assert got == [(1.5, 3.5), (None, None)]


def test_kleene_flag_algebra(spark):
    d = spark.createDataFrame([(True, None), (False, None), (False, False)], "a boolean, b boolean")
    got = rows(d.select((F.col("a") | F.col("b")).alias("o"), logic.none_of(["a", "b"]).alias("n"),
                        logic.in_set("b", [True]).alias("i")), "o", "n", "i")
    assert got == [(True, None, False), (None, None, False), (False, True, False)]


def test_union_by_name_aligns_types(spark):
    a = spark.createDataFrame([(1, 5)], "id int, code int")
    b = spark.createDataFrame([(2, "x", 1.5)], "id int, code string, extra double")
    out = joins.union_by_name([a, b])
    assert dict(out.dtypes)["code"] == "string"
    assert sorted(rows(out, "id", "code", "extra")) == [(1, "5", None), (2, "x", 1.5)]


def test_drop_last_removes_highest(spark):
    d = spark.range(10).withColumnRenamed("id", "k")
    assert sorted(r[0] for r in files.drop_last(d, "k", 2).collect()) == list(range(8))


def test_clean_names_and_regex_ops(spark):
    d = spark.createDataFrame([(1, 2, 3, 4)], "`CustKey` int, `Customer Name` int, `a1_job` int, `a2_job` int")
    c = schema.clean_names(d)
    assert c.columns == ["cust_key", "customer_name", "a1_job", "a2_job"]
    p = schema.rename_matching(schema.drop_matching(c, "^a[2-9]_"), "^a1_", "")
    assert p.columns == ["cust_key", "customer_name", "job"]


def test_unpivot_pattern_greedy(spark):
    d = spark.createDataFrame([(1, 5, None)], "id int, Q115_1_2 int, Q115_10_1 int")
    got = sorted(rows(reshape.unpivot_pattern(d, ["id"], "Q115_(.*)_(.*)", ["item", "opt"], "v"), "item", "opt", "v"))
    assert got == [("1", "2", 5), ("10", "1", None)]


def test_flatten_records_optional_parent(spark):
    from pyspark.sql import types as T

    meta = T.StructType([T.StructField("type", T.StringType())])
    sch = T.StructType([T.StructField("attributes", meta), T.StructField("Id", T.LongType()),
                        T.StructField("P", T.StructType([T.StructField("attributes", meta),
                                                         T.StructField("Name", T.StringType())]))])
    d = spark.createDataFrame([('{"attributes":{"type":"X"},"Id":1,"P":{"attributes":{},"Name":"n"}}',),
                               ('{"attributes":{"type":"X"},"Id":2,"P":null}',)], "j string")
    out = records.flatten_records(d, "j", sch, {"P.Name": "parent_name"})
    assert out.columns == ["Id", "parent_name"]
    assert sorted(rows(out, "Id", "parent_name")) == [(1, "n"), (2, None)]


def test_snapshot_store_latest(spark):
    from panelkit.session import scratch_dir

    store = scratch_dir(spark, "test-snap")
    assert snapshots.latest_snapshot(spark, store) is None
    snapshots.write_snapshot(spark.createDataFrame([(1,)], "x int"), store, "20240101000000")
    snapshots.write_snapshot(spark.createDataFrame([(2,), (3,)], "x int"), store, "20250101000000")
    assert sorted(r[0] for r in snapshots.latest_snapshot(spark, store).collect()) == [2, 3]


def test_median_by_group_exact(spark):
    d = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 1), ("b", 2), ("b", 10), ("b", 10),
                               ("c", None), ("c", 5)], "g string, v int")
    got = sorted(rows(aggregate.median_by_group(d, ["g"], "v"), "g", "median"))
    assert got == [("a", 2.0), ("b", 6.0), ("c", 5.0)]


def test_read_through_fetches_once(spark):
    from panelkit.session import scratch_dir

    store = scratch_dir(spark, "test-load")
    calls = []

    def fetch():
        calls.append(1)
        return spark.createDataFrame([(len(calls),)], "x int")

    first = snapshots.load(spark, store, fetch)
    again = snapshots.load(spark, store, fetch)
    forced = snapshots.load(spark, store, fetch, force=True)
    assert [r[0] for r in first.collect()] == [1]
    assert [r[0] for r in again.collect()] == [1]
    assert len(calls) == 2 and [r[0] for r in forced.collect()] == [2]


def test_materialize_partitions_and_reads_back(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "id int, wave int")
    m = snapshots.materialize(df, "test-mat", ("wave",))
    assert sorted(rows(m.filter("wave = 2"), "id")) == [(2,), (3,)]


def test_pivot_named(spark):
    long = spark.createDataFrame([(1, 1, 2.0), (1, 1, 4.0), (1, 2, None), (2, 2, 5.0)], "id int, item int, v double")
    wide = reshape.pivot_named(long, ["id"], "item", [1, 2, 3], F.avg("v"), "emp_{}")
    assert sorted(rows(wide, "id", "emp_1", "emp_2", "emp_3")) == [(1, 3.0, None, None), (2, None, 5.0, None)]


def test_nest_unnest_roundtrip(spark):
    d = spark.createDataFrame([(1, 2, 0.5), (1, 1, 0.25), (2, 1, 1.0)], "id int, wave int, s double")
    n = reshape.nest(d, ["id"], ["wave"], "hist")
    first = {r["id"]: r["hist"][0]["wave"] for r in n.collect()}
    assert first == {1: 1, 2: 1}
    assert sorted(rows(reshape.unnest(n, "hist"), "id", "wave", "s")) == sorted(rows(d, "id", "wave", "s"))


def test_dispatch_per_key_and_stack(spark):
    from panelkit.plans import pipeline

    d = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "id int, version int")
    out = pipeline.dispatch(d, ["version"], {
        (1,): lambda x: x.withColumn("a", F.lit("v1")),
        (2,): lambda x: x.withColumn("b", F.lit(2)),
    })
    assert sorted(rows(out, "id", "a", "b")) == [(1, "v1", None), (2, None, 2), (3, None, 2)]


def test_columns_between(spark):
    d = spark.createDataFrame([(1, 2, 3, 4)], "Total int, a int, b int, c int")
    assert schema.columns_between(d, "a", "c") == ["a", "b", "c"]


def test_study_object_matches_registered_queries(spark):
    import __spark_entry__ as E
    from paths import SMALL
    from panelkit.plans.study import PanelStudy
    from panelkit.sources import panel

    study = PanelStudy(panel.survey_roster(spark, SMALL), panel.responses(spark, SMALL), panel.repair(spark, SMALL),
                       book=panel.BOOK)
    a = sorted(map(tuple, study.root().collect()), key=lambda t: t[0])
    b = sorted(map(tuple, E.queries()["consolidate_baseline"](spark, SMALL).collect()), key=lambda t: t[0])
    assert a == b
    m = study.materialized("test-study")
    assert m.root().count() == len(a)
    assert study.participants().count() == len(a)
    assert study.surveys().count() == panel.survey_roster(spark, SMALL).count()


def test_csv_sink_and_inferred_scan(spark):
    from panelkit.session import scratch_dir

    path = scratch_dir(spark, "test-csv")
    df = spark.createDataFrame([(1, 2.5, "a b", None), (2, None, "", "x")], "i int, d double, s string, t string")
    files.write_csv(df, path, single_file=True)
    back = files.read_csv(spark, path, infer=True)
    assert dict(back.dtypes) == {"i": "int", "d": "double", "s": "string", "t": "string"}
    assert sorted(rows(back, "i", "d", "s", "t")) == [(1, 2.5, "a b", None), (2, None, "", "x")]


def test_drop_all_null_columns(spark):
    d = spark.createDataFrame([(1, None, "a"), (2, None, None)], "id int, gone string, kept string")
    assert schema.drop_all_null(d).columns == ["id", "kept"]


def test_satisfaction_aggregate_equals_full_join(spark):
    from paths import SMALL
    from panelkit.plans import pipeline
    from panelkit.sources import panel

    p = panel.responses(spark, SMALL)
    a = pipeline.construct_satis(p, method="aggregate")
    b = pipeline.construct_satis(p, method="full_join")
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, b.select(*cols).collect()))


def test_read_landed_json_records(spark):
    from panelkit.session import scratch_dir
    from pyspark.sql import types as T

    meta = T.StructType([T.StructField("type", T.StringType())])
    sch = T.StructType([T.StructField("attributes", meta), T.StructField("Id", T.LongType()),
                        T.StructField("P", T.StructType([T.StructField("attributes", meta),
                                                         T.StructField("Name", T.StringType())]))])
    path = scratch_dir(spark, "test-json")
    spark.createDataFrame([('{"attributes":{"type":"X"},"Id":1,"P":{"Name":"n"}}',), ('{"Id":2}',)],
                          "value string").write.text(path)
    out = records.read_records(spark, path, sch, {"P.Name": "parent_name"})
    assert out.columns == ["Id", "parent_name"]
    assert sorted(rows(out, "Id", "parent_name")) == [(1, "n"), (2, None)]


# --- nothing is lost silently ---------------------------------------------------


def test_dispatch_stops_or_takes_the_default_for_unlisted_keys(spark):
    from panelkit.plans import pipeline

    d = spark.createDataFrame([(1, 1), (2, 2), (3, 9), (4, None)], "id int, version int")
    branches = {(v,): lambda x: x.select("id") for v in (1, 2)}
    assert pipeline.dispatch(d, ["version"], branches, default=lambda x: x.select("id")).count() == 4
    with pytest.raises(Exception, match="no branch"):
        pipeline.dispatch(d, ["version"], branches).collect()
    assert pipeline.dispatch(d.limit(2), ["version"], branches).count() == 2


def test_drop_last_with_ties(spark):
    d = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 3), (5, 3)], "id int, k int")
    assert sorted(r[0] for r in files.drop_last(d, "k", 2, ties=["id"]).collect()) == [1, 2, 3]
    with pytest.raises(Exception, match="do not tell"):
        files.drop_last(d, "k", 2).collect()
    nulls = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "id int, k int")
    assert sorted(r[0] for r in files.drop_last(nulls, "k", 2).collect()) == [1]
    assert files.drop_last(nulls.limit(0), "k", 2).count() == 0


def test_top_box_keeps_rows_without_a_version(spark):
    d = spark.createDataFrame([(1, 1, 2, None, 5), (2, 2, 2, None, 3), (3, 3, 2, 1, 1)],
                              "enrollment_id int, response_id int, wave int, version int, satis_1 int")
    for j in range(2, 7):
        d = d.withColumn(f"satis_{j}", F.col("satis_1"))
    raw = [f"satis_{j}" for j in range(1, 7)]
    assert scales.satisfaction_top_box(d, 2, raw).count() == 3
    got = scales.satisfaction_top_box_waves(d, {2: raw})
    name = got.columns[4]
    assert sorted(rows(got, "response_id", name)) == [(1, True), (2, False), (3, True)]


def test_pivots_refuse_unlisted_levels(spark):
    long = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "id int, lab string, v string")
    assert reshape.pivot_cells(long, ["id"], "lab", ["a", "b"], "v").count() == 1
    for bad in (long.filter("lab = 'b'"), long.withColumn("lab", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="without a column"):
            reshape.pivot_cells(bad, ["id"], "lab", ["a"], "v").collect()
        with pytest.raises(Exception, match="without a column"):
            reshape.pivot_named(bad, ["id"], "lab", ["a"], F.max("v")).collect()


def test_positional_names_need_equal_length():
    from panelkit.codebook import DEFAULT_CODEBOOK

    names = ["a", "b", "c"]
    assert DEFAULT_CODEBOOK.check_arity(names, ["x", "y", "z"], "t") == names
    assert DEFAULT_CODEBOOK.check_arity(names, ["x", "y"], "t", fewer=True) == ["a", "b"]
    for columns in (["x", "y"], ["w", "x", "y", "z"]):
        with pytest.raises(ValueError):
            DEFAULT_CODEBOOK.check_arity(names, columns, "t")


def test_rows_update_refuses_unknown_columns_and_repeated_keys(spark):
    x = spark.createDataFrame([(1, 10), (2, 20)], "id int, v int")
    y = spark.createDataFrame([(1, None), (3, 5)], "id int, v int")
    assert sorted(rows(joins.rows_update(x, y, ["id"]), "id", "v")) == [(1, None), (2, 20)]
    with pytest.raises(ValueError):
        joins.rows_update(x, y.withColumn("w", F.lit(1)), ["id"])
    with pytest.raises(Exception, match="more than once"):
        joins.rows_update(x, y.union(y), ["id"]).collect()


def test_appended_rows_are_read(spark):
    from panelkit.session import scratch_dir
    from panelkit.sources import panel

    d = scratch_dir(spark, "test-append")
    spark.range(3).write.parquet(f"{d}/region.parquet")
    assert panel.table(spark, d, "region").count() == 3
    spark.range(3).write.mode("append").parquet(f"{d}/region.parquet")
    assert panel.table(spark, d, "region").count() == 6


def test_csv_keeps_line_feeds_quotes_spaces_and_missing(spark):
    data = [(1, "two\nlines"), (2, 'say "hi", x'), (3, None), (4, ""), (5, "  kept  "), (6, "a\\b"), (7, "r\r\nn")]
    back = files.csv_roundtrip(spark, spark.createDataFrame(data, "i int, t string"))
    assert sorted(rows(back, "i", "t")) == data


def test_str_remove_takes_the_first_match_only(spark):
    d = spark.createDataFrame([("abab",), ("bbb",), (None,), ("ba",)], "t string")
    assert rows(d.select(text.str_remove("t", "a").alias("t")), "t") == [("bab",), ("bbb",), (None,), ("b",)]


def test_records_strip_arrays_and_stop_at_malformed_ones(spark):
    from panelkit.session import scratch_dir
    from pyspark.sql import types as T

    meta = T.StructType([T.StructField("type", T.StringType())])
    item = T.StructType([T.StructField("attributes", meta), T.StructField("x", T.LongType())])
    sch = T.StructType([T.StructField("Id", T.LongType()), T.StructField("Items", T.ArrayType(item))])
    good = '{"Id":1,"Items":[{"attributes":{"type":"I"},"x":5}]}'
    df = spark.createDataFrame([(good,)], "r string")
    assert records.flatten_records(df, "r", sch).schema["Items"].dataType.elementType.fieldNames() == ["x"]
    bad = spark.createDataFrame([(good,), ('{"Id":',)], "r string")
    with pytest.raises(Exception):
        records.flatten_records(bad, "r", sch).collect()
    path = scratch_dir(spark, "test-corrupt")
    bad.write.text(path)
    with pytest.raises(Exception):
        records.read_records(spark, path, sch).collect()
    kept = records.read_records(spark, path, sch, corrupt="raw")
    assert sorted(map(tuple, kept.select("Id", "raw").collect()), key=str) == [(1, None), (None, '{"Id":')]


def test_scratch_needs_a_shared_folder_off_local():
    from panelkit.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_surveys_without_a_response_stay_with_missing_scores(spark):
    from paths import SMALL
    from panelkit.plans import pipeline
    from panelkit.sources import panel

    roster, resp = panel.survey_roster(spark, SMALL), panel.responses(spark, SMALL)
    scored = scales.score_scale(pipeline.survey_rows(roster, resp), panel.repair(spark, SMALL))
    assert scored.count() == roster.count()
    lone = scored.filter("response_id is null or response_id < 0")
    assert lone.count() > 0 and lone.filter("ehs_empowerment is not null").count() == 0
    joined = pipeline.join_panel(roster, resp)
    assert 0 < joined.count() < min(roster.count(), resp.count())
    hot = lambda df: df.withColumn("enrollment_id", F.when(F.col("response_id") % 3 == 0, F.lit(7)).otherwise(F.col("enrollment_id")))
    assert pipeline.join_panel(roster, hot(resp)).count() == joined.count()


def test_outcomes_take_the_primary_job(spark):
    d = spark.createDataFrame([(1, None, 40.0, 10.0), (2, 30.0, None, None)],
                              "response_id int, job_hours double, a1_job_hours double, a2_job_hours double")
    got = harmonise.primary_job(d)
    assert got.columns == ["response_id", "job_hours"]
    assert sorted(rows(got, "response_id", "job_hours")) == [(1, 40.0), (2, 30.0)]
    assert harmonise.primary_job(got) is got


def test_study_codebook_has_all_identity_options():
    from panelkit.codebook import DEFAULT_CODEBOOK

    assert len(DEFAULT_CODEBOOK.race_options) == 11
    assert DEFAULT_CODEBOOK.race_not_racialized_option == DEFAULT_CODEBOOK.race_options[9]


def test_last_wave_tag_stands_last(spark):
    from panelkit.plans import reports

    d = spark.createDataFrame([("12-month-follow-up", 2), ("exit", 3)], "survey_tag string, wave int")
    got = d.groupBy("survey_tag").agg(reports.wave_order()).orderBy("tag_order").collect()
    assert [r["survey_tag"] for r in got] == ["exit", "12-month-follow-up"]


def test_repair_items_wide_equals_long(spark):
    from paths import SMALL
    from panelkit.sources import panel

    d = panel.repair(spark, SMALL)
    d = d.union(d.limit(20))  # repeated ids share one mean
    cols = ["response_id", *scales.ITEMS]
    wide = sorted(map(tuple, scales.repair_items(d).select(*cols).collect()))
    assert wide == sorted(map(tuple, scales.pivot_repair_items(d).select(*cols).collect()))


def test_consolidate_keeps_rows_without_an_order(spark):
    d = spark.createDataFrame([(1, None, 5, 10, None), (1, 1, 4, 20, True), (2, 1, None, 30, None)],
                              "id int, version int, rid long, x int, f boolean")
    got = aggregate.consolidate(d, ["id"], ["version", "rid"])
    assert sorted(rows(got, "id", "x", "f")) == [(1, 10, True), (2, 30, None)]


def test_consolidate_takes_odd_names_and_types(spark):
    d = spark.createDataFrame([(1, 2, "b", [1], "s"), (1, 1, None, [2], "t"), (1, 3, "a", None, None)],
                              "id int, `my order` int, `x y` string, arr array<int>, st string")
    got = aggregate.consolidate(d, ["id"], ["my order"])
    assert [tuple(r) for r in got.select("id", "`x y`", "arr", "st").collect()] == [(1, "b", [2], "t")]


def test_quarter_tables_equal_the_two_stacked(spark):
    from paths import SMALL
    from panelkit.plans import pipeline, reports
    from panelkit.sources import panel

    root = pipeline.construct_root(pipeline.join_panel(panel.survey_roster(spark, SMALL), panel.responses(spark, SMALL), panel.BOOK), panel.BOOK)
    root = root.withColumn("date_of_enrollment", F.when(F.col("enrollment_id") % 10 != 0, F.col("date_of_enrollment")))
    want = joins.union_by_name([reports.quarter_demographics(root), reports.province_crosstab(root)])
    got = reports.quarter_tables(root)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert reports.quarter_tables(root.limit(0)).count() == 0


def test_distribution_of_no_rows(spark):
    from panelkit.plans import reports

    assert reports.distribution(spark.createDataFrame([("a", None)], "k string, v string"), "v").count() == 0
