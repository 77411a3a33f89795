"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator family.

Each query reads the driver's tables through the synthetic panel
(``sources.panel``) so its work grows with the tables.  Doubles that are sums
or means are rounded to 6 decimals (the oracle does the same) so that
summation order cannot change the compared value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import codebook as cb
from .functions import dates, logic, text
from .operators import aggregate, joins, reshape, schema
from .plans import fused, harmonise, pipeline, reports, scales
from .plans.study import PanelStudy
from .sources import catalog, files, landed, panel, records, snapshots

ROUND = 6


def _r(c, n: int = ROUND):
    # first to 10 digits: a sum's order must not tip a value that stands between two
    return F.round(F.round(F.col(c) if isinstance(c, str) else c, 10), n)


# --- panel building blocks ----------------------------------------------------


def _roster(spark, d):
    return panel.roster(spark, d)


def _responses(spark, d):
    return panel.responses(spark, d)


def _joined(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.join_panel(panel.survey_roster(spark, d), _responses(spark, d))


def _surveys(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.survey_rows(panel.survey_roster(spark, d), _responses(spark, d))


def _root(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.construct_root(_joined(spark, d), panel.BOOK)


def _population(spark, d):
    return reports.report_population(_root(spark, d))


def _in_population(df, spark, d):
    """Rows of participants in the report population (semi join on the
    one-row-per-participant root: no fan-out, hot ids split by AQE)."""
    return joins.semi_join(df, _population(spark, d), ["enrollment_id"])


def _hope_per_wave(spark, d):
    return pipeline.hope_per_wave(_surveys(spark, d), panel.repair(spark, d))


# --- T1 flagship & report tables --------------------------------------------------


def quarterly_table(spark, d):
    return reports.quarterly_table(_root(spark, d))


def quarterly_report(spark, d):
    """The quarterly report: participants enrolled in the report window, then T1."""
    lo, hi = cb.REPORT_WINDOW
    root = _root(spark, d).filter(dates.date_between("date_of_enrollment", lo, hi))
    return reports.quarterly_table(root)


def consolidate_baseline(spark, d):
    return _root(spark, d)


def flag_summary(spark, d):
    return reports.flag_summary(_population(spark, d))


def sample_size(spark, d):
    return reports.sample_size(_population(spark, d))


def sample_table(spark, d):
    return reports.sample_table(_population(spark, d))


def education_distribution(spark, d):
    out = reports.distribution(_population(spark, d), "educ_max_fct")
    return out.select(F.col("educ_max_fct").alias("baseline_highest_education"),
                      harmonise.education_rank(F.col("educ_max_fct")).alias("level_order"),
                      "n_total", "n", "p")


def flag_by_arm(spark, d):
    """Quarter demographics: per fiscal quarter and flag, p% (n/N) by arm."""
    return reports.quarter_demographics(_root(spark, d))


def category_crosstab(spark, d):
    """Province x arm per fiscal quarter: p% (n/N) within arm, '' where absent."""
    return reports.province_crosstab(_root(spark, d))


def quarter_demographics(spark, d):
    """The saved quarter table: flag rows over province rows, per enrolment
    fiscal quarter; flag cells NULL, province cells '' when absent."""
    return reports.quarter_tables(_root(spark, d))


def label_lookup(spark, d):
    """Satisfaction summary with labels; unlabelled variables pool into one NULL-label row."""
    satis = _in_population(pipeline.construct_satis(_responses(spark, d)), spark, d)
    return reports.satisfaction_summary(satis, cb.SATISFACTION_LABELS)


def scale_by_wave(spark, d):
    """Scale domain x wave tag: N, mean, sd of the non-missing scores (report population)."""
    h = _population_history(spark, d, "hope", "ehs", repair=True)
    g = reports.scale_summary(h, scales.DOMAINS, cb.EHS_DOMAIN_LABELS)
    return g.withColumns({"mean": _r("mean"), "sd": _r("sd")})


def scale_trend(spark, d):
    """Mean score per wave and domain (the data of a trend line)."""
    return reports.scale_trend(_hope_per_wave(spark, d), scales.DOMAINS).withColumn("avg_score", _r("avg_score"))


def effect_size(spark, d):
    h = _hope_per_wave(spark, d)
    long = reshape.unpivot(h, ["enrollment_id", "wave"], scales.DOMAINS, "ehs_domain", "score")
    es = scales.effect_size(long, "ehs_domain", "wave", "score")
    return es.select("ehs_domain", "wave", "n", *[_r(c).alias(c) for c in
                     ("score_mean", "score_sd_t", "score_sd_p", "score_delta", "score_delta_cohen")])


def _outcomes(spark, d, dedup=False):
    return pipeline.construct_outcomes(_joined(spark, d), dedup=dedup)


def _population_history(spark, d, part: str, column: str, repair: bool = False, outcomes=None):
    """One part of the history of the report population, a row per participant
    and wave: population and history come from the same pass."""
    people = fused.participants(panel.survey_roster(spark, d), _responses(spark, d), panel.repair(spark, d) if repair else None,
                                panel.BOOK, parts=[part], counts=True, outcome_columns=outcomes)
    return reshape.unnest(reports.report_population(people).select("enrollment_id", column), column)


def _population_outcomes(spark, d, outcomes):
    """Outcomes per (participant, wave) of the report population, with the responses behind each."""
    return _population_history(spark, d, "outcomes", "outcomes", outcomes=[*outcomes, "survey_tag"])


def employment_status(spark, d):
    """Per wave tag: N answering employment, Employed, Enrolled (NA skipped), NEET = 1 - E - En."""
    g = reports.employment_status(_population_outcomes(spark, d, ["job_employed", "educ_enrolled"]))
    return g.withColumns({c: _r(c) for c in ("Employed", "Enrolled", "NEET")})


def compensation(spark, d):
    """Among the employed, per wave tag: N, mean pay, benefit rates, mean benefit count."""
    g = reports.compensation(_population_outcomes(spark, d, ["job_employed", "job_annualized_salary", *cb.BENEFIT_NAMES, "job_benefits_n", "job_benefits_any"]))
    return g.withColumns({c: _r(c) for c in reports.COMPENSATION_COLUMNS if c not in ("survey_tag", "tag_order", "N")})


def value_counts(spark, d):
    """Item audit: value counts of raw answer columns (count(keys)), NULL kept as a value."""
    p = _responses(spark, d)
    return p.groupBy("version", "job_report_salary").agg(F.count(F.lit(1)).alias("n"))


def missing_rate(spark, d):
    out = reports.missing_rate(harmonise.clean_roster(_roster(spark, d)))
    return out.withColumn("start_missing", _r("start_missing"))


def id_length_audit(spark, d):
    return reports.id_length_audit(_roster(spark, d), "pas_id", "province").withColumn("mean_len", _r("mean_len"))


# --- recoding / scalar functions --------------------------------------------------------


def assignment_label(spark, d):
    r = harmonise.clean_roster(_roster(spark, d))
    return r.select("enrollment_id", "pas_id", "cohort_name", "assignment_label_fct", "program_eligible")


def recode_levels(spark, d):
    p = _responses(spark, d)
    code = text.parse_integer("education_highest")
    educ = F.when(F.col("wave") == 1, harmonise.education_level(code))
    return p.select(
        "response_id", "wave", educ.alias("educ_max_fct"),
        harmonise.education_rank(educ).alias("educ_rank"),
        (educ == cb.EDUCATION_LEVELS[1]).alias("educ_hs_lgl"),
        logic.case_when([(educ.isNull(), None), (educ.isin(cb.EDUCATION_PSE_LEVELS), True)], False)
        .alias("educ_pse_lgl"))


def classify_text(spark, d):
    p = _responses(spark, d)
    return p.select(
        "response_id",
        harmonise.gender(F.col("demo_sex"), F.col("demo_transgender"), F.col("demo_gender")).alias("demo_gender_fct"),
        harmonise.transgender_flag(F.col("demo_transgender")).alias("demo_transgender_lgl"),
        text.str_detect("job_satisfaction_overall", cb.SATISFACTION_POSITIVE_PATTERN).alias("job_satis_overall_pos"),
        text.str_detect("demo_marital", cb.MARRIED_PATTERN, negate=True).alias("not_married"))


def age_bands(spark, d):
    r = _roster(spark, d)
    dob = dates.date_from_parts("birth_year", "birth_month")
    age = dates.completed_years(dob, F.col("date_of_enrollment"))
    return r.select("enrollment_id", dob.alias("demo_date_of_birth"), age.alias("demo_age"),
                    logic.right_closed_bands(age, cb.AGE_BREAKS, cb.AGE_LABELS).alias("demo_age_fct"))


def date_parts(spark, d):
    r = _roster(spark, d)
    return r.select("enrollment_id", "birth_year", "birth_month",
                    dates.date_from_parts("birth_year", "birth_month").alias("birth_date"),
                    dates.date_from_parts("birth_year", "birth_month", 15).alias("birth_mid_month"))


def recency_flag(spark, d):
    j = _joined(spark, d)
    imm = F.col("demo_born_in_canada") == "No"
    return j.select("response_id", imm.alias("demo_immigrant_lgl"),
                    (dates.year_of("date_of_enrollment") - F.col("demo_year_of_arrival")).alias("years_since_arrival"),
                    harmonise.newcomer_flag(imm, F.col("demo_year_of_arrival"), F.col("date_of_enrollment"))
                    .alias("demo_newcomer_lgl"))


def flag_algebra(spark, d):
    h = harmonise.harmonise_baseline(_joined(spark, d), panel.BOOK)
    return h.select("response_id", "demo_income_source_fct", "demo_receiving_ei_lgl", "demo_receiving_ia_lgl",
                    logic.none_of(["demo_receiving_ei_lgl", "demo_receiving_ia_lgl"]).alias("demo_receiving_none_lgl"),
                    "demo_parent_lgl", "demo_single_parent_lgl", "demo_bipoc_lgl",
                    "demo_indigenous_lgl", "demo_racialized_lgl")


def outcome_flags(spark, d):
    o = harmonise.harmonise_outcomes(_responses(spark, d))
    return o.select("response_id", "job_employed", "job_seasonal", "job_temporary", "job_satis_overall_pos",
                    "job_satis_advance_pos", "job_satis_precarity_pos", "educ_enrolled", "neet")


def annualize_pay(spark, d):
    o = harmonise.harmonise_outcomes(_responses(spark, d))
    return o.select("response_id", "version", "job_annualized_salary")


def benefit_count(spark, d):
    """Select-all benefits from lineitem (option k = line k), counted for the employed."""
    sel = panel.selections(spark, d, prefix="benefit_")
    p = _responses(spark, d).select("response_id", text.str_detect("job_employed", "Yes").alias("job_employed"))
    j = p.join(sel, "response_id", "left")
    raw = [f"benefit_{k}" for k in range(1, 7)]
    return j.select("response_id", "job_employed", *harmonise.benefit_flags(raw, F.col("job_employed")))


def multi_select_any(spark, d):
    """Select-all from lineitem: number chosen, 'none' when nothing, flags by exclusion rules."""
    sel = panel.selections(spark, d)
    opts = schema.columns_between(sel, "opt_1", "opt_7")
    return sel.select(
        "response_id",
        logic.count_present(opts).alias("n_selected"),
        harmonise.select_all_flag(opts, "opt_2", only=False).alias("flag_excluding_2"),
        harmonise.select_all_flag(opts, "opt_7", only=True).alias("flag_unless_only_7"),
        (logic.count_present(opts) > 0).alias("any_selected"))


def parse_numbers(spark, d):
    r = _roster(spark, d)
    return r.select("enrollment_id", "acct_text",
                    text.parse_number("acct_text").alias("acct_value"),
                    text.parse_integer(F.regexp_replace("acct_text", "[$ A-Z]", "")).alias("acct_int"),
                    text.parse_integer("acct_text").alias("acct_junk_int"))


def tenure_weeks(spark, d):
    o = harmonise.harmonise_outcomes(_responses(spark, d))
    return o.select("response_id", "job_start_date", "job_tenure_months", "job_tenure_days",
                    _r("job_tenure_wks").alias("job_tenure_wks"))


def fiscal_quarter(spark, d):
    p = _responses(spark, d)
    return p.select("response_id", "response_date",
                    dates.fiscal_year("response_date", 3).alias("fy_mar"),
                    dates.fiscal_quarter("response_date", 3).alias("fq_mar"),
                    dates.fiscal_year("response_date", 4).alias("fy_apr"),
                    dates.fiscal_quarter("response_date", 4).alias("fq_apr"))


def report_window(spark, d):
    r = _roster(spark, d)
    lo, hi = cb.REPORT_WINDOW
    return r.select("enrollment_id", "date_of_enrollment",
                    dates.fiscal_year("date_of_enrollment", cb.FISCAL_START_QUARTERLY).alias("enrollment_fy"),
                    dates.fiscal_quarter("date_of_enrollment", cb.FISCAL_START_QUARTERLY).alias("enrollment_fq"),
                    dates.date_between("date_of_enrollment", lo, hi).alias("in_window"))


def fill_default(spark, d):
    p = _responses(spark, d)
    return p.select("response_id", logic.fill_default("amount", 0.0).alias("amount"),
                    logic.fill_default("status_answer", "unknown").alias("status_answer"),
                    logic.fill_default("rating", 0).alias("rating"))


def survey_catalog(spark, d):
    p = _responses(spark, d)
    counts = p.groupBy("survey_name").agg(F.count(F.lit(1)).alias("n_responses"))
    return counts.join(catalog.survey_catalog(p), "survey_name", "left")


def satisfaction_by_variable(spark, d):
    """Satisfaction summary of every variable, without labels."""
    satis = _in_population(pipeline.construct_satis(_responses(spark, d)), spark, d)
    return reports.satisfaction_summary(satis)


def read_through(spark, d):
    """Read-through: an empty fetch is a version, a forced refresh replaces it, a further load reads it back."""
    store = snapshots.scratch_dir(spark, "read-through")
    fetch = lambda: harmonise.clean_roster(panel.survey_roster(spark, d))
    snapshots.load(spark, store, lambda: fetch().limit(0))
    snapshots.load(spark, store, fetch, force=True)
    return snapshots.load(spark, store, lambda: fetch().limit(0))


def snapshot_versions(spark, d):
    """Rows by version and wave of a store whose second refresh brings fewer rows and whose third brings none."""
    store = snapshots.scratch_dir(spark, "versions")
    rows = panel.survey_roster(spark, d).select("response_id", "wave")
    wanted = [rows, rows.filter("wave <= 2"), rows.limit(0)]
    for n, part in enumerate(wanted):
        snapshots.write_snapshot(part, store, f"2025010100000{n}")
    read = [snapshots.snapshot(spark, store, s).withColumn("version", F.lit(n + 1))
            for n, s in enumerate(snapshots.snapshot_stamps(spark, store))]
    kept = joins.union_by_name(read).groupBy("version", "wave").agg(F.count(F.lit(1)).alias("n"))
    newest = snapshots.latest_snapshot(spark, store).agg(F.lit(0).alias("version"), F.lit(None).cast("int").alias("wave"), F.count(F.lit(1)).alias("n"))
    return kept.unionByName(newest)


def materialized_panel(spark, d):
    """Baseline of a study whose joined panel was written once; the second copy is the first, found again."""
    study = PanelStudy(panel.survey_roster(spark, d), _responses(spark, d), book=panel.BOOK)
    study.materialized()
    return study.materialized().root()


def colocated_panel(spark, d):
    """Baseline over roster and responses in buckets of the response id, joined without an exchange."""
    study = PanelStudy(panel.survey_roster(spark, d), _responses(spark, d), book=panel.BOOK)
    return study.colocated().root()


def accounted_join(spark, d):
    """What became of every roster row and response: joined, or left without its partner."""
    counts = Observation("join")
    joined = pipeline.join_panel(panel.survey_roster(spark, d), _responses(spark, d), panel.BOOK, counts=counts)
    by_wave = joined.groupBy("wave").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a wave; the counts come with it
    rows = [(f"joined, wave {r['wave']}", r["n"]) for r in by_wave] + sorted(counts.get.items())
    return spark.createDataFrame(rows, "what string, n long")


def median_amount(spark, d):
    """Exact median of a continuous answer per wave tag and version."""
    p = pipeline.with_survey_fields(_responses(spark, d))
    out = aggregate.median_by_group(p, ["survey_tag", "version"], "amount")
    return out.withColumn("median", _r("median"))


def landed_responses(spark, d):
    """Landed files of all surveys, each with its own columns, read in one scan:
    names cleaned, stacked by name, the survey read off the path, tagged from the landed catalogue."""
    p = _responses(spark, d).withColumn("survey", F.concat(F.lit("SV_"), F.col("wave").cast("string"), F.col("version").cast("string")))
    root = snapshots.scratch_dir(spark, "landed")
    own = {1: [F.col("job_salary_text").alias("Job Salary Text")], 2: [F.col("job_salary_num").alias("Job Salary Num")]}
    for version, columns in own.items():
        rows = p.filter(F.col("version") == version).select("survey", F.col("response_id").alias("Response Id"), *columns)
        rows.write.partitionBy("survey").parquet(f"{root}/files/v{version}")
    names = [(f"SV_{w}{v}", f"S_0.0.{v}_PANEL_s0{w}_x") for v in own for w in range(1, 6)]
    spark.createDataFrame(names, "`Survey Id` string, `Survey Name` string").write.parquet(f"{root}/catalogue")
    registry = StructType().add("Response Id", "long").add("Job Salary Text", "string").add("Job Salary Num", "double")
    rows = landed.read_landed(spark, f"{root}/files", registry, survey_pattern="survey=([^/]+)/")
    listed = StructType().add("Survey Id", "string").add("Survey Name", "string")
    surveys = schema.clean_names(spark.read.schema(listed).parquet(f"{root}/catalogue"))
    tags = surveys.select("survey_id", *[c.alias(n) for n, c in catalog.survey_fields(F.col("survey_name")).items()])
    out = rows.join(tags, "survey_id", "left")
    return out.select("response_id", "survey_id", "survey_time", "survey_version", "job_salary_text", "job_salary_num")


def unlike_records(spark, d):
    """Records of three shapes in one column, flattened without a schema."""
    flat = records.flatten_unknown(records.unlike_records(spark, d), "record", keep=["source"], sep="_")
    return flat.withColumns({"TotalPrice": F.col("TotalPrice").cast("double"), "Nation_parts": F.to_json("Nation_parts")})


def csv_crosstab(spark, d):
    """Round trip of a table with empty cells: '' stays '', not missing."""
    return files.csv_roundtrip(spark, reports.province_crosstab(_root(spark, d)), single_file=True)


def label_order(spark, d):
    """Wave-tag orders: by median response day, by first appearance (wave),
    plus codebook levels that never occur (n = 0)."""
    p = pipeline.with_survey_fields(_responses(spark, d)).withColumn("day", F.unix_date("response_date"))
    out = reports.level_order(p, "survey_tag", "day", "wave", [*panel.WAVE_TAGS, cb.LAST_WAVE_TAG])
    return out.select("survey_tag", F.col("median_day"), F.col("first_wave"), "n")


# --- schema operators --------------------------------------------------------------------


def regex_select(spark, d):
    p = _responses(spark, d)
    out = schema.select_matching(p, r"^demo_(race|indigenous)_\d$", keep=["response_id"])
    return schema.drop_matching(out, "race_7$")


def clean_names(spark, d):
    c = panel.table(spark, d, "customer").toDF("CustKey", "Customer Name", "nationKey", "acct.Bal", "MKT-Segment")
    return schema.clean_names(c)


def drop_all_null(spark, d):
    """The roster without the columns its source never fills (data-dependent schema)."""
    return schema.drop_all_null(_roster(spark, d))


def primary_record(spark, d):
    """Wide multi-job record (a1_ .. a7_ = line 1..7) -> primary job only."""
    li = panel.table(spark, d, "lineitem")
    wide = li.groupBy(F.col("l_orderkey").alias("response_id")).agg(*[
        agg for k in range(1, 8) for agg in (
            F.max(F.when(F.col("l_linenumber") == k, F.col("l_quantity"))).alias(f"a{k}_job_qty"),
            F.max(F.when(F.col("l_linenumber") == k, F.col("l_returnflag"))).alias(f"a{k}_job_flag"))])
    return schema.rename_matching(schema.drop_matching(wide, "^a[2-9]_"), "^a1_", "")


# --- sources ------------------------------------------------------------------------------


def flatten_records(spark, d):
    return records.order_records_roundtrip(spark, d)


def json_access(spark, d):
    e = panel.table(spark, d, "events")
    return e.select("event_id", records.json_int("props", "$.k").alias("k"))


def relationship_extract(spark, d):
    return records.relationship_extract(spark, d, segments=["BUILDING", "MACHINERY", "HOUSEHOLD"])


def latest_snapshot(spark, d):
    p = _responses(spark, d).withColumn("snapshot", F.year("response_date"))
    return snapshots.latest_per_object(p, "survey_name", "snapshot").select("response_id", "survey_name", "snapshot")


def drop_last_rows(spark, d):
    p = _responses(spark, d).select("response_id", "enrollment_id", "wave")
    return files.drop_last(p, "wave", 2, ties=["response_id"])


def snapshot_roundtrip(spark, d):
    return snapshots.roundtrip(spark, harmonise.clean_roster(_roster(spark, d)))


def csv_roundtrip(spark, d):
    return files.csv_roundtrip(spark, reports.quarterly_table(_root(spark, d)), single_file=True)


# --- joins and stacking ------------------------------------------------------------------------


def left_join_suffix(spark, d):
    r = panel.survey_roster(spark, d).select("response_id", "qx_survey_id", "enrollment_id", "cohort_name")
    p = _responses(spark, d).select("response_id", "enrollment_id", "demo_province")
    return joins.left_join_suffix(r, p, ["response_id"], ("_sf", "_qx"))


def semi_join(spark, d):
    p = _responses(spark, d)
    p = p.select("response_id", "enrollment_id",
                 dates.fiscal_year("response_date", 4).alias("fy"), dates.fiscal_quarter("response_date", 4).alias("fq"))
    r = harmonise.clean_roster(_roster(spark, d)).filter(F.col("assignment_label_fct") != cb.ARM_DEFAULT)
    return joins.semi_join(p, r, ["enrollment_id"])


def rows_update(spark, d):
    p = _responses(spark, d).select("response_id", *[F.col(c).cast("double").alias(c) for c in scales.ITEMS])
    upd = joins.rows_update(p, scales.repair_items(panel.repair(spark, d)), ["response_id"])
    return upd.select("response_id", *[_r(c).alias(c) for c in scales.ITEMS])


def full_join_waves(spark, d):
    return pipeline.construct_satis(_responses(spark, d), method="full_join")


def union_by_name(spark, d):
    p = _responses(spark, d)
    v1 = p.filter(F.col("version") == 1).select("response_id", "wave", "demo_parent", "job_salary_text",
                                                  F.col("rating").alias("code"))
    v2 = p.filter(F.col("version") == 2).select("response_id", "wave", "demo_caregiver", "job_salary_num",
                                                  F.col("status_answer").alias("code"))
    return joins.union_by_name([v1, v2])


def split_dispatch(spark, d):
    """Per-version branch of the pay rules (each branch sees its own columns), stacked."""
    p = _responses(spark, d)

    def v1(df):
        return df.select("response_id", "version", "job_salary_text",
                         harmonise.annualized_salary(F.lit(1)).alias("job_annualized_salary"))

    def v2(df):
        return df.select("response_id", "version", "job_report_salary",
                         harmonise.annualized_salary(F.lit(2)).alias("job_annualized_salary"))

    return pipeline.dispatch(p, ["version"], {(1,): v1, (2,): v2})


def fill_within_group(spark, d):
    o = _outcomes(spark, d)
    return o.withColumn("job_tenure_wks", _r("job_tenure_wks")).withColumn(
        "job_annualized_salary", _r("job_annualized_salary"))


def nest_history(spark, d):
    nested = pipeline.construct_hope(_surveys(spark, d), panel.repair(spark, d))
    return nested.select(
        "enrollment_id", F.size("ehs").alias("n_waves"),
        F.array_join(F.transform("ehs", lambda x: x["wave"].cast("string")), ",").alias("waves"),
        _r(F.col("ehs")[0]["ehs_empowerment"]).alias("first_empowerment"))


def unnest_history(spark, d):
    nested = pipeline.construct_hope(_surveys(spark, d), panel.repair(spark, d))
    h = reshape.unnest(nested, "ehs")
    return h.select("enrollment_id", "wave", "survey_tag", *[_r(c).alias(c) for c in scales.DOMAINS])


def assemble_participant(spark, d):
    """The whole participant table, from one pass over roster and responses."""
    a = fused.participants(panel.survey_roster(spark, d), _responses(spark, d), panel.repair(spark, d), panel.BOOK)
    return a.select("enrollment_id", "assignment_label_fct", "demo_age",
                    F.size("ehs").alias("n_ehs"), F.size("outcomes").alias("n_outcomes"),
                    "satis_inmotion_overall", "satis_m_plus_overall")


# --- scales ----------------------------------------------------------------------------------------


def unpivot_items(spark, d):
    long = scales.repair_long(panel.repair(spark, d))
    return long.select("response_id", "ehs_item", F.col("option").cast("int").alias("option"),
                       "ehs_item_response")


def pivot_items(spark, d):
    w = scales.pivot_repair_items(panel.repair(spark, d))
    return w.select("response_id", *[_r(c).alias(c) for c in scales.ITEMS])


def score_scale(spark, d):
    s = scales.score_scale(_surveys(spark, d), panel.repair(spark, d))
    return s.select("enrollment_id", "response_id", "wave", "version", *[_r(c).alias(c) for c in scales.DOMAINS])


def top_box(spark, d):
    return scales.satisfaction_top_box_waves(_responses(spark, d), pipeline.SATIS_RAW)


QUERIES = {name: fn for name, fn in [
    ("quarterly_table", quarterly_table),
    ("quarterly_report", quarterly_report),
    ("flag_summary", flag_summary),
    ("flag_by_arm", flag_by_arm),
    ("category_crosstab", category_crosstab),
    ("quarter_demographics", quarter_demographics),
    ("sample_table", sample_table),
    ("sample_size", sample_size),
    ("education_distribution", education_distribution),
    ("recode_levels", recode_levels),
    ("assignment_label", assignment_label),
    ("classify_text", classify_text),
    ("age_bands", age_bands),
    ("recency_flag", recency_flag),
    ("multi_select_any", multi_select_any),
    ("benefit_count", benefit_count),
    ("flag_algebra", flag_algebra),
    ("outcome_flags", outcome_flags),
    ("annualize_pay", annualize_pay),
    ("parse_numbers", parse_numbers),
    ("date_parts", date_parts),
    ("tenure_weeks", tenure_weeks),
    ("fiscal_quarter", fiscal_quarter),
    ("report_window", report_window),
    ("survey_catalog", survey_catalog),
    ("label_lookup", label_lookup),
    ("satisfaction_by_variable", satisfaction_by_variable),
    ("read_through", read_through),
    ("snapshot_versions", snapshot_versions),
    ("materialized_panel", materialized_panel),
    ("colocated_panel", colocated_panel),
    ("accounted_join", accounted_join),
    ("median_amount", median_amount),
    ("landed_responses", landed_responses),
    ("csv_crosstab", csv_crosstab),
    ("label_order", label_order),
    ("fill_default", fill_default),
    ("id_length_audit", id_length_audit),
    ("regex_select", regex_select),
    ("clean_names", clean_names),
    ("drop_all_null", drop_all_null),
    ("primary_record", primary_record),
    ("flatten_records", flatten_records),
    ("unlike_records", unlike_records),
    ("json_access", json_access),
    ("relationship_extract", relationship_extract),
    ("left_join_suffix", left_join_suffix),
    ("semi_join", semi_join),
    ("rows_update", rows_update),
    ("full_join_waves", full_join_waves),
    ("assemble_participant", assemble_participant),
    ("union_by_name", union_by_name),
    ("split_dispatch", split_dispatch),
    ("consolidate_baseline", consolidate_baseline),
    ("fill_within_group", fill_within_group),
    ("nest_history", nest_history),
    ("unnest_history", unnest_history),
    ("unpivot_items", unpivot_items),
    ("pivot_items", pivot_items),
    ("score_scale", score_scale),
    ("top_box", top_box),
    ("scale_by_wave", scale_by_wave),
    ("scale_trend", scale_trend),
    ("effect_size", effect_size),
    ("employment_status", employment_status),
    ("compensation", compensation),
    ("missing_rate", missing_rate),
    ("value_counts", value_counts),
    ("latest_snapshot", latest_snapshot),
    ("drop_last_rows", drop_last_rows),
    ("snapshot_roundtrip", snapshot_roundtrip),
    ("csv_roundtrip", csv_roundtrip),
]}
