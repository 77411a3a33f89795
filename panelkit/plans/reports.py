"""Report tables over the participant-level table.

Every table here ends in at most a few dozen rows; the work before that is a
single aggregate (partial + final) over the participant table.  Nothing is
collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codebook as cb
from ..functions import logic
from ..functions.formatting import pct_cell
from ..functions.sqltext import ident as q
from ..functions.sqltext import string_lit as lit


def report_flags(root: DataFrame, older_than: int = 64) -> DataFrame:
    """Derived report flags next to the consolidated ones (strict NULL rules)."""
    out = root.withColumns({
        "demo_born_in_canada_lgl": ~F.col("demo_immigrant_lgl"),
        "demo_woman_plus_lgl": (F.col("demo_gender_fct") != "Man") | F.col("demo_transgender_lgl"),
        "demo_receiving_none_lgl": logic.none_of(["demo_receiving_ei_lgl", "demo_receiving_ia_lgl"]),
        "demo_young_lgl": F.col("demo_age") < 30,
        "demo_old_lgl": F.col("demo_age") > older_than,
    })
    out = out.withColumn("demo_middle_age_lgl", logic.none_of(["demo_young_lgl", "demo_old_lgl"]))
    return out.withColumn("demo_mf_none_lgl", logic.none_of(cb.MARGINALIZATION_FLAGS))


def flag_cells(df: DataFrame, flags: Sequence[str], group_col: str | None,
               levels: Sequence[str], total_label: str | None = cb.TOTAL_LABEL) -> DataFrame:
    """Per flag and group level: n (TRUE), N (non-missing) -- one global aggregate.

    This is the pivoted form of ``unpivot -> filter(val is not null) ->
    group by (level, var) with a Total grouping set``: conditional counts put
    every (flag, level) cell in one row, so the participant table is read
    once, combined map-side, and only one partial row per task is shuffled.
    Output: one row per flag with ``var``, ``yes_<level>`` (n), ``all_<level>`` (N).
    """
    groups = [(lvl, f"{q(group_col)} = {lit(lvl)}") for lvl in levels] if group_col else []
    if total_label is not None:
        groups.append((total_label, "true"))
    aggs = []
    for f in flags:
        for lvl, cond in groups:
            val = f"CASE WHEN {cond} THEN {q(f)} END"
            aggs.append(f"count_if({val}) AS {q(f + '|yes|' + lvl)}")
            aggs.append(f"count({val}) AS {q(f + '|all|' + lvl)}")
    # Generated as SQL text: one JVM parse instead of ~1000 driver round trips.
    wide = df.selectExpr(*aggs)
    structs = []
    for i, f in enumerate(flags):
        fields = [f"'var', {lit(f)}", f"'var_order', {i}"]
        fields += [f"'{s}_{lvl}', {q(f + '|' + s + '|' + lvl)}" for lvl, _ in groups for s in ("yes", "all")]
        structs.append(f"named_struct({', '.join(fields)})")
    return wide.selectExpr(f"inline(array({', '.join(structs)}))")


def quarterly_table(root: DataFrame, levels: Sequence[str] = tuple(cb.ARM_LEVELS),
                    labels: Sequence[tuple[str, str]] = tuple(cb.QUARTERLY_LABELS),
                    group_col: str = "assignment_label_fct") -> DataFrame:
    """The quarterly demographics table: one row per flag, ``p% (n/N)`` per arm + Total.

    Columns: ``cat``, ``var`` (label text after the first ``--``), one column
    per arm level, ``Total``.  A flag that is missing for everybody has no row;
    an arm with no answer for a flag has a NULL cell.
    """
    flags = [f for f, _ in labels]
    cells = flag_cells(report_flags(root), flags, group_col, levels)
    lab = logic.lookup("var", dict(labels))
    parts = F.split(lab, "--", 2)
    cols = [F.try_element_at(parts, F.lit(1)).alias("cat"), F.try_element_at(parts, F.lit(2)).alias("var")]
    for lvl in [*levels, cb.TOTAL_LABEL]:
        cols.append(pct_cell(F.col(f"yes_{lvl}"), F.col(f"all_{lvl}")).alias(lvl))
    return cells.filter(F.col(f"all_{cb.TOTAL_LABEL}") > 0).select(*cols)


# --- T0: report population ----------------------------------------------------


def report_population(root: DataFrame, province: str = cb.HOME_PROVINCE,
                      excluded_arm: str = cb.REPORT_EXCLUDED_ARM) -> DataFrame:
    """Participants of one province report (comparison arm excluded)."""
    return root.filter((F.col("demo_province_fct") == province)
                       & (F.col("assignment_label_fct") != excluded_arm))


def sample_size(pop: DataFrame) -> DataFrame:
    return pop.agg(F.count(F.lit(1)).alias("n"))


# --- T4: flag summary (var, N, n, p) -----------------------------------------------


def flag_summary(pop: DataFrame, labels: Sequence[tuple[str, str]] = tuple(cb.QUARTERLY_LABELS)) -> DataFrame:
    """cat, var, n_total (non-missing), n (TRUE), p -- one global aggregate."""
    flags = [f for f, _ in labels]
    cells = flag_cells(report_flags(pop), flags, None, [], total_label=cb.TOTAL_LABEL)
    cat, var = F.split(logic.lookup("var", dict(labels)), "--", 2), None
    return cells.filter(F.col(f"all_{cb.TOTAL_LABEL}") > 0).select(
        F.try_element_at(cat, F.lit(1)).alias("cat"), F.try_element_at(cat, F.lit(2)).alias("var"),
        # order of first appearance (position in the unpivoted column list)
        (F.col("var_order") + 1).alias("var_order"),
        F.col(f"all_{cb.TOTAL_LABEL}").alias("n_total"), F.col(f"yes_{cb.TOTAL_LABEL}").alias("n"),
        (F.col(f"yes_{cb.TOTAL_LABEL}") / F.col(f"all_{cb.TOTAL_LABEL}")).alias("p"))


# --- T5: distribution with share of total -------------------------------------------


def distribution(pop: DataFrame, col: str, label: str | None = None) -> DataFrame:
    """Counts of the non-missing levels of ``col`` with N = overall total and p.

    The total is that of the counted levels, which fit into one row: the
    participants are read once.
    """
    counts = pop.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.agg(F.sum("n").alias("n_total"), F.collect_list(F.struct(col, "n")).alias("levels"))
    out = rows.select(F.inline("levels"), "n_total").withColumn("p", F.col("n") / F.col("n_total"))
    out = out.select(col, "n", "n_total", "p")
    return out.withColumnRenamed(col, label) if label else out


# --- T3: sample table -----------------------------------------------------------------


def sample_table(pop: DataFrame, row: str = "cohort_name", col: str = "assignment_label_fct",
                 levels: Sequence[str] = ("Program", "Non-RCT")) -> DataFrame:
    """Counts row x level pivoted on explicit levels, a per-row Total and a
    grand-total row: one aggregate with a grouping set for the whole.
    ``first_enrolled`` (NULL for the grand total, which stands last) orders the
    rows by date.  A level without participants is NULL; without any there are no rows."""
    whole = F.grouping(row)
    g = pop.rollup(row).agg(
        whole.alias("__whole"), *[F.nullif(F.count_if(F.col(col) == lv), F.lit(0).cast("long")).alias(lv) for lv in levels],
        F.count(F.lit(1)).alias(cb.TOTAL_LABEL), F.min("date_of_enrollment").alias("first_enrolled"))
    total = F.col("__whole") == 1
    return g.select(F.when(total, F.lit(cb.TOTAL_LABEL)).otherwise(F.col(row)).alias(row), *levels, cb.TOTAL_LABEL,
                    F.when(~total, F.col("first_enrolled")).alias("first_enrolled"))


# --- T2: quarter demographics -----------------------------------------------------


def with_fiscal_quarter(df: DataFrame, date_col: str, fiscal_start: int,
                        prefix: str = "enrollment") -> DataFrame:
    from ..functions import dates

    return df.withColumns({
        f"{prefix}_fy": dates.fiscal_year(date_col, fiscal_start),
        f"{prefix}_fq": dates.fiscal_quarter(date_col, fiscal_start),
    })


def wide_counts(df: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """(keys, var, N_all, n_yes) of boolean columns with any answer: aggregated
    wide in one pass, then turned long, so that rows are never multiplied."""
    g = df.groupBy(*keys).agg(*[a for f in flags for a in (F.count(f).alias(f"__n_{f}"), F.count_if(f).alias(f"__y_{f}"))])
    cells = F.array(*[F.struct(F.lit(f).alias("var"), F.col(f"__n_{f}").alias("N_all"), F.col(f"__y_{f}").alias("n_yes")) for f in flags])
    return g.select(*keys, F.inline(cells)).filter("N_all > 0")


def _quarter_flags(root: DataFrame, fiscal_start: int) -> DataFrame:
    """Report flags and enrolment quarter of every participant (older = 65+)."""
    df = with_fiscal_quarter(report_flags(root), "date_of_enrollment", fiscal_start)
    return df.withColumns({
        "demo_born_in_canada": ~F.col("demo_immigrant_lgl"),
        "demo_old_lgl": F.col("demo_age") >= 65,
    })


def quarter_demographics(root: DataFrame, fiscal_start: int = cb.FISCAL_START_DEMOGRAPHICS,
                         labels: Sequence[tuple[str, str]] = tuple(cb.QUARTER_DEMO_LABELS),
                         levels: Sequence[str] = tuple(cb.ARM_LEVELS)) -> DataFrame:
    """Per enrolment fiscal quarter and flag: ``p% (n/N)`` per arm (older = 65+)."""
    from ..operators import reshape

    df = _quarter_flags(root, fiscal_start)
    keys = ["enrollment_fy", "enrollment_fq"]
    g = wide_counts(df, [*keys, "assignment_label_fct"], [f for f, _ in labels])
    g = g.withColumns({"pct_n": pct_cell(F.col("n_yes"), F.col("N_all")),
                       "lab": logic.lookup("var", dict(labels))})
    return reshape.pivot_cells(g, [*keys, "lab"], "assignment_label_fct", list(levels), "pct_n")


def quarter_tables(root: DataFrame, fiscal_start: int = cb.FISCAL_START_DEMOGRAPHICS,
                   labels: Sequence[tuple[str, str]] = tuple(cb.QUARTER_DEMO_LABELS),
                   levels: Sequence[str] = tuple(cb.ARM_LEVELS)) -> DataFrame:
    """The rows of :func:`quarter_demographics` over those of :func:`province_crosstab`, from one pass.

    Participants are counted once per (quarter, arm, province), with all flags
    beside the count.  These few cells hold both tables: a flag's counts are
    summed over the provinces, a province's are shares of its arm.  The cells
    are exchanged once, by quarter, for sums, shares and pivot together.
    """
    from pyspark.sql import Window

    from ..operators import reshape

    keys, arm = ["enrollment_fy", "enrollment_fq"], "assignment_label_fct"
    flags = [f for f, _ in labels]
    cells = _quarter_flags(root, fiscal_start).groupBy(*keys, arm, "demo_province_fct").agg(
        F.count(F.lit(1)).alias("n"), *[a for f in flags for a in (F.count(f).alias(f"n_{f}"), F.count_if(f).alias(f"y_{f}"))])
    entry = lambda kind, lab, n, all_: F.struct(F.lit(kind).alias("kind"), lab.alias("lab"), n.alias("n_yes"), all_.alias("n_all"))
    rows = F.array(*[entry("flag", F.lit(lab), F.col(f"y_{f}"), F.col(f"n_{f}")) for f, lab in labels],
                   entry("province", F.col("demo_province_fct"), F.col("n"), F.col("n")))
    long = cells.repartition(*keys).select(*keys, arm, F.inline(rows)).filter("n_all > 0 AND lab IS NOT NULL")
    g = long.groupBy(*keys, arm, "kind", "lab").agg(F.sum("n_yes").alias("n_yes"), F.sum("n_all").alias("n_all"))
    in_arm = F.sum("n_all").over(Window.partitionBy(*keys, arm, "kind"))
    g = g.withColumn("pct_n", pct_cell(F.col("n_yes"), F.when(F.col("kind") == "flag", F.col("n_all")).otherwise(in_arm)))
    wide = reshape.pivot_cells(g, [*keys, "kind", "lab"], arm, list(levels), "pct_n")
    blank = lambda lv: F.when(F.col("kind") == "province", F.coalesce(F.col(lv), F.lit(""))).otherwise(F.col(lv)).alias(lv)
    return wide.select(*keys, "lab", *[blank(lv) for lv in levels])


def province_crosstab(root: DataFrame, fiscal_start: int = cb.FISCAL_START_DEMOGRAPHICS,
                      levels: Sequence[str] = tuple(cb.ARM_LEVELS)) -> DataFrame:
    """Province x arm per fiscal quarter: ``p% (n/N)`` within the arm, '' where absent."""
    from ..operators import reshape
    from ..operators.aggregate import group_share

    df = with_fiscal_quarter(root, "date_of_enrollment", fiscal_start).filter(
        F.col("demo_province_fct").isNotNull())
    keys = ["enrollment_fy", "enrollment_fq"]
    g = df.groupBy(*keys, F.col("demo_province_fct").alias("lab"), "assignment_label_fct").agg(
        F.count(F.lit(1)).alias("n"))
    g = group_share(g, [*keys, "assignment_label_fct"], "n", "n_arm")
    g = g.withColumn("pct_n", pct_cell(F.col("n"), F.col("n_arm")))
    return reshape.pivot_cells(g, [*keys, "lab"], "assignment_label_fct", list(levels), "pct_n", fill="")


# --- T6-T9, T11, T12, T14 ------------------------------------------------------------------


def satisfaction_summary(satis: DataFrame, labels: dict | None = None) -> DataFrame:
    """Share of positive answers per label; unlabelled variables pool into a NULL label."""
    counts = wide_counts(satis, [], [c for c in satis.columns if c.startswith("satis_")])
    lab = logic.lookup("var", labels) if labels is not None else F.col("var")
    return counts.groupBy(lab.alias("lab")).agg(F.sum("N_all").alias("n_total"), F.sum("n_yes").alias("n")).withColumn(
        "p", F.col("n") / F.col("n_total"))


def scale_summary(hope: DataFrame, domains: Sequence[str], labels: dict | None = None) -> DataFrame:
    """Per domain x wave tag: N, mean and sample sd of the non-missing scores;
    ``tag_order`` (the wave) orders the tags."""
    g = hope.groupBy("survey_tag").agg(*[a.alias(f"__{n}_{d}") for d in domains for n, a in (
        ("N", F.count(d)), ("mean", F.avg(d)), ("sd", F.stddev_samp(d)), ("tag_order", F.min(F.when(F.col(d).isNotNull(), F.col("wave")))))])
    cells = F.array(*[F.struct(F.lit(d).alias("var"), *[F.col(f"__{n}_{d}").alias(n) for n in ("N", "mean", "sd", "tag_order")])
                      for d in domains])
    g = g.select("survey_tag", F.inline(cells)).filter("N > 0")
    lab = logic.lookup("var", labels) if labels is not None else F.col("var")
    return g.select(lab.alias("lab"), "survey_tag", "tag_order", "N", "mean", "sd")


def scale_trend(hope: DataFrame, domains: Sequence[str]) -> DataFrame:
    """Mean score per wave and domain (the data of a trend chart)."""
    from ..operators import reshape

    g = hope.groupBy("wave", "survey_tag").agg(*[F.avg(c).alias(c) for c in domains])
    return reshape.unpivot(g, ["wave", "survey_tag"], list(domains), "ehs_domain", "avg_score")


def _weighted_mean(c: str) -> Column:
    """Mean of ``c`` over the responses behind each (participant, wave) row; missing skipped."""
    value = F.col(c).cast("int").cast("double") if c in _FLAGS else F.col(c).cast("double")
    known = F.when(F.col(c).isNotNull(), F.col("n_rows"))
    return F.try_divide(F.sum(value * F.col("n_rows")), F.sum(known))


_FLAGS = {"job_employed", "educ_enrolled", *cb.BENEFIT_NAMES, "job_benefits_any"}


def wave_order(tag: str = "survey_tag", wave: str = "wave") -> Column:
    """Aggregate: place of a wave tag in a table, the last tag after all waves."""
    return F.when(F.first(F.col(tag)) == cb.LAST_WAVE_TAG, F.lit(1000)).otherwise(F.min(wave)).cast("int").alias("tag_order")


def employment_status(outcomes: DataFrame) -> DataFrame:
    """Per wave tag: N answering employment, Employed, Enrolled (missing
    skipped), NEET = 1 - Employed - Enrolled (aggregate formula, can be < 0).
    Input: ``pipeline.outcomes_per_wave``; ``tag_order`` orders the tags."""
    o = outcomes.filter(F.col("job_employed").isNotNull())
    g = o.groupBy("survey_tag").agg(
        wave_order(), F.sum("n_rows").alias("N"),
        _weighted_mean("job_employed").alias("Employed"), _weighted_mean("educ_enrolled").alias("Enrolled"))
    return g.withColumn("NEET", 1 - F.col("Employed") - F.col("Enrolled"))


COMPENSATION_COLUMNS = ["survey_tag", "tag_order", "N", "annualized_salary", "_health", "_dental", "_disability",
                        "_pension", "_vacation", "_any", "_total"]


def compensation(outcomes: DataFrame) -> DataFrame:
    """Among the employed, per wave tag: N, mean pay, benefit rates and mean
    benefit count; names lose their ``job_benefits``/``job_`` prefix.
    Input: ``pipeline.outcomes_per_wave``; ``tag_order`` orders the tags."""
    from ..operators import schema

    o = outcomes.filter(logic.in_set("job_employed", [True]))
    cols = schema.matching(o, "^job_benefits|^job_annualized_salary")
    g = o.groupBy("survey_tag").agg(wave_order(), F.sum("n_rows").alias("N"), *[_weighted_mean(c).alias(c) for c in cols])
    g = schema.rename_matching(g, "job_benefits|job_", "")
    return g.withColumnRenamed("_n", "_total").select(*COMPENSATION_COLUMNS)


def missing_rate(roster: DataFrame, group: str = "cohort_name", col: str = "cohort_start_date") -> DataFrame:
    """Share of missing ``col`` per group, largest first."""
    return roster.groupBy(group).agg(
        F.avg(F.col(col).isNull().cast("int")).alias("start_missing")).orderBy(F.desc("start_missing"))


def id_length_audit(df: DataFrame, id_col: str, group: str, keep: int = 15) -> DataFrame:
    """Non-empty ids per group: count, mean and max length, max length kept after truncation."""
    from ..functions import text

    r = df.filter(F.col(id_col).isNotNull() & (text.nchar(id_col) > 0))
    return r.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(text.nchar(id_col)).alias("mean_len"),
        F.max(text.nchar(id_col)).alias("max_len"),
        F.max(text.nchar(text.str_sub(id_col, 1, keep))).alias("max_len_kept"))


# --- O3-O5: level orders -------------------------------------------------------------


def level_order(df: DataFrame, label: str, time_col: str, first_col: str,
                levels: Sequence[str] = ()) -> DataFrame:
    """Per label: exact median of ``time_col`` (order by a statistic), minimum of
    ``first_col`` (order of first appearance) and the row count; codebook
    ``levels`` that never occur are added with n = 0 (an expanded factor)."""
    from ..operators.aggregate import median_by_group

    g = df.groupBy(label).agg(F.min(first_col).alias("first_" + first_col), F.count(F.lit(1)).alias("n"))
    g = g.join(median_by_group(df, [label], time_col, "median_" + time_col), label, "left")
    if levels:
        spark = df.sparkSession
        lv = spark.createDataFrame([(x,) for x in levels], f"{label} string")
        g = lv.join(g, label, "full")
    return g.withColumn("n", F.coalesce("n", F.lit(0)))
