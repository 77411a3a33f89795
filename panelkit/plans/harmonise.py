"""Harmonisers: raw questionnaire answers of any (wave, version) -> common variables.

The original runs one function per survey table.  Here every rule is a Column
expression that branches on the row's ``wave``/``version`` columns, so all
surveys are harmonised in ONE projection over one scan (no per-survey
branches, no union of many plans).  ``plans.pipeline.dispatch`` still offers
the per-(wave, version) form for schemas that genuinely differ.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codebook as cb
from ..codebook import DEFAULT_CODEBOOK, Codebook
from ..functions import dates, logic, text

def cached_columns(fn):
    """Memoise a builder of Column lists per codebook.

    Columns are immutable, unresolved expression trees (not bound to any
    DataFrame), so one list serves every query; building them costs one driver
    round trip per node, which this avoids on repeated plans.
    """
    cache: dict = {}

    def wrapper(book: Codebook, *args):
        from pyspark import SparkContext

        # Columns belong to one JVM gateway (classic) or are client-side
        # (Spark Connect): never hand one kind to the other.
        key = (repr(book), args, id(getattr(SparkContext, "_gateway", None)),
               os.environ.get("SPARK_CONNECT_MODE_ENABLED"))
        if key not in cache:
            cache[key] = fn(book, *args)
        return cache[key]

    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


# ---------------------------------------------------------------------------
# Roster (H1)
# ---------------------------------------------------------------------------


def arm_label(cohort_name: Column) -> Column:
    """Arm from the cohort-name suffix: Program / Comparison, none -> Non-RCT."""
    return F.coalesce(text.str_extract(F.trim(cohort_name), cb.ARM_SUFFIX_PATTERN),
                      F.lit(cb.ARM_DEFAULT))


def clean_roster(roster: DataFrame, book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """Roster -> assignment label, cohort name without the suffix, truncated ids.

    The suffix is detected and removed on the trimmed name (decision D9).
    """
    trimmed = F.trim(F.col("cohort_name"))
    out = roster.withColumns({
        "assignment_label_fct": arm_label(F.col("cohort_name")),
        "cohort_name": text.str_remove(trimmed, cb.ARM_SUFFIX_REMOVE_PATTERN),
    })
    out = out.withColumn("program_eligible",
                         logic.in_set("assignment_label_fct", book.eligible_arms))
    if "pas_id" in roster.columns:
        out = out.withColumn("pas_id", text.str_sub("pas_id", 1, 15))
    return out


# ---------------------------------------------------------------------------
# Baseline demographics (H0, H2-H10)
# ---------------------------------------------------------------------------


def education_level(code: Column) -> Column:
    """Highest-education code -> ordered label (1, 2, <=5, 6, 7)."""
    L = cb.EDUCATION_LEVELS
    return logic.case_when([
        (code == 1, L[0]), (code == 2, L[1]), (code <= 5, L[2]), (code == 6, L[3]), (code == 7, L[4]),
    ])


def education_rank(label: Column) -> Column:
    """Codebook ordinal of an education label (for ordering)."""
    return logic.lookup(label, {lab: i + 1 for i, lab in enumerate(cb.EDUCATION_LEVELS)})


def gender(sex: Column, trans: Column, gender_text: Column) -> Column:
    return logic.case_when([
        ((sex == "Male") & (trans == "No"), "Man"),
        ((sex == "Female") & (trans == "No"), "Woman"),
        (gender_text.rlike(cb.GENDER_MAN_PATTERN), "Man"),
        (gender_text.rlike(cb.GENDER_WOMAN_PATTERN), "Woman"),
        (gender_text.isNull(), None),
    ], "Other")


def transgender_flag(trans: Column) -> Column:
    return logic.case_when([
        (trans.isNull(), None),
        (trans == "Prefer not to answer", None),
        (trans == "No", False),
    ], True)


def newcomer_flag(immigrant: Column, arrival_year: Column, enrolled: Column,
                  years: int = cb.NEWCOMER_YEARS) -> Column:
    return logic.case_when([
        (immigrant.isNull(), None),
        (arrival_year.isNull(), None),
        (F.year(enrolled) - arrival_year <= years, True),
    ], False)


def select_all_flag(options: list[str], no_option: str, *, only: bool) -> Column:
    """Flag from a select-all question (NULL = option not chosen).

    Nothing chosen -> NULL.  ``only=False``: FALSE when ``no_option`` is chosen
    at all.  ``only=True``: FALSE when it is the only option chosen.
    """
    n = logic.count_present(options)
    no = F.col(no_option).isNotNull()
    false_when = (no & (n == 1)) if only else no
    return logic.case_when([(n == 0, None), (false_when, False)], True)


BASELINE_KEYS = ["enrollment_id", "cohort_name", "date_of_enrollment", "demo_age", "demo_date_of_birth"]


def harmonise_baseline(df: DataFrame, book: Codebook = DEFAULT_CODEBOOK,
                       keep: tuple[str, ...] = ("wave", "version", "response_id")) -> DataFrame:
    """Baseline variables for every response of every (wave, version), one projection.

    Input: responses joined to the cleaned roster.  Rows without a response are
    dropped; non-intake rows are kept only where the re-ask flag is the string
    ``"FALSE"``.  Intake-only education variables are NULL on later waves.
    """
    w = F.col(book.wave_col)
    rows = df.filter(F.col(book.response_col).isNotNull()).filter((w == 1) | (F.col("demos") == "FALSE"))
    return rows.select(*_baseline_columns(book, tuple(keep)))


def baseline_answers(book: Codebook) -> dict[str, Column]:
    """Baseline variables that need the response alone, by name."""
    w, v = F.col(book.wave_col), F.col(book.version_col)
    intake = w == 1
    educ = education_level(text.parse_integer("education_highest"))
    income = logic.case_when([
        (F.col("demo_province").isNull(), None),
        (F.col("income_source").isNull(), cb.INCOME_NONE),
    ], F.col("income_source"))
    ei = income == cb.INCOME_EI
    indigenous = F.when(v == 1, F.col("demo_indigenous") == "Yes").otherwise(
        select_all_flag(list(book.indigenous_options), book.indigenous_no_option, only=False))
    racialized = F.when(v == 1, F.col("demo_racialized") == "Yes").otherwise(
        select_all_flag(list(book.race_options), book.race_not_racialized_option, only=True))
    parent = (F.col("demo_children") == "Yes") & F.when(
        v == 1, F.col("demo_parent") == "Yes").otherwise(F.col("demo_caregiver") == "Yes")
    return {
        "demo_date_of_birth": dates.date_from_parts("demo_dob_year", "demo_dob_month"),
        "educ_max_fct": F.when(intake, educ),
        "demo_gender_fct": gender(F.col("demo_sex"), F.col("demo_transgender"), F.col("demo_gender")),
        "demo_province_fct": F.col("demo_province"),
        "income_source_fct": F.col("income_source"),
        "demo_income_source_fct": income,
        "educ_domestic_lgl": F.when(intake, F.col("education_domestic") == cb.EDUCATION_DOMESTIC_ANSWER),
        "educ_hs_lgl": F.when(intake, educ == cb.EDUCATION_LEVELS[1]),
        "educ_pse_lgl": F.when(intake, logic.case_when([(educ.isNull(), None),
                                                        (educ.isin(cb.EDUCATION_PSE_LEVELS), True)], False)),
        "demo_transgender_lgl": transgender_flag(F.col("demo_transgender")),
        "demo_in_sk_lgl": F.col("demo_province") == book.home_province,
        "demo_receiving_ei_lgl": ei,
        "demo_receiving_ia_lgl": (~ei) & (income != cb.INCOME_NONE),
        "demo_disability_lgl": F.col("demo_disability") == "Yes",
        "demo_immigrant_lgl": F.col("demo_born_in_canada") == "No",
        "demo_indigenous_lgl": indigenous,
        "demo_racialized_lgl": racialized,
        "demo_parent_lgl": parent,
        "demo_single_parent_lgl": parent & text.str_detect(F.col("demo_marital"), cb.MARRIED_PATTERN, negate=True),
        "demo_bipoc_lgl": racialized | indigenous,
    }


def baseline_at_enrolment(birth: Column, immigrant: Column, arrival_year: Column, enrolled: Column) -> dict[str, Column]:
    """Baseline variables that compare an answer with the roster's enrolment date, by name."""
    age = dates.completed_years(birth, enrolled)
    return {
        "demo_age": age,
        "demo_age_fct": logic.right_closed_bands(age, cb.AGE_BREAKS, cb.AGE_LABELS),
        "demo_newcomer_lgl": newcomer_flag(immigrant, arrival_year, enrolled),
    }


@cached_columns
def _baseline_columns(book: Codebook, keep: tuple[str, ...]) -> list[Column]:
    own = baseline_answers(book)
    own |= baseline_at_enrolment(own["demo_date_of_birth"], own["demo_immigrant_lgl"], F.col("demo_year_of_arrival"),
                                 F.col("date_of_enrollment"))
    given = ["enrollment_id", "cohort_name", "date_of_enrollment", "assignment_label_fct"]
    return [*[F.col(k) for k in keep],
            *[F.col(c) if c in given else own[c].alias(c) for c in BASELINE_COLUMNS]]


BASELINE_FCT = ["assignment_label_fct", "educ_max_fct", "demo_gender_fct", "demo_age_fct",
                "demo_province_fct", "income_source_fct", "demo_income_source_fct"]
BASELINE_LGL = ["educ_domestic_lgl", "educ_hs_lgl", "educ_pse_lgl", "demo_transgender_lgl",
                "demo_in_sk_lgl", "demo_receiving_ei_lgl", "demo_receiving_ia_lgl",
                "demo_disability_lgl", "demo_immigrant_lgl", "demo_newcomer_lgl",
                "demo_indigenous_lgl", "demo_racialized_lgl", "demo_parent_lgl",
                "demo_single_parent_lgl", "demo_bipoc_lgl"]
BASELINE_COLUMNS = BASELINE_KEYS + BASELINE_FCT + BASELINE_LGL


# ---------------------------------------------------------------------------
# Employment outcomes (H14b, H15-H20)
# ---------------------------------------------------------------------------


def annualized_salary(version: Column) -> Column:
    """Annual pay: v1 reads a number from free text, else hourly x hours x 52;
    v2 hourly first, then the salary scaled by its reporting period."""
    hourly = logic.in_set("job_has_hourly_wage", ["Yes"])
    by_hour = F.col("job_hourly_wage") * F.col("job_hours") * cb.HOURS_WEEKS_PER_YEAR
    v1 = logic.case_when([
        (text.nchar("job_salary_text") > 0, text.parse_number("job_salary_text")),
        (hourly, by_hour),
    ])
    v2 = logic.case_when(
        [(hourly, by_hour)]
        + [(logic.in_set("job_report_salary", [period]), F.col("job_salary_num") * mult)
           for period, mult in cb.PAY_PERIOD_MULTIPLIER.items()]
    )
    return F.when(version == 1, v1).otherwise(v2).cast("double")


def benefit_flags(raw: list[str], employed: Column) -> list[Column]:
    """Select-all benefits -> presence flags (positional names), count, any.

    The count is over the counted options and only for the employed (NULL
    otherwise, also when employment is unknown).
    """
    names = cb.DEFAULT_CODEBOOK.check_arity(cb.BENEFIT_NAMES, raw, "benefits", fewer=True)
    flags = {n: F.col(r).isNotNull() for r, n in zip(raw, names)}
    counted = [flags[n] for n in cb.BENEFIT_COUNTED if n in flags]
    total = logic.flag_sum(counted)
    n = F.when(employed, total)
    return [v.alias(k) for k, v in flags.items()] + [n.alias("job_benefits_n"), (n > 0).alias("job_benefits_any")]


OUTCOME_COLUMNS = ["job_employed", "job_start_date", "job_tenure_months", "job_tenure_days",
                   "job_tenure_wks", "job_seasonal", "job_temporary", "job_satis_overall_pos",
                   "job_satis_advance_pos", "job_satis_precarity_pos", *cb.BENEFIT_NAMES,
                   "job_benefits_n", "job_benefits_any", "job_annualized_salary",
                   "educ_enrolled", "neet"]


def primary_job(df: DataFrame) -> DataFrame:
    """Surveys that ask for several jobs (``a1_job_hours``, ``a2_job_hours``, ...):
    the first is the primary job and takes the plain name; on rows of surveys
    that ask for one job the plain column stands.  Other jobs are dropped."""
    several = [c for c in df.columns if re.match(r"a\d+_", c)]
    if not several:
        return df
    first = {c: c[3:] for c in several if c.startswith("a1_")}
    plain = {n: F.coalesce(F.col(n), F.col(c)) if n in df.columns else F.col(c) for c, n in first.items()}
    return df.withColumns(plain).drop(*several)


def harmonise_outcomes(df: DataFrame, book: Codebook = DEFAULT_CODEBOOK,
                       keep: tuple[str, ...] = ("wave", "version", "response_id"),
                       benefit_cols: tuple[str, ...] = tuple(f"job_benefits_{i}" for i in range(1, 7)),
                       ) -> DataFrame:
    """Employment outcomes of every response, one projection over all surveys.

    Enrolment in education and NEET exist only on later waves or version 2.
    """
    rows = primary_job(df).filter(F.col(book.response_col).isNotNull())
    return rows.select(*_outcome_columns(book, tuple(keep), tuple(benefit_cols)))


@cached_columns
def _outcome_columns(book: Codebook, keep: tuple[str, ...], benefit_cols: tuple[str, ...]) -> list[Column]:
    w, v = F.col(book.wave_col), F.col(book.version_col)
    employed = text.str_detect("job_employed", "Yes")
    start = dates.date_from_parts("job_start_year", "job_start_month")
    end = F.col("response_date")
    has_educ = (w > 1) | (v == 2)
    enrolled = F.when(has_educ, F.col("educ_enrolled") == "Yes")
    satis = [("job_satis_overall_pos", "job_satisfaction_overall"),
             ("job_satis_advance_pos", "job_satisfaction_advancement"),
             ("job_satis_precarity_pos", "job_satisfaction_precarity")]
    return [
        *[F.col(k) for k in keep],
        F.col(book.id_col),
        employed.alias("job_employed"),
        start.alias("job_start_date"),
        dates.completed_months(start, end).alias("job_tenure_months"),
        dates.period_days(start, end).alias("job_tenure_days"),
        dates.period_weeks(start, end).alias("job_tenure_wks"),
        (F.col("job_seasonal") == "Yes").alias("job_seasonal"),
        F.when(v == 1, F.col("job_permanent") == "No").otherwise(F.col("job_temporary") == "Yes")
        .alias("job_temporary"),
        *[text.str_detect(src, cb.SATISFACTION_POSITIVE_PATTERN).alias(dst) for dst, src in satis],
        *benefit_flags(list(benefit_cols), employed),
        annualized_salary(v).alias("job_annualized_salary"),
        enrolled.alias("educ_enrolled"),
        F.when(has_educ, logic.none_of([employed, F.col("educ_enrolled") == "Yes"])).alias("neet"),
    ]
