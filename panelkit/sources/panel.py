"""Synthetic panel derived from the benchmark tables.

The study's own inputs (CRM roster, survey responses, repair file) are not
public, so the checks run on a panel *derived* from the driver's tables:

* ``roster``     one row per participant   <- customer x nation
* ``survey_roster`` one row per participant and survey <- orders
* ``responses``  one row per survey answer <- orders (wave = order priority)
* ``selections`` select-all answers        <- lineitem, one row per order
* ``repair``     wide repair file          <- embeddings (64 = 16 items x 4 options)

Each column is a plain SQL expression that Spark and DuckDB evaluate
identically, so the oracle can inline the very same text as CTEs.  Spark
evaluates them with ``selectExpr`` over the scanned tables: the panel grows
with the tables, and Catalyst prunes every column a query does not use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..codebook import Codebook

# ---------------------------------------------------------------------------
# Fixture column definitions (portable SQL text, evaluated by both engines).
# ---------------------------------------------------------------------------

ROSTER_COLUMNS: list[tuple[str, str]] = [
    ("enrollment_id", "c_custkey"),
    ("pas_id", "concat('PAS-', lpad(cast(c_custkey as string), 14, '0'), '-X')"),
    ("cohort_name",
     "concat('Cohort ', cast(n_regionkey as string), case c_mktsegment "
     "when 'BUILDING' then ' - Program' when 'MACHINERY' then ' - Comparison' "
     "when 'HOUSEHOLD' then ' - Comparison ' else '' end)"),
    ("province", "n_name"),
    ("birth_year", "cast(1940 + (c_custkey * 7) % 66 as int)"),
    ("birth_month", "cast(case when c_custkey % 10 = 3 then 13 else 1 + c_custkey % 12 end as int)"),
    ("date_of_enrollment", "date '2022-01-01' + cast((c_custkey * 37) % 900 as int)"),
    ("cohort_start_date",
     "case when c_custkey % 8 = 0 then null else date '2021-09-01' + cast(n_regionkey * 30 as int) end"),
    ("f_a", "case when c_custkey % 7 = 0 then null else c_custkey % 3 = 0 end"),
    ("f_b", "case when c_custkey % 11 = 0 then null else c_acctbal < 2000 end"),
    ("f_c", "case when c_custkey % 5 = 0 then null else c_acctbal > 6000 end"),
    ("educ_code", "case when c_custkey % 9 = 0 then null else cast(1 + c_custkey % 7 as int) end"),
    ("acct_text", "concat('$', cast(cast(floor(c_acctbal) as bigint) as string), ' CAD')"),
    # a field the source never fills (no balance reaches it): all missing
    ("vip_note", "case when c_acctbal > 1000000 then 'vip' end"),
]

# The roster at the grain of the survey platform: one row per participant and
# survey, participant fields included.  Some rows have no response (NULL, or an
# id that no response has), and some responses have no row.
SURVEY_ROSTER_COLUMNS: list[tuple[str, str]] = [
    ("response_id",
     "case when o_orderkey % 31 = 0 then null when o_orderkey % 41 = 0 then -o_orderkey else o_orderkey end"),
    ("qx_survey_id", "concat('SV_', substr(o_orderpriority, 1, 1), cast(1 + o_orderkey % 2 as string))"),
    ("enrollment_id", "o_custkey"),
    ("pas_id", "concat('PAS-', lpad(cast(o_custkey as string), 14, '0'), '-X')"),
    ("wave", "cast(substr(o_orderpriority, 1, 1) as int)"),
    ("version", "cast(1 + o_orderkey % 2 as int)"),
    ("survey_name",
     "concat('S_0.0.', cast(1 + o_orderkey % 2 as string), '_PANEL_s0', "
     "substr(o_orderpriority, 1, 1), '_', substr(o_orderpriority, 3, 20))"),
    ("cohort_name",
     "concat('Cohort ', cast(o_custkey % 5 as string), case o_custkey % 7 when 0 then ' - Program' "
     "when 1 then ' - Program' when 2 then ' - Comparison' when 3 then ' - Comparison ' else '' end)"),
    ("date_of_enrollment", "date '2022-01-01' + cast((o_custkey * 37) % 900 as int)"),
]
SURVEY_ROSTER_ROWS = "o_orderkey % 37 <> 0"

_V1 = "o_orderkey % 2 = 0"
_V2 = "o_orderkey % 2 = 1"

RESPONSE_COLUMNS: list[tuple[str, str]] = [
    ("response_id", "o_orderkey"),
    ("enrollment_id", "o_custkey"),
    ("wave", "cast(substr(o_orderpriority, 1, 1) as int)"),
    ("version", "cast(1 + o_orderkey % 2 as int)"),
    ("survey_name",
     "concat('S_0.0.', cast(1 + o_orderkey % 2 as string), '_PANEL_s0', "
     "substr(o_orderpriority, 1, 1), '_', substr(o_orderpriority, 3, 20))"),
    ("response_date", "cast(o_orderdate as date)"),
    ("status_answer", "case when o_orderkey % 4 = 0 then null else o_orderstatus end"),
    ("amount", "case when o_orderkey % 6 = 0 then null else o_totalprice end"),
    ("rating", "case when o_orderkey % 13 = 0 then null else cast(1 + o_orderkey % 5 as int) end"),
    # -- baseline demographics ------------------------------------------------
    ("demos", "case when o_orderkey % 3 = 0 then 'TRUE' else 'FALSE' end"),
    ("education_highest", "case when o_orderkey % 9 = 4 then null else cast(1 + o_orderkey % 7 as int) end"),
    ("education_domestic",
     "case o_orderkey % 3 when 0 then 'In Canada' when 1 then 'Outside Canada' else null end"),
    ("demo_sex", "case o_orderkey % 4 when 0 then 'Male' when 1 then 'Female' when 2 then 'Intersex' else null end"),
    ("demo_transgender",
     "case o_orderkey % 5 when 0 then 'Yes' when 1 then 'Prefer not to answer' when 2 then null else 'No' end"),
    ("demo_gender",
     "case o_orderkey % 7 when 0 then 'Man' when 1 then 'Woman' when 2 then 'Two-Spirit' "
     "when 3 then 'Female' when 4 then null when 5 then 'Male' else 'Non-binary' end"),
    ("demo_dob_month", "cast(case when o_orderkey % 17 = 0 then 13 else 1 + o_orderkey % 12 end as int)"),
    ("demo_dob_year", "case when o_orderkey % 19 = 0 then null else cast(1950 + o_orderkey % 55 as int) end"),
    ("demo_province",
     "case when o_orderkey % 499 = 7 then 'Nunavut' else case o_orderkey % 6 when 0 then 'Ontario' when 1 then 'Saskatchewan' when 2 then 'Alberta' "
     "when 3 then 'British Columbia' when 4 then 'Newfoundland' else null end end"),
    ("income_source",
     "case when o_orderkey % 11 < 2 then 'Employment Insurance' when o_orderkey % 11 < 4 then 'Social Assistance' "
     "when o_orderkey % 11 < 7 then null when o_orderkey % 11 < 9 then 'Employment' else 'Disability Support' end"),
    ("demo_disability",
     "case when o_orderkey % 13 = 0 then null when o_orderkey % 13 < 4 then 'Yes' else 'No' end"),
    ("demo_born_in_canada",
     "case o_orderkey % 8 when 0 then null when 1 then 'No' when 2 then 'No' when 5 then 'No' else 'Yes' end"),
    ("demo_year_of_arrival",
     "case when o_orderkey % 4 = 1 then null else cast(1990 + o_orderkey % 35 as int) end"),
    ("demo_children",
     "case when o_orderkey % 10 < 4 then 'Yes' when o_orderkey % 10 = 9 then null else 'No' end"),
    ("demo_marital",
     "case when o_orderkey % 9 < 2 then 'Married' when o_orderkey % 9 < 4 then 'Never married' "
     "when o_orderkey % 9 = 4 then 'Common-law' when o_orderkey % 9 = 5 then null else 'Single' end"),
    # version 1: yes/no identity questions
    ("demo_parent", f"case when {_V2} then null when o_orderkey % 3 = 1 then 'No' else 'Yes' end"),
    ("demo_indigenous", f"case when {_V2} then null when o_orderkey % 7 = 0 then 'Yes' else 'No' end"),
    ("demo_racialized",
     f"case when {_V2} then null when o_orderkey % 3 = 0 then 'Yes' when o_orderkey % 3 = 1 then 'No' else null end"),
    # version 2: caregiver + select-all identity questions (NULL = not chosen)
    ("demo_caregiver", f"case when {_V1} then null when o_orderkey % 3 = 2 then 'No' else 'Yes' end"),
    ("demo_indigenous_1", f"case when {_V2} and o_orderkey % 5 = 1 then 'First Nations' end"),
    ("demo_indigenous_2", f"case when {_V2} and o_orderkey % 7 = 3 then 'Not Indigenous' end"),
    ("demo_indigenous_3", f"case when {_V2} and o_orderkey % 3 = 0 then 'Metis' end"),
    ("demo_race_1", f"case when {_V2} and o_orderkey % 3 = 1 then 'Black' end"),
    ("demo_race_2", f"case when {_V2} and o_orderkey % 5 = 2 then 'East Asian' end"),
    ("demo_race_3", f"case when {_V2} and o_orderkey % 7 = 1 then 'South Asian' end"),
    ("demo_race_4", f"case when {_V2} and o_orderkey % 11 = 5 then 'Latin American' end"),
    ("demo_race_5", f"case when {_V2} and o_orderkey % 13 = 2 then 'Middle Eastern' end"),
    ("demo_race_6", f"case when {_V2} and o_orderkey % 17 = 3 then 'Other' end"),
    ("demo_race_7", f"case when {_V2} and o_orderkey % 4 = 1 then 'White' end"),
    # -- employment outcomes -----------------------------------------------------
    ("job_employed",
     "case when o_orderkey % 7 in (0, 1) then 'No' when o_orderkey % 7 = 2 then null else 'Yes' end"),
    ("job_start_year", "case when o_orderkey % 10 = 3 then null else cast(1980 + o_orderkey % 15 as int) end"),
    ("job_start_month", "cast(case when o_orderkey % 23 = 0 then 13 else 1 + o_orderkey % 12 end as int)"),
    ("job_seasonal", "case (o_orderkey + 1) % 3 when 0 then 'Yes' when 1 then 'No' else null end"),
    ("job_satisfaction_overall",
     "case o_orderkey % 5 when 0 then 'Strongly agree' when 1 then 'Agree' "
     "when 2 then 'Neither agree nor disagree' when 3 then 'Strongly disagree' else null end"),
    ("job_satisfaction_advancement",
     "case (o_orderkey + 1) % 5 when 0 then 'Strongly agree' when 1 then 'Agree' "
     "when 2 then 'Neither agree nor disagree' when 3 then 'Disagree' else null end"),
    ("job_satisfaction_precarity",
     "case (o_orderkey + 2) % 5 when 0 then 'Strongly agree' when 1 then 'Agree' "
     "when 2 then 'Neither agree nor disagree' when 3 then 'Disagree' else null end"),
    ("educ_enrolled", "case o_orderkey % 4 when 0 then 'Yes' when 1 then null else 'No' end"),
    ("job_benefits_1", "case when o_orderkey % 2 = 0 then 'Health' end"),
    ("job_benefits_2", "case when o_orderkey % 3 = 0 then 'Dental' end"),
    ("job_benefits_3", "case when o_orderkey % 5 = 0 then 'Disability' end"),
    ("job_benefits_4", "case when o_orderkey % 7 = 0 then 'Pension' end"),
    ("job_benefits_5", "case when o_orderkey % 11 = 0 then 'Vacation' end"),
    ("job_benefits_6", "case when o_orderkey % 13 = 0 then 'None' end"),
    ("job_has_hourly_wage", "case o_orderkey % 3 when 0 then 'Yes' when 1 then 'No' else null end"),
    ("job_hourly_wage", "case when o_orderkey % 3 = 0 then cast(15 + o_orderkey % 20 as double) end"),
    ("job_hours", "case when o_orderkey % 6 = 3 then null else cast(20 + o_orderkey % 25 as double) end"),
    # version 1: salary as free text, permanent job question
    ("job_salary_text",
     f"case when {_V1} and o_orderkey % 4 = 0 then concat('$', "
     "cast(cast(floor(o_totalprice / 1000) as bigint) as string), ',', "
     "lpad(cast(cast(floor(o_totalprice) as bigint) % 1000 as string), 3, '0'), '.50 CAD') "
     f"when {_V1} and o_orderkey % 8 = 2 then '' end"),
    ("job_permanent",
     f"case when {_V2} then null when o_orderkey % 3 = 0 then 'Yes' when o_orderkey % 3 = 1 then 'No' end"),
    # version 2: numeric salary with its reporting period, temporary job question
    ("job_report_salary",
     f"case when {_V1} then null when o_orderkey % 7 = 1 then 'Yearly' when o_orderkey % 7 = 3 then 'Monthly' "
     "when o_orderkey % 7 = 5 then 'Weekly' when o_orderkey % 7 = 6 then 'Semimonthly (twice per month)' "
     "when o_orderkey % 7 = 0 then 'Biweekly (every two weeks)' end"),
    ("job_salary_num", f"case when {_V2} then cast(floor(o_totalprice / 4) as double) end"),
    ("job_temporary",
     f"case when {_V1} then null when o_orderkey % 3 = 0 then 'Yes' when o_orderkey % 3 = 1 then 'No' end"),
    # -- programme satisfaction (waves 2 and 3; 6 resp. 5 ordered items) --------
    *[
        (f"satis_{j}",
         "case when substr(o_orderpriority, 1, 1) in ('2', '3') "
         + ("and substr(o_orderpriority, 1, 1) = '2' " if j == 6 else "")
         + (f"and o_orderkey % {j + 6} <> 0 " if j > 2 else "")
         + f"then cast(1 + (o_orderkey + {j}) % 5 as int) end")
        for j in range(1, 7)
    ],
    # -- employment-hope scale (waves 1-3, 14 items, codes 1..11) ----------------
    *[
        (f"emp_hope_1_{i}",
         "case when substr(o_orderpriority, 1, 1) in ('1', '2', '3') "
         f"and o_orderkey % 29 <> {i} then cast(1 + (o_orderkey * {i + 2} + {i}) % 11 as int) end")
        for i in range(1, 15)
    ],
]

#: The fixture asks fewer options of the identity question than the study does.
BOOK = Codebook(race_options=tuple(f"demo_race_{i}" for i in range(1, 8)), race_not_racialized_option="demo_race_7")

# Wave tags of the fixture's survey names (the order-priority texts).
WAVE_TAGS = ["URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED", "LOW"]

# Select-all answers from lineitem: option k chosen iff the order has line k.
SELECTION_OPTIONS = 7


def _selection_exprs(prefix: str = "opt_") -> list[tuple[str, str]]:
    return [(f"{prefix}{k}", f"max(case when l_linenumber = {k} then l_linenumber end)")
            for k in range(1, SELECTION_OPTIONS + 1)]


# Repair file: item i (1..16) x option o (1..4) read from embedding[4*(i-1)+o-1]
# (0-based in Spark, 1-based in DuckDB), as an answer code 1..11; one NULL column.
REPAIR_ITEMS = 16
REPAIR_OPTIONS = 4


def _repair_value(pos0: int, base1: bool) -> str:
    idx = pos0 + 1 if base1 else pos0
    return f"cast(1 + cast(floor(abs(embedding[{idx}]) * 100) as int) % 11 as int)"


def repair_columns(base1: bool) -> list[tuple[str, str]]:
    cols = [("response_id", "vec_id")]
    for i in range(1, REPAIR_ITEMS + 1):
        for o in range(1, REPAIR_OPTIONS + 1):
            value = _repair_value(4 * (i - 1) + o - 1, base1)
            if o == 2:
                # Option 2 is left unanswered by every 3rd respondent.
                value = f"case when vec_id % 3 = 0 then null else {value} end"
            if i == 5:
                # Item 5 is entirely unanswered by every 10th respondent.
                value = f"case when vec_id % 10 = 0 then null else {value} end"
            cols.append((f"Q115_{i}_{o}", value))
    return cols


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  The files are listed anew each time, so that rows
    appended since the last query are read; only the schema, which takes a job
    to read, is kept for the session."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _select(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns])


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per participant (customer), with the nation as province.

    nation is the 25-row dimension; the size-based broadcast decision is left
    to Spark (it broadcasts it, customer is not shuffled).
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return _select(c.join(n, c.c_nationkey == n.n_nationkey), ROSTER_COLUMNS)


def survey_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per participant and survey, with the id of its response (if any)."""
    return _select(table(spark, sf_dir, "orders").filter(SURVEY_ROSTER_ROWS), SURVEY_ROSTER_COLUMNS)


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per survey response (order): raw answers of every wave/version."""
    return _select(table(spark, sf_dir, "orders"), RESPONSE_COLUMNS)


def selections(spark: SparkSession, sf_dir: str, prefix: str = "opt_") -> DataFrame:
    """Select-all answers, one row per order: ``opt_k`` = k if chosen else NULL.

    A partial/final hash aggregate keyed by ``l_orderkey`` (map-side combine,
    one shuffle).
    """
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        *[F.expr(e).alias(n) for n, e in _selection_exprs(prefix)]
    ).withColumnRenamed("l_orderkey", "response_id")


def repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide repair file (response id + Q115_<item>_<option>)."""
    return _select(table(spark, sf_dir, "embeddings"), repair_columns(base1=False))


# ---------------------------------------------------------------------------
# Oracle side: the same text as CTEs.
# ---------------------------------------------------------------------------


def _cte(columns: list[tuple[str, str]], source: str) -> str:
    body = ",\n  ".join(f"{expr} AS {name}" for name, expr in columns)
    return f"select\n  {body}\nfrom {source}"


def roster_sql() -> str:
    return _cte(ROSTER_COLUMNS, "customer join nation on c_nationkey = n_nationkey")


def survey_roster_sql() -> str:
    return _cte(SURVEY_ROSTER_COLUMNS, f"orders where {SURVEY_ROSTER_ROWS}")


def responses_sql() -> str:
    return _cte(RESPONSE_COLUMNS, "orders")


def selections_sql(prefix: str = "opt_") -> str:
    body = ",\n  ".join(f"{e} AS {n}" for n, e in _selection_exprs(prefix))
    return f"select l_orderkey AS response_id,\n  {body}\nfrom lineitem group by l_orderkey"


def repair_sql() -> str:
    return _cte(repair_columns(base1=True), "embeddings")


def with_panel(sql_body: str, *, roster_: bool = True, responses_: bool = True,
               selections_: bool = False, repair_: bool = False, extra: str = "") -> str:
    """Prefix an oracle query with the panel CTEs it needs."""
    ctes = []
    if roster_:
        ctes.append(f"roster AS (\n{roster_sql()}\n)")
    if responses_:
        ctes.append(f"responses AS (\n{responses_sql()}\n)")
        ctes.append(f"survey_roster AS (\n{survey_roster_sql()}\n)")
    if selections_:
        ctes.append(f"selections AS (\n{selections_sql()}\n)")
    if repair_:
        ctes.append(f"repair AS (\n{repair_sql()}\n)")
    if extra:
        ctes.append(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + sql_body
