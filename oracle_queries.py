"""DuckDB oracle SQL for every registered query.

Independent re-statement of each operator in plain SQL over the driver's
tables.  The synthetic panel CTEs (``roster``, ``responses`` ...) are the same
SQL text the Spark side evaluates (``panelkit.sources.panel``); everything
after them is written separately here.
"""

from __future__ import annotations

from panelkit.sources import panel

# ---------------------------------------------------------------------------
# Fixed values of the questionnaire and the reports, written out here apart from
# the engine's codebook: a wrong value there shows as a difference.
# ---------------------------------------------------------------------------


class cb:
    ARM_LEVELS = ['Program', 'Comparison', 'Non-RCT']
    ARM_SUFFIX_PATTERN = '(Program|Comparison)$'
    ARM_SUFFIX_REMOVE_PATTERN = ' - (Program|Comparison)$'
    ARM_DEFAULT = 'Non-RCT'
    TOTAL_LABEL = 'Total'
    ELIGIBLE_ARMS = ['Program', 'Non-RCT']
    EDUCATION_LEVELS = ['Less than Highschool', 'Highschool', 'Apprenticeship or College', 'Undergraduate Degree', 'Graduate Degree']
    EDUCATION_PSE_LEVELS = ['Apprenticeship or College', 'Undergraduate Degree', 'Graduate Degree']
    EDUCATION_DOMESTIC_ANSWER = 'In Canada'
    GENDER_MAN_PATTERN = 'Male|Man'
    GENDER_WOMAN_PATTERN = 'Female|Woman'
    AGE_BREAKS = [0, 20, 30, 40, 60, 100]
    AGE_LABELS = ['20 or younger', '21 to 30', '31 to 40', '41 to 60', '61 or older']
    INCOME_NONE = 'None of the Above'
    INCOME_EI = 'Employment Insurance'
    HOME_PROVINCE = 'Saskatchewan'
    NEWCOMER_YEARS = 5
    MARRIED_PATTERN = 'married|common-law'
    SCALE_DOMAINS = [('ehs_empowerment', 1, 4), ('ehs_motivation', 5, 6), ('ehs_utilization', 7, 10), ('ehs_goal_orientation', 11, 14)]
    SCALE_ITEMS = 14
    BENEFIT_NAMES = ['job_benefits_health',
                     'job_benefits_dental',
                     'job_benefits_disability',
                     'job_benefits_pension',
                     'job_benefits_vacation',
                     'job_benefits_none']
    BENEFIT_COUNTED = ['job_benefits_health', 'job_benefits_dental', 'job_benefits_disability', 'job_benefits_pension', 'job_benefits_vacation']
    PAY_PERIOD_MULTIPLIER = {'Yearly': 1, 'Monthly': 12, 'Weekly': 52, 'Semimonthly (twice per month)': 24, 'Biweekly (every two weeks)': 26}
    HOURS_WEEKS_PER_YEAR = 52
    SATISFACTION_POSITIVE_PATTERN = 'Agree|Strongly agree'
    SATISFACTION_NAMES = {2: ['satis_inmotion_overall',
                              'satis_momentum_overall',
                              'satis_inmotion_utility',
                              'satis_momentum_utility',
                              'satis_inmotion_recommend',
                              'satis_momentum_recommend'],
                          3: ['satis_m_plus_overall',
                              'satis_immm_plus_overall',
                              'satis_m_plus_utility',
                              'satis_immm_plus_utility',
                              'satis_immm_plus_recommend']}
    QUARTERLY_LABELS = [('demo_immigrant_lgl', 'Migration--Immigrant'),
                        ('demo_newcomer_lgl', 'Migration--Newcomer (< 5 years in Canada)'),
                        ('demo_born_in_canada_lgl', 'Migration--Born in Canada'),
                        ('demo_receiving_ei_lgl', 'Financial Assistance--Receiving EI'),
                        ('demo_receiving_ia_lgl', 'Financial Assistance--Receiving Social Assistance'),
                        ('demo_receiving_none_lgl', 'Financial Assistance--None of the Above'),
                        ('demo_young_lgl', 'Age--Youth (< 30)'),
                        ('demo_middle_age_lgl', 'Age--Middle Age (30-64)'),
                        ('demo_old_lgl', 'Age--Older (> 64)'),
                        ('demo_racialized_lgl', 'Marginalization Factors--Racialized'),
                        ('demo_indigenous_lgl', 'Marginalization Factors--Indigenous'),
                        ('demo_bipoc_lgl', 'Marginalization Factors--BIPOC'),
                        ('demo_disability_lgl', 'Marginalization Factors--Disability'),
                        ('demo_woman_plus_lgl', 'Marginalization Factors--Woman+'),
                        ('demo_mf_none_lgl', 'Marginalization Factors--None of the Above')]
    MARGINALIZATION_FLAGS = ['demo_racialized_lgl', 'demo_indigenous_lgl', 'demo_bipoc_lgl', 'demo_disability_lgl', 'demo_woman_plus_lgl']
    QUARTER_DEMO_LABELS = [('demo_born_in_canada', 'Born in Canada'),
                           ('demo_immigrant_lgl', 'Immigrant'),
                           ('demo_newcomer_lgl', 'Newcomer (< 5 years in Canada)'),
                           ('demo_indigenous_lgl', 'Indigenous'),
                           ('demo_racialized_lgl', 'Racialized'),
                           ('demo_bipoc_lgl', 'BIPOC'),
                           ('demo_disability_lgl', 'Disability'),
                           ('demo_young_lgl', 'Youth (< 30)'),
                           ('demo_old_lgl', 'Older (> 64)'),
                           ('demo_woman_plus_lgl', 'Woman+')]
    SATISFACTION_LABELS = {'satis_immm_plus_overall': 'Satisfied',
                           'satis_immm_plus_utility': 'Found IMMM+ useful',
                           'satis_immm_plus_recommend': 'Would recommend IMMM+'}
    EHS_DOMAIN_LABELS = {'ehs_empowerment': 'Psychological Empowerment',
                         'ehs_motivation': 'Forward-looking Self-motivation',
                         'ehs_utilization': 'Utilization of Skills and Resources',
                         'ehs_goal_orientation': 'Goal-orientation'}
    LAST_WAVE_TAG = '12-month-follow-up'
    REPORT_EXCLUDED_ARM = 'Comparison'
    REPORT_WINDOW = ('2024-03-01', '2024-06-30')
    FISCAL_START_QUARTERLY = 3
    FISCAL_START_DEMOGRAPHICS = 4
    NUMBER_PATTERN = r'-?[0-9][0-9,]*(\.[0-9]+)?|-?\.[0-9]+'


class BOOK:
    indigenous_options = ("demo_indigenous_1", "demo_indigenous_2", "demo_indigenous_3")
    indigenous_no_option = "demo_indigenous_2"
    race_options = ("demo_race_1", "demo_race_2", "demo_race_3", "demo_race_4", "demo_race_5", "demo_race_6", "demo_race_7")
    race_not_racialized_option = "demo_race_7"
    home_province = 'Saskatchewan'


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def qi(s: str) -> str:
    """SQL identifier."""
    return '"' + s.replace('"', '""') + '"'


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


# ---------------------------------------------------------------------------
# Shared SQL fragments
# ---------------------------------------------------------------------------

ROSTER_CLEAN = f"""roster_clean AS (
  select * replace (
    regexp_replace(trim(cohort_name), {q(cb.ARM_SUFFIX_REMOVE_PATTERN)}, '') as cohort_name,
    substr(pas_id, 1, 15) as pas_id),
    coalesce(nullif(regexp_extract(trim(cohort_name), {q(cb.ARM_SUFFIX_PATTERN)}, 0), ''),
             {q(cb.ARM_DEFAULT)}) as assignment_label_fct
  from roster
)"""


PANEL_CLEAN = ROSTER_CLEAN.replace("roster_clean AS", "panel_clean AS").replace("from roster", "from survey_roster")


def date_from_parts(y: str, m: str) -> str:
    return (f"case when {y} is null or {m} is null or {m} not between 1 and 12 then null "
            f"else make_date(cast({y} as int), cast({m} as int), 1) end")


def years_between(s: str, e: str) -> str:
    return f"cast(datesub('year', {s}, {e}) as int)"


def regex_hit(col: str, pat: str) -> str:
    return f"regexp_matches({col}, {q(pat)})"


def count_present(cols) -> str:
    return "(" + " + ".join(f"cast({c} is not null as int)" for c in cols) + ")"


def education_sql(code: str) -> str:
    L = cb.EDUCATION_LEVELS
    return (f"case when {code} = 1 then {q(L[0])} when {code} = 2 then {q(L[1])} "
            f"when {code} <= 5 then {q(L[2])} when {code} = 6 then {q(L[3])} "
            f"when {code} = 7 then {q(L[4])} end")


_IND_N = count_present(BOOK.indigenous_options)
_RACE_N = count_present(BOOK.race_options)

BASELINE_TEMPLATE = f"""baseline AS (
  select r.wave, r.version, r.response_id, r.enrollment_id, c.cohort_name, c.date_of_enrollment,
    {years_between(date_from_parts('r.demo_dob_year', 'r.demo_dob_month'), 'c.date_of_enrollment')} as demo_age,
    {date_from_parts('r.demo_dob_year', 'r.demo_dob_month')} as demo_date_of_birth,
    c.assignment_label_fct,
    case when r.wave = 1 then {education_sql('try_cast(r.education_highest as int)')} end as educ_max_fct,
    case when r.demo_sex = 'Male' and r.demo_transgender = 'No' then 'Man'
         when r.demo_sex = 'Female' and r.demo_transgender = 'No' then 'Woman'
         when {regex_hit('r.demo_gender', cb.GENDER_MAN_PATTERN)} then 'Man'
         when {regex_hit('r.demo_gender', cb.GENDER_WOMAN_PATTERN)} then 'Woman'
         when r.demo_gender is null then null else 'Other' end as demo_gender_fct,
    r.demo_province as demo_province_fct,
    r.income_source as income_source_fct,
    case when r.demo_province is null then null
         when r.income_source is null then {q(cb.INCOME_NONE)} else r.income_source end as demo_income_source_fct,
    case when r.wave = 1 then r.education_domestic = {q(cb.EDUCATION_DOMESTIC_ANSWER)} end as educ_domestic_lgl,
    r.demo_transgender as demo_transgender_raw,
    r.demo_year_of_arrival, r.demo_marital, r.demo_born_in_canada, r.demo_disability,
    r.education_highest,
    case when r.version = 1 then r.demo_indigenous = 'Yes'
         else case when {_IND_N} = 0 then null when r.{BOOK.indigenous_no_option} is not null then false
                   else true end end as demo_indigenous_lgl,
    case when r.version = 1 then r.demo_racialized = 'Yes'
         else case when {_RACE_N} = 0 then null
                   when {_RACE_N} = 1 and r.{BOOK.race_not_racialized_option} is not null then false
                   else true end end as demo_racialized_lgl,
    r.demo_children = 'Yes' and (case when r.version = 1 then r.demo_parent = 'Yes'
                                      else r.demo_caregiver = 'Yes' end) as demo_parent_lgl
  from responses r join panel_clean c on r.response_id = c.response_id
  where r.response_id is not null
    and (r.wave = 1 or r.demos = 'FALSE')
    @@WAVE_FILTER@@
),
baseline_h AS (
  select wave, version, response_id, enrollment_id, cohort_name, date_of_enrollment, demo_age,
    demo_date_of_birth, assignment_label_fct, educ_max_fct, demo_gender_fct,
    case when demo_age > 0 and demo_age <= 20 then {q(cb.AGE_LABELS[0])}
         when demo_age > 20 and demo_age <= 30 then {q(cb.AGE_LABELS[1])}
         when demo_age > 30 and demo_age <= 40 then {q(cb.AGE_LABELS[2])}
         when demo_age > 40 and demo_age <= 60 then {q(cb.AGE_LABELS[3])}
         when demo_age > 60 and demo_age <= 100 then {q(cb.AGE_LABELS[4])} end as demo_age_fct,
    demo_province_fct, income_source_fct, demo_income_source_fct, educ_domestic_lgl,
    case when wave = 1 then educ_max_fct = {q(cb.EDUCATION_LEVELS[1])} end as educ_hs_lgl,
    case when wave = 1 then (case when {education_sql('try_cast(education_highest as int)')} is null then null
         when {education_sql('try_cast(education_highest as int)')} in {in_list(cb.EDUCATION_PSE_LEVELS)} then true
         else false end) end as educ_pse_lgl,
    case when demo_transgender_raw is null then null
         when demo_transgender_raw = 'Prefer not to answer' then null
         when demo_transgender_raw = 'No' then false else true end as demo_transgender_lgl,
    demo_province_fct = {q(BOOK.home_province)} as demo_in_sk_lgl,
    demo_income_source_fct = {q(cb.INCOME_EI)} as demo_receiving_ei_lgl,
    (not (demo_income_source_fct = {q(cb.INCOME_EI)})) and (demo_income_source_fct <> {q(cb.INCOME_NONE)})
      as demo_receiving_ia_lgl,
    demo_disability = 'Yes' as demo_disability_lgl,
    demo_born_in_canada = 'No' as demo_immigrant_lgl,
    case when (demo_born_in_canada = 'No') is null then null
         when demo_year_of_arrival is null then null
         when year(date_of_enrollment) - demo_year_of_arrival <= {cb.NEWCOMER_YEARS} then true
         else false end as demo_newcomer_lgl,
    demo_indigenous_lgl, demo_racialized_lgl, demo_parent_lgl,
    demo_parent_lgl and not {regex_hit('demo_marital', cb.MARRIED_PATTERN)} as demo_single_parent_lgl,
    demo_racialized_lgl or demo_indigenous_lgl as demo_bipoc_lgl
  from baseline
)"""

BASELINE = BASELINE_TEMPLATE.replace("@@WAVE_FILTER@@", "and (r.wave = 1 or (r.wave <= 3 and r.version = 2))")
BASELINE_ALL = BASELINE_TEMPLATE.replace("@@WAVE_FILTER@@", "")

ROOT_COLUMNS = ["cohort_name", "date_of_enrollment", "demo_age", "demo_date_of_birth",
                "assignment_label_fct", "educ_max_fct", "demo_gender_fct", "demo_age_fct",
                "demo_province_fct", "income_source_fct", "demo_income_source_fct",
                "educ_domestic_lgl", "educ_hs_lgl", "educ_pse_lgl", "demo_transgender_lgl",
                "demo_in_sk_lgl", "demo_receiving_ei_lgl", "demo_receiving_ia_lgl",
                "demo_disability_lgl", "demo_immigrant_lgl", "demo_newcomer_lgl",
                "demo_indigenous_lgl", "demo_racialized_lgl", "demo_parent_lgl",
                "demo_single_parent_lgl", "demo_bipoc_lgl"]


def first_nm(col: str, order: str = "wave, version, response_id") -> str:
    return f"first({col} order by {order}) filter (where {col} is not null)"


ROOT = "root AS (\n  select enrollment_id,\n    " + ",\n    ".join(
    f"{first_nm(c)} as {c}" for c in ROOT_COLUMNS) + "\n  from baseline_h group by enrollment_id\n)"


def with_root(body: str, extra: str = "") -> str:
    ctes = ",\n".join(x for x in [PANEL_CLEAN, BASELINE, ROOT, extra] if x)
    return panel.with_panel(body, extra=ctes)


REPORT_FLAGS = """flags AS (
  select *,
    not demo_immigrant_lgl as demo_born_in_canada_lgl,
    demo_gender_fct <> 'Man' or demo_transgender_lgl as demo_woman_plus_lgl,
    cast(demo_receiving_ei_lgl as int) + cast(demo_receiving_ia_lgl as int) = 0 as demo_receiving_none_lgl,
    demo_age < 30 as demo_young_lgl,
    demo_age > 64 as demo_old_lgl,
    cast(demo_age < 30 as int) + cast(demo_age > 64 as int) = 0 as demo_middle_age_lgl,
    """ + " + ".join(f"cast({f} as int)" for f in cb.MARGINALIZATION_FLAGS[:4]) + """
      + cast(demo_gender_fct <> 'Man' or demo_transgender_lgl as int) = 0 as demo_mf_none_lgl
  from root
)"""


def pct_cell_sql(n: str, N: str) -> str:
    return (f"case when {N} > 0 then cast(cast(round_even({n} * 100.0 / {N}, 0) as int) as varchar)"
            f" || '% (' || cast({n} as varchar) || '/' || cast({N} as varchar) || ')' end")


def quarterly_table_sql(where: str = "true") -> str:
    flags = [f for f, _ in cb.QUARTERLY_LABELS]
    long = "\n  union all\n  ".join(
        f"select assignment_label_fct as arm, {q(f)} as var, {f} as val from flags where {where}" for f in flags)
    labels = ", ".join(f"({q(f)}, {q(l)})" for f, l in cb.QUARTERLY_LABELS)
    levels = [*cb.ARM_LEVELS, cb.TOTAL_LABEL]
    pivots = ",\n  ".join(f"max(case when arm = {q(l)} then cell end) as {qi(l)}" for l in levels)
    body = f"""
, long AS (
  {long}
), cells AS (
  select case when grouping(arm) = 1 then 'Total' else arm end as arm, var,
         cast(sum(cast(val as int)) as bigint) as n_yes, count(*) as n_all
  from long where val is not null
  group by grouping sets ((arm, var), (var))
), labelled AS (
  select c.arm, l.lab, {pct_cell_sql('c.n_yes', 'c.n_all')} as cell
  from cells c join (values {labels}) l(var, lab) on c.var = l.var
)
select split_part(lab, '--', 1) as cat, substr(lab, strpos(lab, '--') + 2) as var,
  {pivots}
from labelled group by lab
"""
    return with_root(body, REPORT_FLAGS)




# ---------------------------------------------------------------------------
# More shared fragments
# ---------------------------------------------------------------------------

POP = f"""pop AS (
  select * from flags where demo_province_fct = {q(cb.HOME_PROVINCE)}
    and assignment_label_fct <> {q(cb.REPORT_EXCLUDED_ARM)}
)"""


def with_pop(body: str) -> str:
    return with_root(body, REPORT_FLAGS + ",\n" + POP)


def fy_sql(d: str, k: int) -> str:
    return f"cast(year({d}) + case when month({d}) >= {k} then 1 else 0 end as integer)"


def fq_sql(d: str, k: int) -> str:
    return f"cast(((month({d}) - {k} + 12) % 12) // 3 + 1 as integer)"


def parse_number_sql(c: str) -> str:
    return f"try_cast(replace(nullif(regexp_extract({c}, {q(cb.NUMBER_PATTERN)}, 0), ''), ',', '') as double)"


def rnd(x: str, n: int = 6) -> str:
    # first to 10 digits: a sum's order must not tip a value that stands between two
    return f"round(round({x}, 10), {n})"


def union_long(src: str, ids: list[str], cols: list[str], name: str = "var", value: str = "val") -> str:
    idl = ", ".join(ids)
    return "\n  union all\n  ".join(f"select {idl}, {q(c)} as {name}, {c} as {value} from {src}" for c in cols)


def tag_sql(name: str) -> str:
    return f"nullif(regexp_extract({name}, 's\\d{{2}}_(.*)$', 1), '')"


BENEFIT_RAW = [f"job_benefits_{i}" for i in range(1, 7)]
_EMPLOYED = "regexp_matches(job_employed, 'Yes')"
_HOURLY = "coalesce(job_has_hourly_wage = 'Yes', false)"
_BY_HOUR = f"job_hourly_wage * job_hours * {cb.HOURS_WEEKS_PER_YEAR}"


def salary_v1() -> str:
    return (f"case when length(job_salary_text) > 0 then {parse_number_sql('job_salary_text')} "
            f"when {_HOURLY} then {_BY_HOUR} end")


def salary_v2() -> str:
    per = " ".join(f"when coalesce(job_report_salary = {q(k)}, false) then job_salary_num * {m}"
                   for k, m in cb.PAY_PERIOD_MULTIPLIER.items())
    return f"case when {_HOURLY} then {_BY_HOUR} {per} end"


def benefits_sql(raw: list[str], employed: str) -> str:
    names = cb.BENEFIT_NAMES[:len(raw)]
    flags = [f"{r} is not null as {n}" for r, n in zip(raw, names)]
    counted = " + ".join(f"cast({r} is not null as int)" for r, n in zip(raw, names) if n in cb.BENEFIT_COUNTED)
    n = f"case when {employed} then {counted} end"
    return ",\n    ".join(flags + [f"{n} as job_benefits_n", f"({n}) > 0 as job_benefits_any"])


_START = date_from_parts("job_start_year", "job_start_month")
_MONTHS = f"cast(datesub('month', {_START}, response_date) as integer)"
_DAYS = f"cast(date_diff('day', cast({_START} + to_months({_MONTHS}) as date), response_date) as integer)"

OUTCOMES_H = f"""outcomes_h AS (
  select wave, version, response_id, enrollment_id, {tag_sql('survey_name')} as survey_tag,
    {_EMPLOYED} as job_employed,
    {_START} as job_start_date,
    {_MONTHS} as job_tenure_months,
    {_DAYS} as job_tenure_days,
    ({_MONTHS} * 30.4375 + {_DAYS}) / 7.0 as job_tenure_wks,
    job_seasonal = 'Yes' as job_seasonal,
    case when version = 1 then job_permanent = 'No' else job_temporary = 'Yes' end as job_temporary,
    {regex_hit('job_satisfaction_overall', cb.SATISFACTION_POSITIVE_PATTERN)} as job_satis_overall_pos,
    {regex_hit('job_satisfaction_advancement', cb.SATISFACTION_POSITIVE_PATTERN)} as job_satis_advance_pos,
    {regex_hit('job_satisfaction_precarity', cb.SATISFACTION_POSITIVE_PATTERN)} as job_satis_precarity_pos,
    {benefits_sql(BENEFIT_RAW, _EMPLOYED)},
    cast(case when version = 1 then {salary_v1()} else {salary_v2()} end as double) as job_annualized_salary,
    case when wave > 1 or version = 2 then educ_enrolled = 'Yes' end as educ_enrolled,
    case when wave > 1 or version = 2 then cast({_EMPLOYED} as int) + cast(educ_enrolled = 'Yes' as int) = 0 end as neet
  from responses where response_id is not null
)"""

OUTCOME_COLS = ["job_employed", "job_start_date", "job_tenure_months", "job_tenure_days", "job_tenure_wks",
                "job_seasonal", "job_temporary", "job_satis_overall_pos", "job_satis_advance_pos",
                "job_satis_precarity_pos", *cb.BENEFIT_NAMES, "job_benefits_n", "job_benefits_any",
                "job_annualized_salary", "educ_enrolled", "neet", "survey_tag"]

OUTCOMES_F = """outcomes_j AS (
  select o.* from outcomes_h o join survey_roster r on o.response_id = r.response_id
),
outcomes_f AS (
  select enrollment_id, wave, version, response_id,
    """ + ",\n    ".join(
    f"first_value({c} ignore nulls) over w as {c}" for c in OUTCOME_COLS) + """
  from outcomes_j
  window w as (partition by enrollment_id, wave order by version, response_id
               rows between unbounded preceding and unbounded following)
)"""

ITEMS = [f"emp_hope_1_{i}" for i in range(1, cb.SCALE_ITEMS + 1)]


def repair_long_sql() -> str:
    parts = []
    for i in range(1, panel.REPAIR_ITEMS + 1):
        for o in range(1, panel.REPAIR_OPTIONS + 1):
            item = min(i, cb.SCALE_ITEMS)
            parts.append(f"select response_id, cast({item} as integer) as ehs_item, {o} as option, "
                         f"Q115_{i}_{o} as ehs_item_response from repair")
    return "repair_long AS (\n  " + "\n  union all\n  ".join(parts) + "\n)"


REPAIR_WIDE = "repair_wide AS (\n  select response_id,\n    " + ",\n    ".join(
    f"avg(case when ehs_item = {i} then cast(ehs_item_response as double) end) as emp_hope_1_{i}"
    for i in range(1, cb.SCALE_ITEMS + 1)) + "\n  from repair_long group by response_id\n)"


def _block(name, lo, hi, prefix="i"):
    cols = [f"{prefix}{k}" for k in range(lo, hi + 1)]
    return f"({' + '.join(cols)}) / {float(len(cols))}"


_ANY_NULL = " or ".join(f"i{k} is null" for k in range(1, cb.SCALE_ITEMS + 1))

SCORED = """scored_items AS (
  select s.enrollment_id, s.response_id, s.wave, s.version, """ + tag_sql("s.survey_name") + """ as survey_tag,
    """ + ",\n    ".join(
    f"case when u.response_id is not null then u.emp_hope_1_{k} "
    f"else cast(try_cast(r.emp_hope_1_{k} as int) - 1 as double) end as i{k}" for k in range(1, cb.SCALE_ITEMS + 1)) + """
  from survey_roster s left join responses r on s.response_id = r.response_id
  left join repair_wide u on s.response_id = u.response_id and s.wave = 1 and s.version = 2
),
scored AS (
  select enrollment_id, response_id, wave, version, survey_tag,
    """ + ",\n    ".join(
    f"case when {_ANY_NULL} then null else {_block(n, lo, hi)} end as {n}" for n, lo, hi in cb.SCALE_DOMAINS) + """
  from scored_items
)"""

DOMAINS = [n for n, _, _ in cb.SCALE_DOMAINS]

HOPE = """hope AS (
  select enrollment_id, wave, survey_tag,
    """ + ",\n    ".join(f"{first_nm(d, 'version, response_id')} as {d}" for d in DOMAINS) + """
  from scored where wave <= 3 group by enrollment_id, wave, survey_tag
)"""


def with_hope(body: str, extra: str = "", population: bool = False) -> str:
    ctes = ",\n".join(x for x in [pop_chain() if population else "", repair_long_sql(), REPAIR_WIDE, SCORED,
                                  HOPE, extra] if x)
    return panel.with_panel(body, roster_=population, repair_=True, extra=ctes)


def pop_chain() -> str:
    """roster_clean -> baseline -> root -> flags -> pop, for population filters."""
    return ",\n".join([PANEL_CLEAN, BASELINE, ROOT, REPORT_FLAGS, POP])



SATIS_RAW = {2: [f"satis_{j}" for j in range(1, 7)], 3: [f"satis_{j}" for j in range(1, 6)]}


def top_box_sql(w: int) -> str:
    raw = SATIS_RAW[w]
    names = cb.SATISFACTION_NAMES[w]
    mx = ",\n    ".join(f"case when bool_and({r} is not null) then max(try_cast({r} as int)) end as mx_{n}"
                        for r, n in zip(raw, names))
    flags = ",\n    ".join(f"(m.mx_{n} - try_cast(r.{raw_} as int)) <= 1 as {n}" for raw_, n in zip(raw, names))
    return f"""tb{w}_max AS (
  select version,
    {mx}
  from responses where wave = {w} and response_id is not null group by version
),
tb{w} AS (
  select r.enrollment_id, r.response_id, r.version,
    {flags}
  from responses r join tb{w}_max m on r.version = m.version
  where r.wave = {w} and r.response_id is not null
),
sat{w} AS (
  select enrollment_id,
    """ + ",\n    ".join(f"{first_nm(n, 'version, response_id')} as {n}" for n in names) + f"""
  from tb{w} group by enrollment_id
)"""


SATIS = top_box_sql(2) + ",\n" + top_box_sql(3) + ",\n" + """satis AS (
  select coalesce(a.enrollment_id, b.enrollment_id) as enrollment_id, """ + ", ".join(
    f"a.{n}" for n in cb.SATISFACTION_NAMES[2]) + ", " + ", ".join(f"b.{n}" for n in cb.SATISFACTION_NAMES[3]) + """
  from sat2 a full join sat3 b on a.enrollment_id = b.enrollment_id
)"""


def values_map(mapping: dict, kname: str = "k", vname: str = "v") -> str:
    rows = ", ".join(f"({q(k)}, {v if isinstance(v, int) else q(v)})" for k, v in mapping.items())
    return f"(values {rows}) as m({kname}, {vname})"


def gender_sql(sex, trans, g):
    return (f"case when {sex} = 'Male' and {trans} = 'No' then 'Man' "
            f"when {sex} = 'Female' and {trans} = 'No' then 'Woman' "
            f"when {regex_hit(g, cb.GENDER_MAN_PATTERN)} then 'Man' "
            f"when {regex_hit(g, cb.GENDER_WOMAN_PATTERN)} then 'Woman' "
            f"when {g} is null then null else 'Other' end")


def trans_sql(t):
    return (f"case when {t} is null then null when {t} = 'Prefer not to answer' then null "
            f"when {t} = 'No' then false else true end")


def band_sql(a):
    br, lab = cb.AGE_BREAKS, cb.AGE_LABELS
    return "case " + " ".join(f"when {a} > {lo} and {a} <= {hi} then {q(l)}"
                              for lo, hi, l in zip(br[:-1], br[1:], lab)) + " end"


def pse_sql(e):
    return f"case when {e} is null then null when {e} in {in_list(cb.EDUCATION_PSE_LEVELS)} then true else false end"


def sel_flag_sql(opts, no_opt, only):
    n = count_present(opts)
    cond = f"{no_opt} is not null and {n} = 1" if only else f"{no_opt} is not null"
    return f"case when {n} = 0 then null when {cond} then false else true end"


# ---------------------------------------------------------------------------
# Oracle per query
# ---------------------------------------------------------------------------


def flag_summary_sql():
    flags = [f for f, _ in cb.QUARTERLY_LABELS]
    labels = ", ".join(f"({q(f)}, {q(l)}, {i + 1})" for i, (f, l) in enumerate(cb.QUARTERLY_LABELS))
    return with_pop(f"""
, long AS (
  {union_long('pop', ['enrollment_id'], flags)}
), g AS (
  select var, count(*) as n_total, cast(sum(cast(val as int)) as bigint) as n from long
  where val is not null group by var
)
select split_part(l.lab, '--', 1) as cat, substr(l.lab, strpos(l.lab, '--') + 2) as var,
  l.var_order, g.n_total, g.n, g.n / g.n_total as p
from g join (values {labels}) l(var, lab, var_order) on g.var = l.var
""")


def sample_size_sql():
    return with_pop(", x AS (select 1) select count(*) as n from pop")


def sample_table_sql():
    return with_pop("""
, cells AS (select cohort_name, assignment_label_fct as arm, count(*) as n, min(date_of_enrollment) as first from pop group by 1, 2),
wide AS (
  select cohort_name, max(case when arm = 'Program' then n end) as "Program",
    max(case when arm = 'Non-RCT' then n end) as "Non-RCT", cast(sum(n) as bigint) as "Total", min(first) as first_enrolled
  from cells group by cohort_name
)
select * from wide
union all
select 'Total', cast(sum("Program") as bigint), cast(sum("Non-RCT") as bigint), cast(sum("Total") as bigint), null from wide
""")


def education_distribution_sql():
    ranks = {lab: i + 1 for i, lab in enumerate(cb.EDUCATION_LEVELS)}
    return with_pop(f"""
, g AS (select educ_max_fct, count(*) as n from pop where educ_max_fct is not null group by 1)
select g.educ_max_fct as baseline_highest_education, cast(m.v as integer) as level_order,
  cast(sum(n) over () as bigint) as n_total, n, n / sum(n) over () as p
from g left join {values_map(ranks)} on g.educ_max_fct = m.k
""")


def _quarter_flags(k):
    return f"""qf AS (
  select *, {fy_sql('date_of_enrollment', k)} as enrollment_fy, {fq_sql('date_of_enrollment', k)} as enrollment_fq,
    not demo_immigrant_lgl as demo_born_in_canada, demo_age >= 65 as demo_old_lgl_q
  from flags
)"""


def flag_by_arm_sql():
    labels = dict(cb.QUARTER_DEMO_LABELS)
    cols = [f for f, _ in cb.QUARTER_DEMO_LABELS]
    parts = []
    for c in cols:
        src = "demo_old_lgl_q" if c == "demo_old_lgl" else c
        parts.append(f"select enrollment_fy, enrollment_fq, assignment_label_fct as arm, {q(c)} as var, {src} as val from qf")
    long = "\n  union all\n  ".join(parts)
    piv = ",\n  ".join(f"max(case when arm = {q(l)} then pct_n end) as {qi(l)}" for l in cb.ARM_LEVELS)
    return with_root(f"""
, long AS (
  {long}
), g AS (
  select enrollment_fy, enrollment_fq, arm, var, count(*) as n_all, cast(sum(cast(val as int)) as bigint) as n_yes
  from long where val is not null group by 1, 2, 3, 4
), c AS (
  select g.*, {pct_cell_sql('n_yes', 'n_all')} as pct_n, m.v as lab
  from g left join {values_map(labels)} on g.var = m.k
)
select enrollment_fy, enrollment_fq, lab,
  {piv}
from c group by enrollment_fy, enrollment_fq, lab
""", REPORT_FLAGS + ",\n" + _quarter_flags(cb.FISCAL_START_DEMOGRAPHICS))


def category_crosstab_sql():
    piv = ",\n  ".join(f"coalesce(max(case when arm = {q(l)} then pct_n end), '') as {qi(l)}" for l in cb.ARM_LEVELS)
    k = cb.FISCAL_START_DEMOGRAPHICS
    return with_root(f"""
, g AS (
  select {fy_sql('date_of_enrollment', k)} as enrollment_fy, {fq_sql('date_of_enrollment', k)} as enrollment_fq,
    demo_province_fct as lab, assignment_label_fct as arm, count(*) as n
  from root where demo_province_fct is not null group by 1, 2, 3, 4
), s AS (
  select *, sum(n) over (partition by enrollment_fy, enrollment_fq, arm) as n_arm from g
), c AS (select *, {pct_cell_sql('n', 'n_arm')} as pct_n from s)
select enrollment_fy, enrollment_fq, lab,
  {piv}
from c group by 1, 2, 3
""")


def label_lookup_sql():
    names = cb.SATISFACTION_NAMES[2] + cb.SATISFACTION_NAMES[3]
    return with_hope_satis(f"""
, long AS (
  {union_long('satis', ['enrollment_id'], names)}
), lab AS (select l.*, m.v as lab from long l left join {values_map(cb.SATISFACTION_LABELS)} on l.var = m.k
  where l.enrollment_id in (select enrollment_id from pop))
select lab, count(*) as n_total, cast(sum(cast(val as int)) as bigint) as n,
  cast(sum(cast(val as int)) as bigint) / count(*) as p
from lab where val is not null group by lab
""", population=True)


def satisfaction_by_variable_sql():
    names = cb.SATISFACTION_NAMES[2] + cb.SATISFACTION_NAMES[3]
    return with_hope_satis(f"""
, long AS (
  {union_long('satis', ['enrollment_id'], names)}
)
select var as lab, count(*) as n_total, cast(sum(cast(val as int)) as bigint) as n,
  cast(sum(cast(val as int)) as bigint) / count(*) as p
from long where val is not null and enrollment_id in (select enrollment_id from pop) group by var
""", population=True)


def read_through_sql():
    return panel.with_panel("""
select *, assignment_label_fct in ('Program', 'Non-RCT') as program_eligible from panel_clean
""", extra=PANEL_CLEAN)


def landed_responses_sql():
    return panel.with_panel("""
select response_id, 'SV_' || wave || version as survey_id, wave as survey_time, version as survey_version,
  case when version = 1 then job_salary_text end as job_salary_text,
  case when version = 2 then job_salary_num end as job_salary_num
from responses
""", roster_=False)


def with_hope_satis(body: str, population: bool = False) -> str:
    extra = (pop_chain() + ",\n" + SATIS) if population else SATIS
    return panel.with_panel(body, roster_=population, extra=extra)


def scale_by_wave_sql():
    return with_hope(f"""
, long AS (
  {union_long('hope', ['enrollment_id', 'wave', 'survey_tag'], DOMAINS)}
)
select m.v as lab, survey_tag, min(wave) as tag_order, count(*) as "N",
  {rnd('avg(val)')} as mean, {rnd('stddev_samp(val)')} as sd
from long l left join {values_map(cb.EHS_DOMAIN_LABELS)} on l.var = m.k
where val is not null and enrollment_id in (select enrollment_id from pop) group by m.v, survey_tag
""", population=True)


def scale_trend_sql():
    avgs = ", ".join(f"avg({d}) as {d}" for d in DOMAINS)
    return with_hope(f"""
, g AS (select wave, survey_tag, {avgs} from hope group by wave, survey_tag),
long AS (
  {union_long('g', ['wave', 'survey_tag'], DOMAINS, 'ehs_domain', 'avg_score')}
)
select wave, survey_tag, ehs_domain, {rnd('avg_score')} as avg_score from long
""")


def effect_size_sql():
    return with_hope(f"""
, long AS (
  {union_long('hope', ['enrollment_id', 'wave'], DOMAINS, 'ehs_domain', 'score')}
), g AS (
  select ehs_domain, wave, count(score) as n, avg(score) as score_mean, stddev_samp(score) as score_sd_t
  from long group by 1, 2
), p AS (
  select *, case when count(case when score_sd_t is null then 1 end) over (partition by ehs_domain) = 0
    then sum(score_sd_t * n) over (partition by ehs_domain) / sum(n) over (partition by ehs_domain) end as score_sd_p,
    score_mean - lag(score_mean) over (partition by ehs_domain order by wave) as score_delta
  from g
)
select ehs_domain, wave, n, {rnd('score_mean')} as score_mean, {rnd('score_sd_t')} as score_sd_t,
  {rnd('score_sd_p')} as score_sd_p, {rnd('score_delta')} as score_delta,
  {rnd('case when score_sd_p = 0 then null else score_delta / score_sd_p end')} as score_delta_cohen
from p
""")


def with_outcomes(body: str, filled: bool = True, population: bool = False) -> str:
    extra = OUTCOMES_H + (",\n" + OUTCOMES_F if filled else "")
    if population:
        extra = pop_chain() + ",\n" + extra
    return panel.with_panel(body, roster_=filled or population, extra=extra)


def employment_status_sql():
    return with_outcomes(f"""
, g AS (
  select survey_tag, case when survey_tag = '12-month-follow-up' then 1000 else min(wave) end as tag_order,
    count(*) as "N", avg(cast(job_employed as int)) as e, avg(cast(educ_enrolled as int)) as en
  from outcomes_f where job_employed is not null and enrollment_id in (select enrollment_id from pop)
  group by survey_tag
)
select survey_tag, tag_order, "N", {rnd('e')} as "Employed", {rnd('en')} as "Enrolled", {rnd('1 - e - en')} as "NEET" from g
""", population=True)


def compensation_sql():
    ben = [n for n in cb.BENEFIT_NAMES if n != "job_benefits_none"]
    cols = ",\n  ".join(f"{rnd(f'avg(cast({n} as double))')} as {n.replace('job_benefits', '')}" for n in ben)
    return with_outcomes(f"""
select survey_tag, case when survey_tag = '12-month-follow-up' then 1000 else min(wave) end as tag_order,
  count(*) as "N", {rnd('avg(job_annualized_salary)')} as annualized_salary,
  {cols},
  {rnd('avg(cast(job_benefits_any as double))')} as _any,
  {rnd('avg(cast(job_benefits_n as double))')} as _total
from outcomes_f where coalesce(job_employed, false) and enrollment_id in (select enrollment_id from pop)
group by survey_tag
""", population=True)


def missing_rate_sql():
    return panel.with_panel(f"""
select cohort_name, {rnd('avg(cast(cohort_start_date is null as int))')} as start_missing
from roster_clean group by cohort_name
""", responses_=False, extra=ROSTER_CLEAN)


def value_counts_sql():
    return panel.with_panel("select version, job_report_salary, count(*) as n from responses group by 1, 2",
                            roster_=False)


def id_length_audit_sql():
    return panel.with_panel(f"""
select province, count(*) as n, {rnd('avg(length(pas_id))')} as mean_len,
  cast(max(length(pas_id)) as integer) as max_len, cast(max(length(substr(pas_id, 1, 15))) as integer) as max_len_kept
from roster where pas_id is not null and length(pas_id) > 0 group by province
""", responses_=False)


def assignment_label_sql():
    return panel.with_panel(f"""
select enrollment_id, pas_id, cohort_name, assignment_label_fct,
  assignment_label_fct in {in_list(cb.ELIGIBLE_ARMS)} as program_eligible
from roster_clean
""", responses_=False, extra=ROSTER_CLEAN)


def recode_levels_sql():
    ranks = {lab: i + 1 for i, lab in enumerate(cb.EDUCATION_LEVELS)}
    return panel.with_panel(f"""
, e AS (
  select response_id, wave,
    case when wave = 1 then {education_sql('try_cast(education_highest as int)')} end as educ_max_fct
  from responses
)
select response_id, wave, educ_max_fct, cast(m.v as integer) as educ_rank,
  educ_max_fct = {q(cb.EDUCATION_LEVELS[1])} as educ_hs_lgl, {pse_sql('educ_max_fct')} as educ_pse_lgl
from e left join {values_map(ranks)} on e.educ_max_fct = m.k
""", roster_=False)


def classify_text_sql():
    return panel.with_panel(f"""
select response_id, {gender_sql('demo_sex', 'demo_transgender', 'demo_gender')} as demo_gender_fct,
  {trans_sql('demo_transgender')} as demo_transgender_lgl,
  {regex_hit('job_satisfaction_overall', cb.SATISFACTION_POSITIVE_PATTERN)} as job_satis_overall_pos,
  not {regex_hit('demo_marital', cb.MARRIED_PATTERN)} as not_married
from responses
""", roster_=False)


def age_bands_sql():
    dob = date_from_parts("birth_year", "birth_month")
    age = years_between(dob, "date_of_enrollment")
    return panel.with_panel(f"""
select enrollment_id, {dob} as demo_date_of_birth, {age} as demo_age, {band_sql(age)} as demo_age_fct from roster
""", responses_=False)


def date_parts_sql():
    mid = (f"case when birth_year is null or birth_month is null or birth_month not between 1 and 12 then null "
           f"else make_date(birth_year, birth_month, 15) end")
    return panel.with_panel(f"""
select enrollment_id, birth_year, birth_month, {date_from_parts('birth_year', 'birth_month')} as birth_date,
  {mid} as birth_mid_month from roster
""", responses_=False)


def recency_flag_sql():
    return panel.with_panel("""
select r.response_id, r.demo_born_in_canada = 'No' as demo_immigrant_lgl,
  cast(year(c.date_of_enrollment) - r.demo_year_of_arrival as integer) as years_since_arrival,
  case when (r.demo_born_in_canada = 'No') is null then null when r.demo_year_of_arrival is null then null
       when year(c.date_of_enrollment) - r.demo_year_of_arrival <= 5 then true else false end as demo_newcomer_lgl
from responses r join survey_roster c on r.response_id = c.response_id
""")


def flag_algebra_sql():
    body = """
select response_id, demo_income_source_fct, demo_receiving_ei_lgl, demo_receiving_ia_lgl,
  cast(demo_receiving_ei_lgl as int) + cast(demo_receiving_ia_lgl as int) = 0 as demo_receiving_none_lgl,
  demo_parent_lgl, demo_single_parent_lgl, demo_bipoc_lgl, demo_indigenous_lgl, demo_racialized_lgl
from baseline_h
"""
    return panel.with_panel(body, extra=PANEL_CLEAN + ",\n" + BASELINE_ALL)


def outcome_flags_sql():
    return with_outcomes("""
select response_id, job_employed, job_seasonal, job_temporary, job_satis_overall_pos, job_satis_advance_pos,
  job_satis_precarity_pos, educ_enrolled, neet from outcomes_h
""", filled=False)


def annualize_pay_sql():
    return with_outcomes("select response_id, version, job_annualized_salary from outcomes_h", filled=False)


def tenure_weeks_sql():
    return with_outcomes(f"""
select response_id, job_start_date, job_tenure_months, job_tenure_days, {rnd('job_tenure_wks')} as job_tenure_wks
from outcomes_h
""", filled=False)


def benefit_count_sql():
    raw = [f"s.opt_{k}" for k in range(1, 7)]
    return panel.with_panel(f"""
, p AS (select response_id, {_EMPLOYED} as job_employed from responses)
select p.response_id, p.job_employed,
  {benefits_sql(raw, 'p.job_employed')}
from p left join selections s on p.response_id = s.response_id
""", roster_=False, selections_=True)


def multi_select_any_sql():
    opts = [f"opt_{k}" for k in range(1, 8)]
    return panel.with_panel(f"""
select response_id, {count_present(opts)} as n_selected,
  {sel_flag_sql(opts, 'opt_2', False)} as flag_excluding_2,
  {sel_flag_sql(opts, 'opt_7', True)} as flag_unless_only_7,
  {count_present(opts)} > 0 as any_selected
from selections
""", roster_=False, responses_=False, selections_=True)


def parse_numbers_sql():
    return panel.with_panel(f"""
select enrollment_id, acct_text, {parse_number_sql('acct_text')} as acct_value,
  try_cast(regexp_replace(acct_text, '[$ A-Z]', '', 'g') as integer) as acct_int,
  try_cast(acct_text as integer) as acct_junk_int
from roster
""", responses_=False)


def fiscal_quarter_sql():
    return panel.with_panel(f"""
select response_id, response_date, {fy_sql('response_date', 3)} as fy_mar, {fq_sql('response_date', 3)} as fq_mar,
  {fy_sql('response_date', 4)} as fy_apr, {fq_sql('response_date', 4)} as fq_apr
from responses
""", roster_=False)


def report_window_sql():
    lo, hi = cb.REPORT_WINDOW
    k = cb.FISCAL_START_QUARTERLY
    return panel.with_panel(f"""
select enrollment_id, date_of_enrollment, {fy_sql('date_of_enrollment', k)} as enrollment_fy,
  {fq_sql('date_of_enrollment', k)} as enrollment_fq,
  date_of_enrollment between date '{lo}' and date '{hi}' as in_window
from roster
""", responses_=False)


def fill_default_sql():
    return panel.with_panel("""
select response_id, coalesce(amount, 0.0) as amount, coalesce(status_answer, 'unknown') as status_answer,
  coalesce(rating, 0) as rating from responses
""", roster_=False)


def survey_catalog_sql():
    return panel.with_panel(f"""
select survey_name, count(*) as n_responses,
  try_cast(nullif(regexp_extract(survey_name, '_s(\\d{{2}})', 1), '') as integer) as survey_time,
  try_cast(nullif(regexp_extract(survey_name, '_0\\.0\\.(\\d)', 1), '') as integer) as survey_version,
  {tag_sql('survey_name')} as survey_tag
from responses group by survey_name
""", roster_=False)


def label_order_sql():
    levels = [*panel.WAVE_TAGS, cb.LAST_WAVE_TAG]
    vals = ", ".join(f"({q(x)})" for x in levels)
    return panel.with_panel(f"""
, g AS (
  select {tag_sql('survey_name')} as survey_tag,
    median(date_diff('day', date '1970-01-01', response_date)) as median_day,
    min(wave) as first_wave, count(*) as n
  from responses group by 1
)
select coalesce(l.survey_tag, g.survey_tag) as survey_tag, cast(g.median_day as double) as median_day,
  g.first_wave, coalesce(g.n, 0) as n
from (values {vals}) l(survey_tag) full join g on l.survey_tag = g.survey_tag
""", roster_=False)


def regex_select_sql():
    cols = ["response_id"] + [f"demo_indigenous_{i}" for i in range(1, 4)] + [f"demo_race_{i}" for i in range(1, 7)]
    return panel.with_panel(f"select {', '.join(cols)} from responses", roster_=False)


def clean_names_sql():
    return ("select c_custkey as cust_key, c_name as customer_name, c_nationkey as nation_key, "
            "c_acctbal as acct_bal, c_mktsegment as mkt_segment from customer")


def drop_all_null_sql():
    cols = [n for n, _ in panel.ROSTER_COLUMNS if n != "vip_note"]
    return panel.with_panel(f"select {', '.join(cols)} from roster", responses_=False)


def primary_record_sql():
    return ("select l_orderkey as response_id, max(case when l_linenumber = 1 then l_quantity end) as job_qty, "
            "max(case when l_linenumber = 1 then l_returnflag end) as job_flag from lineitem group by l_orderkey")


def flatten_records_sql():
    return ("select o_orderkey as order_id, o_totalprice as total_price, o_orderstatus as status, "
            "c_name as customer_name, c_mktsegment as segment, c_nationkey as nation_key "
            "from orders left join customer on o_custkey = c_custkey")


def json_access_sql():
    return "select event_id, try_cast(json_extract_string(props, '$.k') as integer) as k from events"


def relationship_extract_sql():
    return ("select c_custkey as customer_id, c_name as customer_name, c_mktsegment as segment, "
            "n_name as nation_name, r_name as region_name from customer "
            "left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey "
            "where c_mktsegment in ('BUILDING', 'MACHINERY', 'HOUSEHOLD')")


def left_join_suffix_sql():
    return panel.with_panel("""
select r.response_id, r.qx_survey_id, r.enrollment_id as enrollment_id_sf, r.cohort_name,
  p.enrollment_id as enrollment_id_qx, p.demo_province
from survey_roster r left join responses p on r.response_id = p.response_id
""")


def semi_join_sql():
    return panel.with_panel(f"""
select response_id, enrollment_id, {fy_sql('response_date', 4)} as fy, {fq_sql('response_date', 4)} as fq
from responses where enrollment_id in (
  select enrollment_id from roster_clean where assignment_label_fct <> {q(cb.ARM_DEFAULT)})
""", extra=ROSTER_CLEAN)


def rows_update_sql():
    cols = ",\n  ".join(
        f"{rnd(f'case when u.response_id is not null then u.{c} else cast(r.{c} as double) end')} as {c}"
        for c in ITEMS)
    return panel.with_panel(f"""
select r.response_id,
  {cols}
from responses r left join repair_wide u on r.response_id = u.response_id
""", roster_=False, repair_=True, extra=repair_long_sql() + ",\n" + REPAIR_WIDE)


def full_join_waves_sql():
    return with_hope_satis("select * from satis")


def union_by_name_sql():
    return panel.with_panel("""
select response_id, wave, demo_parent, job_salary_text, cast(rating as varchar) as code
from responses where version = 1
union all by name
select response_id, wave, demo_caregiver, job_salary_num, status_answer as code
from responses where version = 2
""", roster_=False)


def split_dispatch_sql():
    return panel.with_panel(f"""
select response_id, version, job_salary_text, cast({salary_v1()} as double) as job_annualized_salary
from responses where version = 1
union all by name
select response_id, version, job_report_salary, cast({salary_v2()} as double) as job_annualized_salary
from responses where version = 2
""", roster_=False)


def consolidate_baseline_sql():
    return with_root("select * from root")


def fill_within_group_sql():
    cols = [c for c in OUTCOME_COLS if c not in ("job_tenure_wks", "job_annualized_salary")]
    return with_outcomes(f"""
select enrollment_id, wave, version, response_id, {', '.join(cols)},
  {rnd('job_tenure_wks')} as job_tenure_wks, {rnd('job_annualized_salary')} as job_annualized_salary
from outcomes_f
""")


def nest_history_sql():
    return with_hope(f"""
select enrollment_id, cast(count(*) as integer) as n_waves, string_agg(cast(wave as varchar), ',' order by wave) as waves,
  {rnd('first(ehs_empowerment order by wave, survey_tag)')} as first_empowerment
from hope group by enrollment_id
""")


def unnest_history_sql():
    return with_hope("select enrollment_id, wave, survey_tag, " + ", ".join(
        f"{rnd(d)} as {d}" for d in DOMAINS) + " from hope")


def unpivot_items_sql():
    return panel.with_panel("select * from repair_long", roster_=False, responses_=False, repair_=True,
                            extra=repair_long_sql())


def pivot_items_sql():
    return panel.with_panel("select response_id, " + ", ".join(f"{rnd(c)} as {c}" for c in ITEMS)
                            + " from repair_wide", roster_=False, responses_=False, repair_=True,
                            extra=repair_long_sql() + ",\n" + REPAIR_WIDE)


def score_scale_sql():
    return panel.with_panel("select enrollment_id, response_id, wave, version, " + ", ".join(
        f"{rnd(d)} as {d}" for d in DOMAINS) + " from scored", roster_=False, repair_=True,
        extra=",\n".join([repair_long_sql(), REPAIR_WIDE, SCORED]))


def top_box_sql_q():
    return panel.with_panel("""
select *, 2 as wave from tb2
union all by name
select *, 3 as wave from tb3
""", roster_=False, extra=top_box_sql(2) + ",\n" + top_box_sql(3))


def assemble_participant_sql():
    extra = ",\n".join([PANEL_CLEAN, BASELINE, ROOT, repair_long_sql(), REPAIR_WIDE, SCORED, HOPE, SATIS,
                        OUTCOMES_H, OUTCOMES_F])
    return panel.with_panel("""
select r.enrollment_id, r.assignment_label_fct, r.demo_age, h.n_ehs, o.n_outcomes,
  s.satis_inmotion_overall, s.satis_m_plus_overall
from root r
left join (select enrollment_id, cast(count(*) as integer) as n_ehs from hope group by 1) h on r.enrollment_id = h.enrollment_id
left join (select enrollment_id, cast(count(distinct wave) as integer) as n_outcomes from outcomes_f group by 1) o
  on r.enrollment_id = o.enrollment_id
left join satis s on r.enrollment_id = s.enrollment_id
""", repair_=True, extra=extra)


def latest_snapshot_sql():
    return panel.with_panel("""
, p AS (select response_id, survey_name, year(response_date) as snapshot from responses)
select response_id, survey_name, cast(snapshot as integer) as snapshot from p
where (survey_name, snapshot) in (select survey_name, max(snapshot) from p group by survey_name)
""", roster_=False)


def snapshot_roundtrip_sql():
    """The round trip returns the cleaned roster unchanged."""
    return panel.with_panel(f"""
select *, assignment_label_fct in {in_list(cb.ELIGIBLE_ARMS)} as program_eligible from roster_clean
""", responses_=False, extra=ROSTER_CLEAN)


def drop_last_rows_sql():
    return panel.with_panel("""
select response_id, enrollment_id, wave from responses
where response_id not in (select response_id from responses order by wave desc, response_id desc limit 2)
""", roster_=False)


ORACLE = {
    "quarterly_table": quarterly_table_sql(),
    "quarterly_report": quarterly_table_sql(
        f"date_of_enrollment between date '{cb.REPORT_WINDOW[0]}' and date '{cb.REPORT_WINDOW[1]}'"),
    "flag_summary": flag_summary_sql(),
    "flag_by_arm": flag_by_arm_sql(),
    "category_crosstab": category_crosstab_sql(),
    "quarter_demographics": f"select * from ({flag_by_arm_sql()}) union all by name select * from ({category_crosstab_sql()})",
    "sample_table": sample_table_sql(),
    "sample_size": sample_size_sql(),
    "education_distribution": education_distribution_sql(),
    "recode_levels": recode_levels_sql(),
    "assignment_label": assignment_label_sql(),
    "classify_text": classify_text_sql(),
    "age_bands": age_bands_sql(),
    "recency_flag": recency_flag_sql(),
    "multi_select_any": multi_select_any_sql(),
    "benefit_count": benefit_count_sql(),
    "flag_algebra": flag_algebra_sql(),
    "outcome_flags": outcome_flags_sql(),
    "annualize_pay": annualize_pay_sql(),
    "parse_numbers": parse_numbers_sql(),
    "date_parts": date_parts_sql(),
    "tenure_weeks": tenure_weeks_sql(),
    "fiscal_quarter": fiscal_quarter_sql(),
    "report_window": report_window_sql(),
    "survey_catalog": survey_catalog_sql(),
    "label_lookup": label_lookup_sql(),
    "label_order": label_order_sql(),
    "satisfaction_by_variable": satisfaction_by_variable_sql(),
    "read_through": read_through_sql(),
    "unlike_records": """
select 'order' as source, cast(o_orderkey as varchar) as "Id", c_name as "Customer_Name", c_mktsegment as "Customer_Segment",
  cast(c_nationkey as bigint) as "Customer_Nation_Key", o_totalprice as "TotalPrice", o_orderstatus as "Status",
  cast(null as bigint) as "Nation_Key", cast(null as varchar) as "Nation_parts", cast(null as bigint) as "props_k"
from orders left join customer on o_custkey = c_custkey
union all by name
select 'event' as source, cast(event_id as varchar) as "Id", cast(json_extract(props, '$.k') as bigint) as "props_k" from events
union all by name
select 'supplier' as source, '"' || s_name || '"' as "Id", cast(s_nationkey as bigint) as "Nation_Key",
  '[{"part":' || s_suppkey || '},{"part":' || (s_suppkey + 1) || '}]' as "Nation_parts" from supplier
""",
    "colocated_panel": consolidate_baseline_sql(),
    "accounted_join": panel.with_panel("""
select 'joined, wave ' || wave as what, count(*) as n from responses join survey_roster using (response_id) group by responses.wave
union all select 'matched', count(*) from responses join survey_roster using (response_id)
union all select 'no_roster', count(*) from responses anti join survey_roster using (response_id)
union all select 'no_response', count(*) from survey_roster anti join responses using (response_id)
""".replace("|| wave", "|| responses.wave"), roster_=False),
    "median_amount": panel.with_panel(f"""
select {tag_sql('survey_name')} as survey_tag, version, {rnd('median(amount)')} as median
from responses where amount is not null group by 1, 2
""", roster_=False),
    "snapshot_versions": panel.with_panel("""
select 1 as version, wave, count(*) as n from survey_roster group by wave
union all select 2, wave, count(*) from survey_roster where wave <= 2 group by wave
union all select 0, null, 0
""", roster_=False),
    "materialized_panel": consolidate_baseline_sql(),
    "landed_responses": landed_responses_sql(),
    "csv_crosstab": category_crosstab_sql(),
    "fill_default": fill_default_sql(),
    "id_length_audit": id_length_audit_sql(),
    "regex_select": regex_select_sql(),
    "clean_names": clean_names_sql(),
    "drop_all_null": drop_all_null_sql(),
    "primary_record": primary_record_sql(),
    "flatten_records": flatten_records_sql(),
    "json_access": json_access_sql(),
    "relationship_extract": relationship_extract_sql(),
    "left_join_suffix": left_join_suffix_sql(),
    "semi_join": semi_join_sql(),
    "rows_update": rows_update_sql(),
    "full_join_waves": full_join_waves_sql(),
    "assemble_participant": assemble_participant_sql(),
    "union_by_name": union_by_name_sql(),
    "split_dispatch": split_dispatch_sql(),
    "consolidate_baseline": consolidate_baseline_sql(),
    "fill_within_group": fill_within_group_sql(),
    "nest_history": nest_history_sql(),
    "unnest_history": unnest_history_sql(),
    "unpivot_items": unpivot_items_sql(),
    "pivot_items": pivot_items_sql(),
    "score_scale": score_scale_sql(),
    "top_box": top_box_sql_q(),
    "scale_by_wave": scale_by_wave_sql(),
    "scale_trend": scale_trend_sql(),
    "effect_size": effect_size_sql(),
    "employment_status": employment_status_sql(),
    "compensation": compensation_sql(),
    "missing_rate": missing_rate_sql(),
    "value_counts": value_counts_sql(),
    "latest_snapshot": latest_snapshot_sql(),
    "drop_last_rows": drop_last_rows_sql(),
    "snapshot_roundtrip": snapshot_roundtrip_sql(),
    # CSV keeps every cell (no cell is an empty string); NULL cells come back NULL
    "csv_roundtrip": quarterly_table_sql(),
}
