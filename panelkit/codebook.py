"""Codebooks: the questionnaire-specific values every operator is parameterised by.

Operators never hard-code survey names; they take a ``Codebook`` (or one of the
small mappings below).  The defaults reproduce the reports the library was
built to replace.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the original questionnaire/report values for
# identical output; they are stated here once, in their natural order.
# ---------------------------------------------------------------------------

# Arm labels, in display order.  The arm is the suffix of the cohort name.
ARM_LEVELS = ["Program", "Comparison", "Non-RCT"]
ARM_SUFFIX_PATTERN = "(Program|Comparison)$"
ARM_SUFFIX_REMOVE_PATTERN = " - (Program|Comparison)$"
ARM_DEFAULT = "Non-RCT"
TOTAL_LABEL = "Total"
# Levels counted as programme-eligible (see README, decision D1).
ELIGIBLE_ARMS = ["Program", "Non-RCT"]

# Highest-education codes 1..7 -> ordered labels.
EDUCATION_LEVELS = [
    "Less than Highschool",
    "Highschool",
    "Apprenticeship or College",
    "Undergraduate Degree",
    "Graduate Degree",
]
EDUCATION_PSE_LEVELS = ["Apprenticeship or College", "Undergraduate Degree", "Graduate Degree"]
EDUCATION_DOMESTIC_ANSWER = "In Canada"

GENDER_LEVELS = ["Woman", "Man", "Other"]
GENDER_MAN_PATTERN = "Male|Man"
GENDER_WOMAN_PATTERN = "Female|Woman"

# Age bands: right-closed bins (0,20], (20,30], (30,40], (40,60], (60,100].
AGE_BREAKS = [0, 20, 30, 40, 60, 100]
AGE_LABELS = ["20 or younger", "21 to 30", "31 to 40", "41 to 60", "61 or older"]

INCOME_NONE = "None of the Above"
INCOME_EI = "Employment Insurance"
HOME_PROVINCE = "Saskatchewan"
NEWCOMER_YEARS = 5
MARRIED_PATTERN = "married|common-law"

# Employment-hope scale: 14 items -> four domain means (1-based item ranges).
SCALE_DOMAINS = [
    ("ehs_empowerment", 1, 4),
    ("ehs_motivation", 5, 6),
    ("ehs_utilization", 7, 10),
    ("ehs_goal_orientation", 11, 14),
]
SCALE_ITEMS = 14

# Benefit select-all options, positional.
BENEFIT_NAMES = [
    "job_benefits_health",
    "job_benefits_dental",
    "job_benefits_disability",
    "job_benefits_pension",
    "job_benefits_vacation",
    "job_benefits_none",
]
# Options counted in the benefit total (health .. vacation).
BENEFIT_COUNTED = BENEFIT_NAMES[:5]

# Pay-period multipliers for annualising a reported salary.
PAY_PERIOD_MULTIPLIER = {
    "Yearly": 1,
    "Monthly": 12,
    "Weekly": 52,
    "Semimonthly (twice per month)": 24,
    "Biweekly (every two weeks)": 26,
}
HOURS_WEEKS_PER_YEAR = 52

SATISFACTION_POSITIVE_PATTERN = "Agree|Strongly agree"

# Programme-satisfaction columns by wave, positional.
SATISFACTION_NAMES = {
    2: [
        "satis_inmotion_overall",
        "satis_momentum_overall",
        "satis_inmotion_utility",
        "satis_momentum_utility",
        "satis_inmotion_recommend",
        "satis_momentum_recommend",
    ],
    3: [
        "satis_m_plus_overall",
        "satis_immm_plus_overall",
        "satis_m_plus_utility",
        "satis_immm_plus_utility",
        "satis_immm_plus_recommend",
    ],
}

# Quarterly-table flags and their "Category--Label" strings, in report order.
QUARTERLY_LABELS = [
    ("demo_immigrant_lgl", "Migration--Immigrant"),
    ("demo_newcomer_lgl", "Migration--Newcomer (< 5 years in Canada)"),
    ("demo_born_in_canada_lgl", "Migration--Born in Canada"),
    ("demo_receiving_ei_lgl", "Financial Assistance--Receiving EI"),
    ("demo_receiving_ia_lgl", "Financial Assistance--Receiving Social Assistance"),
    ("demo_receiving_none_lgl", "Financial Assistance--None of the Above"),
    ("demo_young_lgl", "Age--Youth (< 30)"),
    ("demo_middle_age_lgl", "Age--Middle Age (30-64)"),
    ("demo_old_lgl", "Age--Older (> 64)"),
    ("demo_racialized_lgl", "Marginalization Factors--Racialized"),
    ("demo_indigenous_lgl", "Marginalization Factors--Indigenous"),
    ("demo_bipoc_lgl", "Marginalization Factors--BIPOC"),
    ("demo_disability_lgl", "Marginalization Factors--Disability"),
    ("demo_woman_plus_lgl", "Marginalization Factors--Woman+"),
    ("demo_mf_none_lgl", "Marginalization Factors--None of the Above"),
]
# Flags summed for "Marginalization Factors--None of the Above".
MARGINALIZATION_FLAGS = [
    "demo_racialized_lgl",
    "demo_indigenous_lgl",
    "demo_bipoc_lgl",
    "demo_disability_lgl",
    "demo_woman_plus_lgl",
]

# Quarter-demographics labels (one-quarter table, no category).
QUARTER_DEMO_LABELS = [
    ("demo_born_in_canada", "Born in Canada"),
    ("demo_immigrant_lgl", "Immigrant"),
    ("demo_newcomer_lgl", "Newcomer (< 5 years in Canada)"),
    ("demo_indigenous_lgl", "Indigenous"),
    ("demo_racialized_lgl", "Racialized"),
    ("demo_bipoc_lgl", "BIPOC"),
    ("demo_disability_lgl", "Disability"),
    ("demo_young_lgl", "Youth (< 30)"),
    ("demo_old_lgl", "Older (> 64)"),
    ("demo_woman_plus_lgl", "Woman+"),
]

# Survey-name grammar: <prefix>_0.0.<version>_..._s<2-digit wave>_<tag>.
SURVEY_WAVE_PATTERN = r"(?<=_s)\d{2}"
SURVEY_VERSION_PATTERN = r"(?<=_0\.0\.)\d"
SURVEY_TAG_PATTERN = r"(?<=s\d{2}_).*$"

# Repair-file item columns: Q115_<item>_<option>.
REPAIR_ITEM_PATTERN = "Q115_(.*)_(.*)"

# Satisfaction labels of one report; unlabelled variables pool into a NULL label.
SATISFACTION_LABELS = {
    "satis_immm_plus_overall": "Satisfied",
    "satis_immm_plus_utility": "Found IMMM+ useful",
    "satis_immm_plus_recommend": "Would recommend IMMM+",
}

EHS_DOMAIN_LABELS = {
    "ehs_empowerment": "Psychological Empowerment",
    "ehs_motivation": "Forward-looking Self-motivation",
    "ehs_utilization": "Utilization of Skills and Resources",
    "ehs_goal_orientation": "Goal-orientation",
}

# Wave tag that is always placed last in wave-ordered outcome tables.
LAST_WAVE_TAG = "12-month-follow-up"

# Report populations: the province reports exclude the comparison arm.
REPORT_EXCLUDED_ARM = "Comparison"
# Quarterly report window and fiscal starts.
REPORT_WINDOW = ("2024-03-01", "2024-06-30")
FISCAL_START_QUARTERLY = 3
FISCAL_START_DEMOGRAPHICS = 4


# ---------------------------------------------------------------------------
# Codebook object: what varies between studies.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Codebook:
    """Column names and answer codes of one study.

    Only names are stored; operators build Column expressions from them, so a
    codebook is free to ship to the driver and never touches data.
    """

    id_col: str = "enrollment_id"
    response_col: str = "response_id"
    wave_col: str = "wave"
    version_col: str = "version"
    # v2 select-all option columns.
    indigenous_options: tuple[str, ...] = ("demo_indigenous_1", "demo_indigenous_2", "demo_indigenous_3")
    indigenous_no_option: str = "demo_indigenous_2"
    race_options: tuple[str, ...] = tuple(f"demo_race_{i}" for i in range(1, 12))
    race_not_racialized_option: str = "demo_race_10"
    home_province: str = HOME_PROVINCE
    eligible_arms: tuple[str, ...] = tuple(ELIGIBLE_ARMS)

    def check_arity(self, names: list[str], available: list[str], what: str,
                    fewer: bool = False) -> list[str]:
        """Positional rename guard: as many columns as names.

        ``fewer`` allows a shorter block, whose columns take the first names;
        elsewhere one absent middle question would shift all later names.
        """
        if len(available) > len(names) or (len(available) < len(names) and not fewer):
            raise ValueError(f"{what}: {len(available)} columns for {len(names)} names in the codebook")
        return names[: len(available)]


DEFAULT_CODEBOOK = Codebook()
