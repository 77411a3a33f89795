"""Panel assembly: responses x roster -> consolidated participant-level tables.

Responses meet the roster on the response id, which is unique on both sides;
the first-non-missing aggregates then shuffle on ``enrollment_id`` after a
map-side combine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..codebook import DEFAULT_CODEBOOK, Codebook
from ..operators import joins
from ..operators.aggregate import consolidate
from ..operators.joins import union_by_name
from .harmonise import BASELINE_COLUMNS, clean_roster, harmonise_baseline

ORDER = ["wave", "version", "response_id"]


ROSTER_FIELDS = ("cohort_name", "date_of_enrollment", "assignment_label_fct")


def roster_fields(roster: DataFrame, book: Codebook = DEFAULT_CODEBOOK,
                  roster_cols: Sequence[str] = ROSTER_FIELDS) -> DataFrame:
    """The response id and the cleaned fields of every roster row that the panel takes."""
    return clean_roster(roster, book).select(book.response_col, *roster_cols)


def join_panel(roster: DataFrame, responses: DataFrame, book: Codebook = DEFAULT_CODEBOOK,
               roster_cols: Sequence[str] = ROSTER_FIELDS,
               counts: Observation | None = None) -> DataFrame:
    """Every response with the roster fields of its survey row (inner: rows
    without a response or without a roster entry cannot be harmonised).

    ``counts`` is told, by the next action on the result and without a job of
    its own, how many rows were ``matched``, how many responses had
    ``no_roster`` row and how many roster rows had ``no_response``.

    Both sides are unique in the response id, so the join deals rows out evenly
    however many of them one participant has; the per-participant aggregates
    that follow shuffle after their map-side combine.
    """
    r = roster_fields(roster, book, roster_cols)
    if counts is None:
        return responses.join(r, book.response_col, "inner")
    return joins.counted_inner_join(responses, r, [book.response_col], counts, ("no_roster", "no_response"))


def survey_rows(roster: DataFrame, responses: DataFrame, book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """Every roster row (participant x survey) with its answers, NULL without a response."""
    own = [book.id_col, book.response_col, book.wave_col, book.version_col, "survey_name"]
    answers = responses.drop(*[c for c in own if c != book.response_col])
    return roster.select(*own).join(answers, book.response_col, "left")


def baseline_rows(joined: DataFrame, book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """Responses that feed the baseline: intake, or an early wave of version 2."""
    w, v = F.col(book.wave_col), F.col(book.version_col)
    return joined.filter((w == 1) | ((w <= 3) & (v == 2)))


def construct_root(joined: DataFrame, book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """One row per participant: each baseline variable's first non-missing value
    in (wave, version, response id) order."""
    h = harmonise_baseline(baseline_rows(joined, book), book)
    return consolidate(h, [book.id_col], ORDER,
                       [c for c in BASELINE_COLUMNS if c != book.id_col])


def dispatch(df: DataFrame, keys: Sequence[str],
             branches: dict[tuple, Callable[[DataFrame], DataFrame]],
             default: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Apply one transform per key value (e.g. per (wave, version)) and stack.

    The key values come from the codebook, never from the data, so building
    the plan needs no job; every branch filters the same source (parquet
    pushdown prunes row groups), and results are stacked by name.  Rows with a
    key that is NULL or not listed go to ``default``; without one they stop
    the job instead of vanishing.
    """
    parts, listed = [], F.lit(False)
    for value, fn in branches.items():
        cond = F.lit(True)
        for k, v in zip(keys, value):
            cond = cond & (F.col(k) == F.lit(v))
        parts.append(fn(df.filter(cond)))
        listed = listed | cond
    rest = df.filter(~F.coalesce(listed, F.lit(False)))
    if default is not None:
        return union_by_name([*parts, default(rest)])
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    stop = F.raise_error(F.concat(F.lit(f"dispatch: no branch for {list(keys)} = "), shown))
    first = next(iter(branches.values()))
    return union_by_name([*parts, first(rest.filter(stop.cast("boolean")))])


# --- survey tag from the catalogue name -----------------------------------------


def with_survey_fields(df: DataFrame, name_col: str = "survey_name") -> DataFrame:
    """Add ``survey_time``/``survey_version``/``survey_tag`` parsed from the name."""
    from ..sources.catalog import survey_fields

    return df.withColumns(survey_fields(F.col(name_col)))


# --- H14: employment-hope history ----------------------------------------------


def hope_per_wave(surveys: DataFrame, repair: DataFrame | None,
                  book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """Scores of waves <= 3 consolidated per (participant, wave, tag): the flat
    form of the history.  ``surveys`` are the rows of :func:`survey_rows`: a
    survey without a response stays, with missing scores.  Tables that would unnest the history read this
    directly and skip the nest/unnest round trip (one aggregation less)."""
    from .scales import DOMAINS, score_scale

    early = with_survey_fields(surveys.filter(F.col(book.wave_col) <= 3))
    scored = score_scale(early, repair, book)
    return consolidate(scored, [book.id_col, "wave", "survey_tag"], ["version", "response_id"], DOMAINS)


def construct_hope(surveys: DataFrame, repair: DataFrame | None,
                   book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """One nested employment-hope history per participant (bounded: one entry
    per wave)."""
    from ..operators.reshape import nest

    return nest(hope_per_wave(surveys, repair, book), [book.id_col], ["wave", "survey_tag"], "ehs")


# --- H21: outcomes history --------------------------------------------------------


def construct_outcomes(joined: DataFrame, book: Codebook = DEFAULT_CODEBOOK, dedup: bool = False) -> DataFrame:
    """Outcomes of all waves; within (participant, wave) every column takes the
    group's first non-missing value.  Rows keep their multiplicity unless
    ``dedup`` (then one row per participant x wave)."""
    from ..operators.aggregate import fill_within
    from .harmonise import OUTCOME_COLUMNS, harmonise_outcomes

    h = with_survey_fields(harmonise_outcomes(joined, book, keep=("wave", "version", "response_id",
                                                                  "survey_name")))
    h = h.drop("survey_name", "survey_time", "survey_version")
    return fill_within(h, [book.id_col, "wave"], ["version", "response_id"],
                       OUTCOME_COLUMNS + ["survey_tag"], dedup=dedup)


def outcomes_per_wave(joined: DataFrame, book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """Outcomes consolidated per (participant, wave), with ``n_rows``: the
    responses that share them.  A table over the filled rows of
    :func:`construct_outcomes` is this one weighted by ``n_rows``, without
    joining the filled values back to the rows."""
    from ..operators.aggregate import first_non_missing
    from .harmonise import OUTCOME_COLUMNS, harmonise_outcomes

    h = with_survey_fields(harmonise_outcomes(joined, book, keep=("wave", "version", "response_id",
                                                                  "survey_name")))
    order = ["version", "response_id"]
    return h.groupBy(book.id_col, "wave").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[first_non_missing(c, order).alias(c) for c in [*OUTCOME_COLUMNS, "survey_tag"]])


def nest_outcomes(outcomes_per_wave: DataFrame, book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    from ..operators.reshape import nest

    return nest(outcomes_per_wave, [book.id_col], ["wave"], "outcomes")


# --- H23: programme satisfaction, wave 2 x wave 3 ------------------------------


SATIS_RAW = {2: [f"satis_{j}" for j in range(1, 7)], 3: [f"satis_{j}" for j in range(1, 6)]}


def construct_satis(responses: DataFrame, book: Codebook = DEFAULT_CODEBOOK,
                    method: str = "aggregate") -> DataFrame:
    """Top-box flags of wave 2 and wave 3 (each stacked over versions), one row
    per participant: wave 2 full-joined to wave 3 on the participant.

    ``method="aggregate"`` (default) computes it as ONE first-non-missing
    aggregate over the responses of both waves, each wave's columns being NULL
    on the other wave's rows: same rows and values as the full join of the two
    per-wave consolidations, without the join and with one scan.
    ``method="full_join"`` builds the two per-wave tables and full-joins them
    (1:1 after consolidation, never all pairs of a participant's rows).
    """
    from .scales import satisfaction_top_box, satisfaction_top_box_waves

    names = [n for wave in SATIS_RAW for n in cb_satis_names(wave, SATIS_RAW[wave], book)]
    if method == "aggregate":
        tb = satisfaction_top_box_waves(responses, SATIS_RAW, book)
        return consolidate(tb, [book.id_col], ["version", "response_id"], names)
    from ..operators.joins import full_join_on

    per_wave = []
    for wave, raw in SATIS_RAW.items():
        tb = satisfaction_top_box(responses, wave, raw, book)
        per_wave.append(consolidate(tb, [book.id_col], ["version", "response_id"],
                                    cb_satis_names(wave, raw, book)))
    return full_join_on(per_wave[0], per_wave[1], book.id_col)


def cb_satis_names(wave: int, raw, book: Codebook = DEFAULT_CODEBOOK) -> list[str]:
    from .. import codebook as cb

    return book.check_arity(cb.SATISFACTION_NAMES[wave], list(raw), f"satisfaction wave {wave}")


# --- H24: participant assembly ------------------------------------------------------


def assemble(root: DataFrame, hope: DataFrame, outcomes: DataFrame, satis: DataFrame,
             key: str = "enrollment_id") -> DataFrame:
    """root <- hope <- outcomes <- satisfaction: left joins on the participant key.
    Every right side is one row per key, so the chain never fans out."""
    return root.join(hope, key, "left").join(outcomes, key, "left").join(satis, key, "left")
