"""The assembled participant table in one pass over roster and responses.

``pipeline.assemble`` joins four tables that each join, harmonise and
consolidate the same rows.  Here roster rows and responses meet once, in a full
join on the response id; every joined row carries what it adds to each of the
four (baseline, hope, outcomes, satisfaction), and one aggregate per
participant, wave and tag folds all of them together.  What is left, a few rows
a participant, is merged and nested after one more exchange.

The fold is combined map-side, so a participant who holds a third of all rows is
a few rows a task before the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codebook as cb
from ..codebook import DEFAULT_CODEBOOK, Codebook
from ..functions import logic
from ..sources.catalog import survey_fields
from . import harmonise, pipeline, scales

_SALTS = 1024
_BENEFITS = tuple(f"job_benefits_{i}" for i in range(1, 7))
_OUTCOMES = [*harmonise.OUTCOME_COLUMNS, "survey_tag"]


def _keyed(roster: DataFrame, repair: DataFrame | None, book: Codebook) -> DataFrame:
    """Roster rows as ``r_*`` with the scores of their repaired items ``q_*``, keyed by ``k_id`` and ``k_salt``.

    The salt spreads rows without a response id, which meet no response.
    """
    own = [book.id_col, book.wave_col, book.version_col, "survey_name"]
    rid = F.col(book.response_col)
    r = harmonise.clean_roster(roster, book)
    spread = F.pmod(F.xxhash64(*own), F.lit(_SALTS)).cast("int")
    r = r.select(rid.alias("k_id"), F.when(rid.isNull(), spread).otherwise(0).alias("k_salt"), F.lit(True).alias("r_here"),
                 *[F.col(c).alias(f"r_{c}") for c in own], "cohort_name", "date_of_enrollment", "assignment_label_fct")
    if repair is None:
        return r.withColumns({f"q_{c}": F.lit(None).cast("double") for c in scales.DOMAINS} | {"q_here": F.lit(False)})
    fixed = scales.repair_items(repair)
    fixed = fixed.select(F.col(book.response_col).alias("q_id"), F.when(F.col(book.response_col).isNull(), 1).otherwise(0).alias("q_salt"),
                         F.lit(True).alias("q_here"), *[c.alias(f"q_{n}") for n, c in zip(scales.DOMAINS, logic.block_means(scales.ITEMS, cb.SCALE_DOMAINS))])
    target = (F.col(f"r_{book.wave_col}") == 1) & (F.col(f"r_{book.version_col}") == 2)
    on = (F.col("k_id") == F.col("q_id")) & (F.col("k_salt") == F.col("q_salt")) & target
    return r.join(fixed, on, "left").drop("q_id", "q_salt")


def _answers(responses: DataFrame, book: Codebook, satisfaction: bool) -> DataFrame:
    """Responses with an id, keyed like the roster rows, as ``p_*``.

    All that needs the response alone is harmonised, scored and flagged here,
    so that the join moves a few narrow columns instead of the raw answers.
    """
    w, v = F.col(book.wave_col), F.col(book.version_col)
    p = harmonise.primary_job(responses.filter(F.col(book.response_col).isNotNull()))
    code = lambda r: F.col(r).try_cast("int")
    flags = []
    if satisfaction:
        raw_all = sorted({r for raw in pipeline.SATIS_RAW.values() for r in raw})
        # one row a survey
        best = p.filter(w.isin(list(pipeline.SATIS_RAW))).groupBy(w.alias("m_wave"), v.alias("m_version")).agg(
            *[F.when(F.bool_and(code(r).isNotNull()), F.max(code(r))).alias(f"m_{r}") for r in raw_all])
        p = p.join(F.broadcast(best), (w == F.col("m_wave")) & v.eqNullSafe(F.col("m_version")), "left")
        flags = [F.when(w == wave, (F.col(f"m_{r}") - code(r)) <= 1).alias(f"s_{name}")
                 for wave, raw in pipeline.SATIS_RAW.items() for r, name in zip(raw, pipeline.cb_satis_names(wave, raw, book))]
    asked = ((w == 1) | ((w <= 3) & (v == 2))) & ((w == 1) | (F.col("demos") == "FALSE"))
    items = [(code(c) - 1).cast("double") for c in scales.ITEMS]
    rid = F.col(book.response_col)
    own = [rid.alias("p_id"), F.when(rid.isNull(), 1).otherwise(0).alias("p_salt"), F.lit(True).alias("p_here"),
           F.col(book.id_col).alias("p_own"), w.alias("p_w"), v.alias("p_v"), F.coalesce(asked, F.lit(False)).alias("p_base"),
           *[c.alias(f"b_{n}") for n, c in harmonise.baseline_answers(book).items()], F.col("demo_year_of_arrival").alias("p_arrival"),
           *[c.alias(f"p_{n}") for n, c in zip(scales.DOMAINS, logic.block_means(items, cb.SCALE_DOMAINS))], *flags]
    out = p.select(*own, *harmonise._outcome_columns(book, (), _BENEFITS), survey_fields(F.col("survey_name"))["survey_tag"].alias("survey_tag"))
    return out.drop(book.id_col).withColumnsRenamed({c: f"o_{c}" for c in _OUTCOMES})


def _first(c: str, there: Column, order: str) -> Column:
    """Aggregate: the value at the least ``order`` of the rows ``there`` that have one."""
    return F.min_by(c, F.when(there & F.col(c).isNotNull(), F.col(order))).alias(c)


PARTS = ("hope", "outcomes", "satisfaction")


def participants(roster: DataFrame, responses: DataFrame, repair: DataFrame | None = None,
                 book: Codebook = DEFAULT_CODEBOOK, parts: Sequence[str] = PARTS, counts: bool = False,
                 outcome_columns: Sequence[str] | None = None) -> DataFrame:
    """root <- hope <- outcomes <- satisfaction, one row per participant with a baseline.

    Equal to ``pipeline.assemble`` of the four tables, or of the baseline with
    the ``parts`` asked for: a report over participants and their history reads
    what it needs from here, filters, and unnests.  With ``counts`` an outcome
    also has ``n_rows``, the responses it stands for.  ``outcome_columns`` names
    the outcomes wanted: nested columns are not pruned from above.  Roster rows and
    responses are unique in the response id; a row whose two sides name
    different participants or waves counts for each under its own.  Defined
    cases: a NULL participant has a baseline but no history, as NULL keys never
    join; without history the arrays are NULL; an empty roster gives no rows.
    """
    own, wave, version = book.id_col, book.wave_col, book.version_col
    r = _keyed(roster, repair if "hope" in parts else None, book)
    p = _answers(responses, book, "satisfaction" in parts)
    # rows without a partner count for the scores (roster rows) and for satisfaction (responses)
    how = {(True, True): "full", (True, False): "left", (False, True): "right", (False, False): "inner"}["hope" in parts, "satisfaction" in parts]
    both = r.join(p, (F.col("k_id") == F.col("p_id")) & (F.col("k_salt") == F.col("p_salt")), how)

    base, outs = harmonise.BASELINE_COLUMNS[1:], list(outcome_columns or _OUTCOMES)
    satis = [n for wv, raw in pipeline.SATIS_RAW.items() for n in pipeline.cb_satis_names(wv, raw, book)] if "satisfaction" in parts else []
    scored = F.col("r_here") & (F.col(f"r_{wave}") <= 3) if "hope" in parts else F.lit(False)
    matched = F.coalesce(F.col("r_here") & F.col("p_here"), F.lit(False))
    late = harmonise.baseline_at_enrolment(F.col("b_demo_date_of_birth"), F.col("b_demo_immigrant_lgl"), F.col("p_arrival"), F.col("date_of_enrollment"))
    given = {c: F.col(c) for c in ("cohort_name", "date_of_enrollment", "assignment_label_fct")}
    rows = both.select(
        (matched & F.col("p_base")).alias("is_base"), matched.alias("is_out"),
        F.coalesce(scored, F.lit(False)).alias("is_hope"),
        F.coalesce(F.col("p_here"), F.lit(False)).alias("is_answer"),
        F.col(f"r_{own}").alias("r_own"), F.col(f"r_{wave}").alias("r_w"), F.col(f"r_{version}").alias("r_v"), F.col("k_id").alias("r_rid"),
        "p_own", "p_w", "p_v", F.col("p_id").alias("p_rid"), survey_fields(F.col("r_survey_name"))["survey_tag"].alias("r_tag"),
        *[c.alias(f"b_{n}") for n, c in (late | given).items()], *[f"b_{n}" for n in base if n not in late and n not in given],
        *[f"o_{c}" for c in outs], *[F.when(F.col("q_here"), F.col(f"q_{c}")).otherwise(F.col(f"p_{c}")).alias(c) for c in scales.DOMAINS],
        *[f"s_{n}" for n in satis])

    # Answers count under the participant and wave of the response, scores under those (and the tag) of the roster row.
    place = lambda kind, who, wv, tg: F.struct(F.lit(kind).alias("kind"), who.alias("own"), wv.alias("w"), tg.alias("tag"))
    answers = place(0, F.col("p_own"), F.col("p_w"), F.lit(None).cast("string"))
    scores = place(1, F.col("r_own"), F.col("r_w"), F.col("r_tag"))
    placed = (F.when(F.col("is_hope") & F.col("is_answer"), F.array(answers, scores))
              .when(F.col("is_hope"), F.array(scores)).otherwise(F.array(answers)))
    order = F.when(F.col("kind") == 0, F.struct(F.col("p_v").alias("v"), F.col("p_rid").alias("id"))).otherwise(F.struct(F.col("r_v").alias("v"), F.col("r_rid").alias("id")))
    rows = rows.filter("is_hope OR is_answer")
    rows = rows.select("*", F.inline(placed)) if "hope" in parts else rows.select("*", *[answers[c].alias(c) for c in ("kind", "own", "w", "tag")])
    rows = rows.withColumn("ord", order)
    answer, hope = F.col("kind") == 0, F.col("kind") == 1
    folded = rows.groupBy("own", "w", "kind", "tag").agg(
        F.count_if(answer & F.col("is_base")).alias("n_base"), F.count_if(answer & F.col("is_out")).alias("n_out"),
        *[_first(f"b_{c}", answer & F.col("is_base"), "ord") for c in base],
        *[_first(f"o_{c}", answer & F.col("is_out"), "ord") for c in outs],
        *[_first(f"s_{n}", answer, "ord") for n in satis],
        *[_first(c, hope, "ord") for c in scales.DOMAINS])

    # A few rows a participant from here on.  A satisfaction variable belongs to one wave.
    score = F.struct(F.col("w").alias("wave"), F.col("tag").alias("survey_tag"), *scales.DOMAINS)
    outcome = F.struct(F.col("w").alias("wave"), *[F.col(f"o_{c}").alias(c) for c in outs], *([F.col("n_out").alias("n_rows")] if counts else []))
    people = folded.groupBy("own").agg(
        F.sum("n_base").alias("n_base"), *[_first(f"b_{c}", F.lit(True), "w").alias(c) for c in base],
        F.collect_list(F.when(hope, score)).alias("ehs"), F.collect_list(F.when(F.col("n_out") > 0, outcome)).alias("outcomes"),
        *[F.bool_or(f"s_{n}").alias(n) for n in satis])
    known = F.col("own").isNotNull()
    nested = lambda c: F.when(known & (F.size(c) > 0), F.array_sort(c)).alias(c)
    history = [nested(c) for part, c in (("hope", "ehs"), ("outcomes", "outcomes")) if part in parts]
    return people.filter("n_base > 0").select(F.col("own").alias(own), *base, *history, *[F.when(known, F.col(n)).alias(n) for n in satis])
