"""Scale scores, item repair, programme satisfaction and effect sizes."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import codebook as cb
from ..codebook import DEFAULT_CODEBOOK, Codebook
from ..functions import logic
from ..operators import reshape
from ..operators.aggregate import strict_max
from ..operators.joins import rows_update

ITEM_PREFIX = "emp_hope_1_"
ITEMS = [f"{ITEM_PREFIX}{i}" for i in range(1, cb.SCALE_ITEMS + 1)]


# --- H13: item repair file ----------------------------------------------------


def repair_long(repair: DataFrame, pattern: str = cb.REPAIR_ITEM_PATTERN, cap_item: int = cb.SCALE_ITEMS,
                id_col: str = "response_id") -> DataFrame:
    """Wide repair file -> (id, ehs_item, option, ehs_item_response).

    Item numbers above ``cap_item`` collapse onto it.
    """
    long = reshape.unpivot_pattern(repair, [id_col], pattern, ["ehs_item", "option"], "ehs_item_response")
    return long.withColumn("ehs_item", logic.cap(F.col("ehs_item").try_cast("int"), cap_item))


def repair_items(repair: DataFrame, pattern: str = cb.REPAIR_ITEM_PATTERN, cap_item: int = cb.SCALE_ITEMS,
                 id_col: str = "response_id") -> DataFrame:
    """Item value = mean of the item's option answers (NULL when all missing), as
    ``emp_hope_1_<item>``: one aggregate of sums and counts over the wide
    columns, without unpivoting them."""
    options: dict[int, list[Column]] = {}
    for c in repair.columns:
        m = re.fullmatch(pattern, c)
        if m and m[1].isdigit():
            options.setdefault(min(int(m[1]), cap_item), []).append(F.col(c).try_cast("double"))
    aggs = []
    for item in range(1, cap_item + 1):
        cells = options.get(item, [F.lit(None).cast("double")])
        total = F.sum(sum((F.coalesce(c, F.lit(0.0)) for c in cells), F.lit(0.0)))
        known = F.sum(sum((c.isNotNull().cast("int") for c in cells), F.lit(0)))
        aggs.append(F.when(known > 0, total / known).alias(f"{ITEM_PREFIX}{item}"))
    return repair.groupBy(id_col).agg(*aggs)


def pivot_repair_items(repair: DataFrame, id_col: str = "response_id") -> DataFrame:
    """The same through the long form: mean per (id, item), pivoted on explicit levels."""
    long = repair_long(repair, id_col=id_col)
    return reshape.pivot_named(
        long, [id_col], "ehs_item", list(range(1, cb.SCALE_ITEMS + 1)),
        F.avg(F.col("ehs_item_response").try_cast("double")), ITEM_PREFIX + "{}")


# --- H12: scale score ---------------------------------------------------------


def score_scale(responses: DataFrame, repair: DataFrame | None = None,
                book: Codebook = DEFAULT_CODEBOOK, strict: bool = True) -> DataFrame:
    """Items shifted by -1, repaired for intake v2 from the repair file (repair
    values are not shifted), then four block means; strict: any missing item
    makes every domain missing.  Rows without answers are kept."""
    w, v = F.col(book.wave_col), F.col(book.version_col)
    d = responses.withColumns({c: F.col(c).try_cast("int") - 1 for c in ITEMS}).withColumns(
        {c: F.col(c).cast("double") for c in ITEMS})
    if repair is not None:
        # Survey rows come from a join on the response id and are dealt by it:
        # the repair file is the one side that this join exchanges.
        d = rows_update(d, repair_items(repair), [book.response_col], where=(w == 1) & (v == 2))
    return d.select(book.id_col, book.response_col, book.wave_col, book.version_col,
                    *[c for c in ("survey_tag",) if c in d.columns],
                    *logic.block_means(ITEMS, cb.SCALE_DOMAINS, strict=strict))


DOMAINS = [name for name, _, _ in cb.SCALE_DOMAINS]


# --- H22: programme satisfaction top-two-box ---------------------------------


def satisfaction_top_box(df: DataFrame, wave: int, raw: Sequence[str],
                         book: Codebook = DEFAULT_CODEBOOK, strict: bool = True) -> DataFrame:
    """Within each survey (wave, version): flag = (max code observed - code) <= 1.

    Columns are renamed positionally from the codebook.  ``strict``: one
    missing answer in a survey makes that column missing for the whole survey.
    The per-survey maxima are a one-row-per-survey aggregate (bounded by the
    codebook's survey list), joined back with a broadcast.
    """
    names = book.check_arity(cb.SATISFACTION_NAMES[wave], list(raw), f"satisfaction wave {wave}")
    rows = df.filter((F.col(book.wave_col) == wave) & F.col(book.response_col).isNotNull())
    codes = rows.select(book.id_col, book.response_col, book.version_col,
                        *[F.col(r).try_cast("int").alias(n) for r, n in zip(raw, names)])
    mx = codes.groupBy(book.version_col).agg(
        *[(strict_max(n) if strict else F.max(n)).alias(f"__max_{n}") for n in names])
    # null-safe: rows without a version form a survey of their own
    mx = mx.withColumnRenamed(book.version_col, "__v")
    j = codes.join(F.broadcast(mx), F.col(book.version_col).eqNullSafe(F.col("__v")))
    return j.select(book.id_col, book.response_col, book.version_col,
                    *[((F.col(f"__max_{n}") - F.col(n)) <= 1).alias(n) for n in names])


def satisfaction_top_box_waves(df: DataFrame, waves: dict[int, Sequence[str]],
                               book: Codebook = DEFAULT_CODEBOOK, strict: bool = True) -> DataFrame:
    """Top-box flags of several waves in one pass: one row per response of those
    waves, with every wave's (positionally renamed) columns, NULL outside the
    response's own wave.  Equivalent to stacking ``satisfaction_top_box`` per
    wave by name, with one scan and one maxima aggregate keyed by survey
    (wave, version) -- bounded by the codebook's survey list, so broadcast.
    """
    w, v = book.wave_col, book.version_col
    raw_all = sorted({r for raw in waves.values() for r in raw}, key=lambda r: (len(r), r))
    rows = df.filter(F.col(w).isin(list(waves)) & F.col(book.response_col).isNotNull())
    codes = rows.select(book.id_col, book.response_col, w, v,
                        *[F.col(r).try_cast("int").alias(r) for r in raw_all])
    mx = codes.groupBy(w, v).agg(*[(strict_max(r) if strict else F.max(r)).alias(f"__max_{r}") for r in raw_all])
    mx = mx.withColumnsRenamed({w: "__w", v: "__v"})
    j = codes.join(F.broadcast(mx), (F.col(w) == F.col("__w")) & F.col(v).eqNullSafe(F.col("__v")))
    flags = []
    for wave, raw in waves.items():
        names = book.check_arity(cb.SATISFACTION_NAMES[wave], list(raw), f"satisfaction wave {wave}")
        flags += [F.when(F.col(w) == wave, (F.col(f"__max_{r}") - F.col(r)) <= 1).alias(n)
                  for r, n in zip(raw, names)]
    return j.select(book.id_col, book.response_col, v, w, *flags)


# --- T10: wave-to-wave effect size ------------------------------------------


def effect_size(long: DataFrame, domain: str = "ehs_domain", wave: str = "wave",
                value: str = "score") -> DataFrame:
    """Per (domain, wave): n, mean, sd; pooled sd = n-weighted mean of the sds
    over the domain's waves; delta = mean - previous wave's mean; cohen = delta
    / pooled sd.  Windows run on the aggregated (domain x wave) rows only."""
    g = long.groupBy(domain, wave).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("score_mean"),
        F.stddev_samp(value).alias("score_sd_t"),
    )
    wd = Window.partitionBy(domain)
    # weighted mean without NA skipping: one missing sd makes the pooled sd missing
    pooled = F.when(
        F.count(F.when(F.col("score_sd_t").isNull(), 1)).over(wd) == 0,
        F.try_divide(F.sum(F.col("score_sd_t") * F.col("n")).over(wd), F.sum("n").over(wd)))
    g = g.withColumn("score_sd_p", pooled)
    delta = F.col("score_mean") - F.lag("score_mean").over(Window.partitionBy(domain).orderBy(wave))
    return g.withColumn("score_delta", delta).withColumn(
        "score_delta_cohen", F.try_divide(F.col("score_delta"), F.col("score_sd_p")))
