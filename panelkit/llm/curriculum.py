"""Mixing sources to target weights as a time-varying curriculum.

Method: every source has a weight schedule over training time 0 .. 1.  The
integral of the schedule is the source's cumulative token demand; a document
that starts at token c of its source's stream is trained at the time at which
the demand reaches c, found by inverting the integral.  Documents are then
range-sorted by that position.  DataFrame operations alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, globally_ordered, materialize, spare_prefix

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Weight schedules, repeating likewise: (time, multiplier) points, linear between them.
SCHEDULES = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)))
#: All targets together, and the most of one source, as shares of the sizes (in halves: exact).
SHARE_HALVES, MOST = 3, 2


def segments(points) -> tuple[list[tuple[float, float, float, float, float]], float]:
    """(time, weight, slope, area before, area) for each stretch, and the whole area."""
    out, area = [], 0.0
    for (t0, w0), (t1, w1) in zip(points, points[1:]):
        own = (t1 - t0) * (w0 + w1) / 2
        out.append((t0, w0, (w1 - w0) / (t1 - t0), area, own))
        area += own
    return out, area


def demand_time(share: Column, points) -> Column:
    """Time at which a schedule's cumulative demand reaches ``share`` (0 .. 1) of its whole."""
    parts, whole = segments(points)
    out = None
    for t0, w0, slope, before, own in reversed(parts):
        left = F.greatest(share * F.lit(whole) - F.lit(before), F.lit(0.0))
        # area = w0 x + slope x^2 / 2, solved for x without cancellation
        x = F.when(left > 0, left * 2.0 / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + left * F.lit(2.0 * slope), F.lit(0.0))))
                   ).otherwise(F.lit(0.0))
        time = F.lit(t0) + x
        out = time if out is None else F.when(share * F.lit(whole) < F.lit(before + own), time).otherwise(out)
    return out


def _nth(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, kind, target): shares by weight, held to MOST times the size.

    ``sizes`` has one row per source.  Sources are taken in the order of size by
    weight: the first that its fair share of what is left does not fill ends the
    capped ones; the rest share what is left by weight.  Integer comparisons.
    """
    wide = "decimal(38,0)"
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("kind", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("w", _nth(weights, F.col("kind")).cast(wide)).withColumn(
        "cap", (F.col("source_size") * MOST).cast(wide))
    whole = Window.partitionBy()
    earlier = Window.orderBy(F.col("cap") / F.col("w"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.select(
        "*", F.sum("source_size").over(whole).cast(wide).alias("all"),
        (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(earlier), F.lit(0))).cast(wide).alias("w_left"),
        F.coalesce(F.sum("cap").over(earlier), F.lit(0)).cast(wide).alias("cap_before"),
        F.row_number().over(Window.orderBy(F.col("cap") / F.col("w"), "kind")).alias("n"))
    ranked = ranked.withColumn("left2", (F.col("all") * SHARE_HALVES - F.col("cap_before") * 2).cast(wide))
    fits = F.col("left2").cast("double") * F.col("w").cast("double") <= F.col("cap").cast("double") * 2 * F.col("w_left").cast("double")
    level = F.min(F.when(fits, F.struct("n", "left2", "w_left"))).over(whole)
    ranked = ranked.withColumn("level", level)
    shared = F.col("level.left2").cast("double") / 2 * F.col("w").cast("double") / F.col("level.w_left").cast("double")
    target = F.when(F.col("level").isNull() | (F.col("n") < F.col("level.n")), F.col("cap").cast("double")).otherwise(shared)
    return ranked.select("source", "source_size", "kind", target.alias("target"))


def mix_plan(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document: id, source, size, source_size, target, taken, position, again.

    A source's stream is its documents by md5 of the id (then id, then size),
    repeated until the target is reached: ``taken`` words in all, at
    ``position`` the first time and ``again`` the second (NULL: not reached).
    The document at the end of a stream may be taken in part, so each source
    meets the whole part of its target exactly.  Defined cases: a NULL text has
    size 0 and takes no words; a NULL source is the last source; a NULL id is
    ordered as the empty text; repeated rows are documents of their own; other
    columns are not read; without any word all targets are 0.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("key"))
    ordered = globally_ordered(rows, [F.col("source").asc_nulls_last(), F.col("key"), F.col("id"), F.col("size")], "stream")
    # Running sums: inside a partition by a window, across partitions from one row a partition and source.
    pieces = materialize(ordered.groupBy("source", "_part").agg(F.sum("size").alias("_sum")), "pieces")
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    goals = targets(pieces.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights)
    pieces = pieces.withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    pieces = materialize(pieces.join(goals.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
                         .select(F.col("source").alias("_s"), F.col("_part").alias("_p"), "_offset", "source_size", "kind", "target"),
                         "offsets")
    rows = ordered.join(pieces, (F.col("_part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s")))
    inside = Window.partitionBy("_part", "source").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.col("_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    goal = F.floor("target")
    part = [F.greatest(F.least(goal - F.col("start") - F.col("source_size") * e, F.col("size")), F.lit(0)) for e in range(MOST)]

    def time(epoch: int) -> Column:
        share = (F.col("start") + F.col("source_size") * epoch).cast("double") / goal.cast("double")
        kind = F.col("kind") % len(schedules)
        out = F.lit(None).cast("double")
        for i, points in enumerate(schedules):
            out = F.when(kind == i, demand_time(share, points)).otherwise(out)
        return F.when(part[epoch] > 0, out)

    return rows.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                       sum(part[1:], part[0]).alias("taken"), part[0].alias("taken_first"),
                       time(0).alias("position"), time(1).alias("again"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The training stream: rows of ``docs`` in the order of their positions.

    A document taken twice comes twice, one not taken does not come.  One taken
    in part has the first words of its text, joined by one space, and n_chars
    (if there is such a column) set to match.  Rows of a repeated id are told
    apart by size and source, those of a NULL id among them.  Columns are those
    of ``docs``, whatever their names; an empty table gives an empty result.
    """
    p = spare_prefix(docs)
    plan = mix_plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    once = F.struct(F.col("position").alias("at"), F.col("taken_first").alias("words"))
    twice = F.struct(F.col("again").alias("at"), (F.col("taken") - F.col("taken_first")).alias("words"))
    times = F.filter(F.array(once, twice), lambda x: x["at"].isNotNull())
    plan = materialize(plan.select(F.col(id_col).alias(f"{p}id"), F.col("size").alias(f"{p}size"),
                                   F.col(source_col).alias(f"{p}src"), times.alias(f"{p}times")), "plan")
    rows = docs
    keys = F.col(id_col).eqNullSafe(F.col(f"{p}id"))
    if plan.groupBy(f"{p}id").count().filter("count > 1").limit(1).count():
        size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0))
        rows = rows.withColumn(f"{p}nth", F.row_number().over(Window.partitionBy(id_col).orderBy(size, source_col)))
        plan = plan.withColumn(f"{p}n", F.row_number().over(Window.partitionBy(f"{p}id").orderBy(f"{p}size", f"{p}src")))
        keys = keys & (F.col(f"{p}nth") == F.col(f"{p}n"))
    rows = rows.join(plan, keys).withColumn(f"{p}time", F.explode(f"{p}times"))
    words = F.slice(F.regexp_extract_all(F.col(text_col), F.lit(WORD), 0), F.lit(1), F.col(f"{p}time.words").cast("int"))
    text = F.when(F.col(f"{p}time.words") < F.col(f"{p}size"), F.array_join(words, " ")).otherwise(F.col(text_col))
    rows = rows.withColumn(f"{p}text", text)
    names = {text_col: F.col(f"{p}text").alias(text_col)}
    if "n_chars" in docs.columns:
        shortened = F.col(f"{p}time.words") < F.col(f"{p}size")
        names["n_chars"] = F.when(shortened, F.char_length(f"{p}text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    rows = rows.repartitionByRange(f"{p}time.at", id_col).sortWithinPartitions(f"{p}time.at", id_col)
    return rows.select(*[names.get(c, F.col(c)) for c in docs.columns])
