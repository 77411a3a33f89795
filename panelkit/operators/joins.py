"""Join and stacking operators with explicit key and missing-value rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def left_join_suffix(left: DataFrame, right: DataFrame, by: Sequence[str],
                     suffix: tuple[str, str] = ("_x", "_y"), null_keys_match: bool = False,
                     how: str = "left") -> DataFrame:
    """Left join on ``by``; non-key columns present on both sides get suffixes.

    ``null_keys_match=True`` makes a NULL key match a NULL key (null-safe
    equality); by default NULL keys never match.
    """
    by = list(by)
    clash = (set(left.columns) & set(right.columns)) - set(by)
    lren = {c: c + suffix[0] for c in left.columns if c in clash}
    rren = {c: c + suffix[1] for c in right.columns if c in clash}
    lf = left.withColumnsRenamed(lren) if lren else left
    rt = right.withColumnsRenamed(rren) if rren else right
    if null_keys_match:
        rk = rt.select(*[F.col(k).alias(f"__rk_{k}") for k in by],
                       *[c for c in rt.columns if c not in by])
        cond = [lf[k].eqNullSafe(rk[f"__rk_{k}"]) for k in by]
        out = lf.join(rk, cond, how)
        return out.drop(*[f"__rk_{k}" for k in by])
    return lf.join(rt, by, how)


def rows_update(x: DataFrame, y: DataFrame, by: Sequence[str], where: Column | None = None) -> DataFrame:
    """Keyed overwrite: rows of ``x`` matched in ``y`` take y's values of the
    shared columns -- missing values included; unmatched y rows are ignored.

    Columns of ``y`` that ``x`` lacks are refused when the plan is built; a key
    that ``y`` holds twice stops the job, since x rows would otherwise fan out.
    (The check is an aggregate on the join key: it shares the join's shuffle.)
    A marker column distinguishes "matched with NULL value" from "not matched",
    which ``coalesce`` cannot.  ``where`` (a condition on x) limits which rows
    may be updated, so a subset is updated in the same pass instead of split +
    union.
    """
    by = list(by)
    unknown = [c for c in y.columns if c not in x.columns]
    if unknown:
        raise ValueError(f"columns to update that x does not have: {unknown}")
    upd = [c for c in y.columns if c not in by]
    once = F.when(F.count(F.lit(1)) == 1, True).otherwise(
        F.raise_error(F.lit(f"rows_update: a key of {by} occurs more than once in y")).cast("boolean"))
    yy = y.groupBy(*by).agg(*[F.first(c).alias(f"__y_{c}") for c in upd], once.alias("__matched"))
    j = x.join(yy, by, "left")
    hit = F.coalesce(F.col("__matched"), F.lit(False))
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    return j.select(*[
        (F.when(hit, F.col(f"__y_{c}")).otherwise(F.col(c)).alias(c) if c in upd else F.col(c))
        for c in x.columns
    ])


_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _digits(t: T.DataType) -> tuple[int, int]:
    """Digits before and after the point that a whole number or decimal type can hold."""
    return (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE[type(t)], 0)


def _common_type(types: list[T.DataType]) -> T.DataType:
    """A type that holds the values of all ``types``.

    Whole numbers widen to the larger one, with decimals to a decimal that has
    room for both; with a double all become doubles; dates with timestamps
    become timestamps; anything else becomes text.
    """
    if all(t == types[0] for t in types):
        return types[0]
    if all(isinstance(t, T.NumericType) for t in types):
        if any(isinstance(t, (T.DoubleType, T.FloatType)) for t in types):
            return T.DoubleType()
        if not any(isinstance(t, T.DecimalType) for t in types):
            return max(types, key=lambda t: _WHOLE[type(t)])
        whole, scale = (max(_digits(t)[i] for t in types) for i in (0, 1))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if all(isinstance(t, (T.DateType, T.TimestampType)) for t in types):
        return T.TimestampType()
    return T.StringType()


def _aligned(f: T.StructField, to: T.DataType) -> Column:
    """The column as ``to``; a whole number or decimal that no double equals stops the job."""
    c = F.col(f"`{f.name}`")
    if f.dataType == to:
        return c
    out = c.cast(to)
    if isinstance(to, T.DoubleType) and isinstance(f.dataType, (T.LongType, T.DecimalType)):
        same = out.try_cast(f.dataType) == c
        if isinstance(f.dataType, T.LongType):
            same = same & (c != 2**63 - 1)  # the double 2**63 turns back into this long
        lost = F.raise_error(F.concat(F.lit(f"union_by_name: {f.name} = "), c.cast("string"), F.lit(" is no double")))
        out = F.when(c.isNull() | same, out).otherwise(lost.cast("double"))
    return out.alias(f.name)


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name, filling absent columns with NULL.

    Columns whose types differ between parts are first aligned to a common type
    that loses no value (ANSI mode refuses int/string unions); where whole
    numbers or decimals meet doubles, a value that a double cannot hold stops
    the job.
    """
    parts = list(parts)
    if len(parts) == 1:
        return parts[0]
    types: dict[str, list[T.DataType]] = {}
    for p in parts:
        for f in p.schema.fields:
            types.setdefault(f.name, []).append(f.dataType)
    target = {n: _common_type(ts) for n, ts in types.items()}
    aligned = [p.select(*[_aligned(f, target[f.name]) for f in p.schema.fields]) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def full_join_on(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join on one key, the key coalesced from both sides.

    Both sides are aliased, so frames derived from the same source (a
    self-join) resolve unambiguously.
    """
    lf, rt = left.alias("__l"), right.alias("__r")
    out = lf.join(rt, F.col(f"__l.`{key}`") == F.col(f"__r.`{key}`"), "full")
    rest = ([F.col(f"__l.`{c}`") for c in left.columns if c != key]
            + [F.col(f"__r.`{c}`") for c in right.columns if c != key])
    return out.select(F.coalesce(F.col(f"__l.`{key}`"), F.col(f"__r.`{key}`")).alias(key), *rest)


def semi_join(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of ``left`` with a match in ``right`` (no fan-out, right cols dropped)."""
    return left.join(right.select(*by), list(by), "left_semi")


# --- rows accounted for ----------------------------------------------------------


def counted_filter(df: DataFrame, cond: Column, counts: Observation) -> DataFrame:
    """Rows where ``cond`` is true; ``counts`` is told ``kept``, ``dropped`` (false) and ``unknown`` (NULL)."""
    seen = df.withColumn("__cond", cond)
    one = lambda c, n: F.count_if(c).alias(n)
    seen = seen.observe(counts, one(F.col("__cond"), "kept"), one(~F.col("__cond"), "dropped"), one(F.col("__cond").isNull(), "unknown"))
    return seen.filter("__cond").drop("__cond")


def counted_inner_join(left: DataFrame, right: DataFrame, by: Sequence[str], counts: Observation,
                       names: tuple[str, str] = ("left_only", "right_only")) -> DataFrame:
    """Inner join on ``by`` that accounts for every row of both sides.

    ``counts`` is told the ``matched`` rows and, under ``names``, the rows of
    either side that found no partner (NULL keys among them).  It is planned as
    a full join of which the matched rows go on, so the counts cost neither a
    scan nor an exchange.  Rows with a NULL key are spread by a hash of the key
    and all their columns, not sent to one task.
    """
    by = list(by)
    rest = [c for c in right.columns if c not in by]

    def side(df: DataFrame, tag: str) -> DataFrame:
        null = F.lit(False)
        for k in by:
            null = null | F.col(f"`{k}`").isNull()
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(1 << 20)) + 1
        return df.withColumns({f"__{tag}": F.lit(True), f"__{tag}_salt": F.when(null, spread).otherwise(F.lit(0).cast("long"))})

    lf = side(left, "l")
    rt = side(right, "r").withColumnsRenamed({k: f"__r_{k}" for k in by})
    on = [F.col(f"`{k}`") == F.col(f"`__r_{k}`") for k in by] + [F.col("__l_salt") == F.col("__r_salt")]
    both = lf.join(rt, on, "full")
    here = [F.col("__l").isNotNull(), F.col("__r").isNotNull()]
    both = both.observe(counts, F.count_if(here[0] & here[1]).alias("matched"), F.count_if(~here[1]).alias(names[0]), F.count_if(~here[0]).alias(names[1]))
    return both.filter(here[0] & here[1]).select(*[F.col(f"`{c}`") for c in [*by, *[c for c in left.columns if c not in by], *rest]])
