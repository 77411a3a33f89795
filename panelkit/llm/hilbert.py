"""Sharding along a Hilbert curve, with DataFrame operations alone.

Method: several metadata dimensions are quantised to equally filled levels, the
levels are folded to their index on a Hilbert curve, rows are range-sorted by
that index and the order is cut into runs.  Rows of one run are close in every
dimension, so the shards' min/max statistics prune on any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import globally_ordered, materialize, ranked, release, spare_prefix


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next state for (state, octant), flattened, by the Gray-code rule.

    A state is the entry corner and the direction of a sub-cube; the rule for
    the next one is the usual one for curves of any number of dimensions.
    """
    size = 1 << dims
    low = size - 1

    def right(x: int, by: int) -> int:
        by %= dims
        return ((x >> by) | (x << (dims - by))) & low

    gray = [i ^ (i >> 1) for i in range(size)]
    rank = {g: i for i, g in enumerate(gray)}
    entry = [0 if i == 0 else gray[2 * ((i - 1) // 2)] for i in range(size)]

    def trailing_ones(i: int) -> int:
        return ((i + 1) & ~i).bit_length() - 1

    turn = [0 if i == 0 else (trailing_ones(i - 1) if i % 2 == 0 else trailing_ones(i)) % dims for i in range(size)]
    digit, following = [], []
    for e in range(size):
        for d in range(dims):
            for octant in range(size):
                w = rank[right(octant ^ e, d + 1)]
                digit.append(w)
                e2 = e ^ right(entry[w], dims - (d + 1))
                following.append(e2 * dims + (d + turn[w] + 1) % dims)
    return digit, following


def hilbert_index(levels: list[Column], bits: int) -> Column:
    """Index on the curve of integer levels 0 .. 2**bits - 1, as a long."""
    dims = len(levels)
    digit, following = (F.array(*[F.lit(x) for x in t]) for t in curve_tables(dims))
    points = F.array(*[x.cast("int") for x in levels])
    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("s"))

    def step(state, level):
        octant = sum((F.call_function("shiftright", points[i], level).bitwiseAND(F.lit(1)) * F.lit(1 << i)
                      for i in range(dims)), F.lit(0))
        at = state["s"] * F.lit(1 << dims) + octant + 1
        return F.struct((state["h"] * F.lit(1 << dims) + F.element_at(digit, at)).alias("h"),
                        F.element_at(following, at).alias("s"))

    falling = F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)])
    return F.aggregate(falling, start, step)["h"]


def text_levels(df: DataFrame, dim: str, bits: int) -> Column:
    """Equally filled levels of a string column in code-point order; NULL stays NULL.

    The distinct values are counted and put in order; where their running share
    of the rows passes a multiple of 2**-bits, a level begins.  At most
    2**bits values, however many there are, come to the driver.
    """
    levels = 1 << bits
    counted = df.filter(F.col(dim).isNotNull()).groupBy(F.col(dim).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = globally_ordered(counted, [F.col("value")], f"values_{dim}")
    parts = ordered.groupBy("_part").agg(F.sum("n").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                         F.sum("_n").over(Window.partitionBy()).alias("_all"))
    inside = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = ordered.join(F.broadcast(parts), "_part").withColumn("through", F.col("_before") + F.sum("n").over(inside))
    level = F.expr(f"least(through * {levels} div _all, {levels - 1})")
    cuts = (shares.withColumn("level", level).filter(level > F.expr(f"least((through - n) * {levels} div _all, {levels - 1})"))
            .select("level", "value").collect())
    release(ordered)
    reached = F.lit(0)
    for r in sorted(cuts, key=lambda r: r["level"]):
        reached = F.when(F.col(dim) >= F.lit(r["value"]), F.lit(r["level"]).cast("int")).otherwise(reached)
    return F.when(F.col(dim).isNotNull(), reached)


def quantise(df: DataFrame, dims: list[str], bits: int) -> list[Column]:
    """Equally filled levels of numeric columns; NULL is level 0.

    One aggregate finds 2**bits - 1 cut points a dimension: that many numbers,
    however large the table, come to the driver.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(d, shares, 10_000).alias(d) for d in dims]).first()

    def level(d: str) -> Column:
        limits = F.array(*[F.lit(x) for x in cuts[d] or []]).cast("array<double>")
        below = F.size(F.filter(limits, lambda x: x <= F.col(d).cast("double")))
        return F.coalesce(F.when(F.col(d).isNotNull(), below), F.lit(0))

    return [level(d) for d in dims]


def cut_runs(ordered: DataFrame, shards: int) -> DataFrame:
    """``shard`` and ``slot`` for a table from :func:`globally_ordered`.

    Shard s takes the ranks from ceil(s n / shards) on, so counts differ by one
    at most.
    """
    shard = F.expr(f"(_rank * {shards}) div _total")
    return (ranked(ordered).withColumn("shard", shard.cast("int"))
            .withColumn("slot", F.expr(f"_rank - (shard * _total + {shards - 1}) div {shards}")))


def hilbert_shards(docs: DataFrame, shards: int = 40, bits: int = 4, id_col: str = "doc_id",
                   text_col: str = "text", dims: tuple[str, ...] = ("source", "lang"), row_col: str | None = None) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard (and ``row_col``, handed through, if given).

    The curve runs over the given string columns and the size.  Law ``rows``:
    shard counts are at most one apart.  Equal texts form a group that takes the
    least value of each dimension, so its rows stand side by side in the order;
    a cut may fall inside a group, because one may be larger than a shard.
    Defined cases: a NULL text counts as empty; NULL dimensions are the lowest
    level, NULL ids come first; repeated rows each get a slot; with
    fewer rows than shards some shards are empty; other columns are not read.
    """
    names = [f"d{i}" for i in range(len(dims))]
    carried = [row_col] if row_col else []
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = materialize(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), F.unhex(F.md5(text.cast("binary"))).alias("group"),
        *[F.col(c).cast("string").alias(n) for c, n in zip(dims, names)], *[F.col(c).alias("row") for c in carried]), "narrow")
    leveled = narrow.withColumns({n: text_levels(narrow, n, bits) for n in names}) if names else narrow
    groups = materialize(leveled.groupBy(F.col("group").alias("g")).agg(
        *[F.min(n).alias(f"g_{n}") for n in names]), "groups")
    rows = narrow.drop(*names).join(groups, F.col("group") == F.col("g"))
    levels = [*[F.coalesce(F.col(f"g_{n}"), F.lit(0)) for n in names], *quantise(narrow, ["size"], bits)]
    placed = rows.select("id", "size", "crc", "group", hilbert_index(levels, bits).alias("h"), *["row" for _ in carried])
    ordered = globally_ordered(placed, [F.col("h"), F.col("group"), F.col("id").asc_nulls_first()], "curve")
    return cut_runs(ordered, shards).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), *[F.col("row").alias(c) for c in carried])


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", **options) -> None:
    """Write every row of ``docs`` once, as one folder per shard, in slot order.

    Rows meet their slots by a row number written with them, so NULL and
    repeated ids are kept like any other.  Columns of ``docs`` that are called
    shard or slot get an underscore behind their names; an empty table writes
    no row.
    """
    own = {c: c + "_" for c in docs.columns if c.lower() in ("shard", "slot")}
    p = spare_prefix(docs)
    rows = materialize(docs.withColumnsRenamed(own).withColumn(f"{p}number", F.monotonically_increasing_id()), "rows")
    placed = hilbert_shards(rows, id_col=own.get(id_col, id_col), row_col=f"{p}number", **options).select(
        F.col(f"{p}number").alias(f"{p}placed"), "shard", "slot")
    out = rows.join(placed, F.col(f"{p}number") == F.col(f"{p}placed")).drop(f"{p}number", f"{p}placed")
    (out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
    release(rows)
