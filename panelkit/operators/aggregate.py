"""Aggregation operators: first-non-missing consolidation, strict max, totals, shares.

All aggregate map-side before the shuffle: a hot key (one participant holding a
third of the rows) is collapsed to one partial row per map task, so no task ever
holds the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import ident as _q


def first_non_missing_sql(c: str, order: Sequence[str]) -> str:
    """SQL text of the first-non-missing aggregate (see ``first_non_missing``)."""
    key = ", ".join(f"{_q(o)} AS __o{i}" for i, o in enumerate(order))
    return f"min(CASE WHEN {_q(c)} IS NOT NULL THEN struct({key}, {_q(c)} AS __x) END).__x"


def first_non_missing(c: str, order: Sequence[str]) -> Column:
    """Aggregate: value of ``c`` at the smallest ``order`` among rows where c is present.

    The least struct of order and value: one buffer a column, which is faster
    than ``min_by`` with the order beside the value, than hashing with the order
    packed into a decimal, and than hashing codes of the texts (README has the
    figures).  ``order`` must be unique within a group (add the row id as
    tie-break), else the least value of the tied rows is taken.
    """
    return F.expr(first_non_missing_sql(c, order))


def consolidate(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: every column takes its first non-missing value in ``order``.

    One shuffle on ``keys``; every column is folded in the same aggregate.
    The aggregate list is generated as SQL text (one parse on the JVM instead
    of several driver round trips per column).
    """
    cols = [c for c in (columns or df.columns) if c not in keys and c not in order]
    return df.groupBy(*keys).agg(*[F.expr(f"{first_non_missing_sql(c, order)} AS {_q(c)}") for c in cols])


def fill_within(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                columns: Sequence[str] | None = None, dedup: bool = False) -> DataFrame:
    """Broadcast each group's first non-missing value to every row of the group.

    Equivalent to ``first(c, ignorenulls).over(partitionBy(keys).orderBy(order)
    .rowsBetween(unbounded, unbounded))`` but planned as an aggregate joined back
    on the keys: the aggregate pre-combines map-side, and the join of a hot key
    is split by AQE's skew-join handling, where a window would put a whole hot
    group in one task.  Rows keep their multiplicity unless ``dedup``.
    """
    cols = [c for c in (columns or df.columns) if c not in keys and c not in order]
    filled = consolidate(df, keys, order, cols)
    if dedup:
        return filled
    rest = df.drop(*cols)
    # Null keys never match an equi-join; the window form puts them in one
    # group, so match them null-safely.
    cond = [rest[k].eqNullSafe(filled[k]) for k in keys]
    out = rest.join(filled, cond, "inner")
    return out.select(*[rest[k] for k in keys],
                      *[rest[c] for c in rest.columns if c not in keys],
                      *[filled[c] for c in cols])


def strict_max(c: str) -> Column:
    """Maximum that is NULL if any value in the group is NULL (no NA skipping)."""
    return F.when(F.bool_and(F.col(c).isNotNull()), F.max(c))


def share_of_total(df: DataFrame, count_col: str = "n", total_col: str = "n_total") -> DataFrame:
    """Add the overall total of ``count_col`` and the share ``p``.

    The total is a scalar subquery over the (already aggregated) input: no
    unpartitioned window, no cross join.
    """
    total = df.select(F.sum(count_col)).scalar()
    return df.withColumn(total_col, total).withColumn(
        "p", F.try_divide(F.col(count_col).cast("double"), F.col(total_col)))


def group_share(df: DataFrame, group: Sequence[str], count_col: str = "n",
                total_col: str = "n_group") -> DataFrame:
    """Add the group total and share next to already aggregated rows.

    Partitioned window on small, aggregated input (one row per cell).  Column
    names are case-insensitive in Spark: ``total_col`` must differ from
    ``count_col`` in more than case.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*group)
    return df.withColumn(total_col, F.sum(count_col).over(w)).withColumn(
        "p", F.try_divide(F.col(count_col).cast("double"), F.col(total_col)))


def median_by_group(df: DataFrame, group: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """Exact median of ``value`` per group (mean of the two middle values for
    an even count), without one group's values ever meeting in one task.

    ``median()``/``percentile()`` buffer every value of a group, and a running
    sum over a group's histogram puts all its distinct values into one task.
    Here the (group, value) counts are combined map-side, range-partitioned by
    group and value, and written (range bounds are sampled, so a second reading
    must not deal them anew).  Each range's total per group, one row a range
    and group, tells where the middle positions lie; running sums are taken in
    those ranges only.  NULL values are left out; a NULL group is a group.
    """
    from pyspark.sql import Window

    from ..session import scratch_dir

    g, spark = list(group), df.sparkSession
    counted = df.filter(F.col(value).isNotNull()).groupBy(*g, F.col(value).alias("__x")).agg(F.count(F.lit(1)).alias("__c"))
    ordered = counted.repartitionByRange(*g, "__x").withColumn("__part", F.spark_partition_id())
    path = scratch_dir(spark, "histogram")
    ordered.write.parquet(path)
    hist = spark.read.schema(ordered.schema).parquet(path)
    sizes = hist.groupBy("__part", *g).agg(F.sum("__c").alias("__n"))
    own = Window.partitionBy(*g)
    earlier = own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__part", *g, "__n", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"), F.sum("__n").over(own).alias("__all"))
    middle = [F.floor((F.col("__all") + 1) / 2), F.floor(F.col("__all") / 2) + 1]
    inside = [(F.col("__before") < m) & (m <= F.col("__before") + F.col("__n")) for m in middle]
    wanted = sizes.filter(inside[0] | inside[1]).select(
        F.col("__part").alias("__p"), *[F.col(c).alias(f"__g{i}") for i, c in enumerate(g)], "__before", middle[0].alias("__lo"), middle[1].alias("__hi"))
    same = [F.col("__part") == F.col("__p"), *[F.col(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(g)]]
    near = hist.join(wanted, same)
    run = Window.partitionBy("__part", *g).orderBy("__x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.withColumn("__cum", F.col("__before") + F.sum("__c").over(run))
    at = lambda m: F.min(F.when(F.col("__cum") >= F.col(m), F.col("__x")))
    return near.groupBy(*g).agg(((at("__lo") + at("__hi")) / 2.0).alias(out))
