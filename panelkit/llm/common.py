"""Helpers shared by the operators: reading, materialising, global order."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

#: White space that separates words, and the words themselves, in every contract.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and
    several consumers share one computation.  The folder is below the session's
    ``spark.checkpoint.dir``, which every executor sees.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    if _written.get() is not None:
        _written.get().append(out)
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables from :func:`materialize` whose consumers are themselves written out."""
    for df in tables:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def spare_prefix(*frames: DataFrame) -> str:
    """Underscores with which no column of ``frames`` begins: helper columns named with it clash with none."""
    names = [c.lower() for df in frames for c in df.columns]
    prefix = "_"
    while any(n.startswith(prefix) for n in names):
        prefix += "_"
    return prefix


@contextmanager
def released():
    """Tables written inside by :func:`materialize` are deleted at the end, but those handed to ``keep``.

    For a job whose last step is written out itself: what it read on the way is spent.
    """
    outer, kept = _written.get(), []
    made = []
    token = _written.set(made)
    try:
        yield kept.append
    finally:
        _written.reset(token)
        for df in made:
            if not any(df is k for k in kept):
                release(df)
        if outer is not None:
            outer += kept


_written: ContextVar[list | None] = ContextVar("written", default=None)


def bucket_of(text_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(text_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def globally_ordered(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """``df`` written in the order of ``keys``, with ``_part`` and ``_row``.

    A range shuffle on the full key list splits even one hot leading key over
    many partitions.  ``(_part, _row)`` is a total order: rows of partition p
    come before those of p + 1, ``_row`` counts inside a partition.  The result
    is materialised, because range bounds are sampled anew on every run.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    mid = F.monotonically_increasing_id()
    out = ordered.withColumn("_mid", mid)
    out = (out.withColumn("_part", F.shiftright("_mid", 33).cast("int"))
              .withColumn("_row", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
              .drop("_mid"))
    return materialize(out, name)


def ranked(ordered: DataFrame) -> DataFrame:
    """``_rank`` (from 0) and ``_total`` for a table from :func:`globally_ordered`.

    Only the offsets, one row a partition, meet in one task and are broadcast.
    """
    counts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                            F.sum("_n").over(Window.partitionBy()).alias("_total"))
    return ordered.join(F.broadcast(offsets), "_part").withColumn("_rank", F.col("_before") + F.col("_row"))
