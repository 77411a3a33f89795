"""Tables written in buckets: of a key, so that joins on it exchange nothing, or of blocks of rows, so that wide rows are not shuffled."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import ident as _q
from ..session import scratch_dir, session_conf


def bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``df`` as a table in ``buckets`` buckets of ``keys``, sorted by them within each.

    Two tables with the same number of buckets of the same keys are joined file
    by file.  One exchange when written puts each bucket into one file; every
    later join and every aggregate whose keys contain ``keys`` saves its own.
    Choose keys that deal rows out evenly: a bucket is read by one task.  The
    table stands in the session's catalogue and in the shared scratch folder;
    :func:`drop` removes both.  ``buckets`` is the session's number of shuffle
    partitions if not given.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).sortBy(*keys)
     .option("path", scratch_dir(spark, name)).saveAsTable(table))
    out = spark.table(table)
    out._bucketed = table
    return out


#: Rows of a block: a wide table's rows keep together in blocks of so many when fields are attached to them.
BLOCK_ROWS = 1 << 18

_ATTACH_CONF = {
    # a written file's size says little of its rows in memory, and less of two columns out of a hundred
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    # a task writes few blocks or waves: files side by side, instead of a sort of its wide rows
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # the bucket's block number, without the row number, places both sides of the join
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # fields of a bucket that fit are hashed, so that the wide rows are not sorted (else a merge join, which spills)
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


@contextmanager
def attached(wide: DataFrame, narrow: DataFrame, key: str, block_rows: int = BLOCK_ROWS) -> Iterator[DataFrame]:
    """``wide`` inner-joined to ``narrow`` on ``key``, without shuffling a wide row; for actions in the block.

    A shuffle moves whole rows, which take several times the room of the same
    columns in a parquet file.  So ``wide`` is written where its rows are, with
    a number for each, in buckets of whole blocks of rows.  Only keys and
    numbers meet ``narrow``; its fields are then sent to the block of their
    row, which reads its wide rows bucket by bucket.  The rows are those of
    ``wide.join(narrow, key)``, also for keys that repeat or are missing.  The
    written table is removed at the end.
    """
    spark, p = wide.sparkSession, "__"
    while any(c.startswith(p) for c in [*wide.columns, *narrow.columns]):
        p += "_"
    row, block = f"{p}row", f"{p}block"
    table = f"wide_{uuid.uuid4().hex[:12]}"
    numbered = wide.withColumn(row, F.monotonically_increasing_id())
    # the task's number is in the upper bits: no block has rows of two tasks
    numbered = numbered.withColumn(block, F.expr(f"{_q(row)} div {block_rows}"))
    with session_conf(spark, _ATTACH_CONF):
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = scratch_dir(spark, "wide")
        try:
            numbered.write.format("parquet").bucketBy(n, block).option("path", path).saveAsTable(table)
            fields = spark.table(table).select(key, row, block).join(narrow, key).drop(key)
            rest = [c for c in [*wide.columns, *narrow.columns] if c != key]
            yield spark.table(table).join(fields, [block, row]).select(*[_q(c) for c in [key, *rest]])
        finally:
            _remove(spark, table, path)


def _remove(spark, table: str, path: str) -> None:
    from .snapshots import remove

    spark.sql(f"DROP TABLE IF EXISTS `{table}`")
    remove(spark, path)


def drop(df: DataFrame) -> None:
    """Remove a table of :func:`bucketed` and its files."""
    spark, table = df.sparkSession, df._bucketed
    path = spark.sql(f"DESCRIBE FORMATTED `{table}`").filter("col_name = 'Location'").first()["data_type"]
    _remove(spark, table, path)
