"""Timestamped snapshots behind a commit log, and tables memoised by content.

A store holds one folder of parquet files per version and, in ``_log``, one
manifest per version: its stamp, its folder and its schema.  The manifest is
written last, under a temporary name, and renamed; readers look at manifests
alone.  So a version that was not written to its end does not exist, and a
version without rows is a version like any other.  Reading the newest lists the
log and opens that version's folder, however many older ones there are.

A stamp (``yyyyMMddHHmmss`` and microseconds) sorts in time order.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import uuid
from collections.abc import Callable, Sequence
from contextlib import AbstractContextManager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir, scratch_dir

_LOG = "_log"


def snapshot_stamp(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d%H%M%S%f")


# --- files of the store, on any file system that Spark reads --------------------


def _at(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, at = _at(spark, folder)
    return sorted(st.getPath().getName() for st in fs.listStatus(at)) if fs.exists(at) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, at = _at(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_once(spark: SparkSession, path: str, text: str) -> None:
    """``text`` under ``path``, whole or not at all; refused if the path is taken."""
    fs, at = _at(spark, path)
    _, aside = _at(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(at) or not fs.rename(aside, at):
        fs.delete(aside, False)
        raise FileExistsError(f"{path} was committed by another writer")


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


# --- versions ----------------------------------------------------------------------


def write_snapshot(df: DataFrame, store: str, stamp: str | None = None, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a new version of ``store`` and commit it; returns the stamp.

    A stamp that is committed already is refused.  If the write fails, what it
    left is no version; :func:`prune` removes it.
    """
    spark, stamp = df.sparkSession, stamp or snapshot_stamp()
    store = store.rstrip("/")
    if f"{stamp}.json" in _names(spark, f"{store}/{_LOG}"):
        raise FileExistsError(f"{store} has a version {stamp}")
    folder = f"{stamp}-{uuid.uuid4().hex[:12]}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{store}/{folder}")
    manifest = {"stamp": stamp, "folder": folder, "schema": json.loads(df.schema.json())}
    _write_once(spark, f"{store}/{_LOG}/{stamp}.json", json.dumps(manifest))
    return stamp


def snapshot_stamps(spark: SparkSession, store: str) -> list[str]:
    """Stamps of the committed versions, oldest first, from the log's listing alone."""
    return [n[:-5] for n in _names(spark, f"{store.rstrip('/')}/{_LOG}") if n.endswith(".json") and not n.startswith(".")]


def snapshot(spark: SparkSession, store: str, stamp: str) -> DataFrame:
    """Rows of one committed version, in the schema that it was written with."""
    store = store.rstrip("/")
    manifest = json.loads(_read_text(spark, f"{store}/{_LOG}/{stamp}.json"))
    return spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(f"{store}/{manifest['folder']}")


def latest_snapshot(spark: SparkSession, store: str) -> DataFrame | None:
    """Rows of the newest version, which may be none, or None if no version was committed."""
    stamps = snapshot_stamps(spark, store)
    return snapshot(spark, store, stamps[-1]) if stamps else None


def prune(spark: SparkSession, store: str, keep: int) -> list[str]:
    """Remove all but the newest ``keep`` versions, and what failed writes left; returns the removed folders.

    A version's manifest goes first, so that no reader finds one without files.
    Not for stores that are being written at the same time.
    """
    if keep < 1:
        raise ValueError("a store keeps one version at least")
    store = store.rstrip("/")
    stamps = snapshot_stamps(spark, store)
    kept = {json.loads(_read_text(spark, f"{store}/{_LOG}/{s}.json"))["folder"] for s in stamps[-keep:]}
    for s in stamps[:-keep]:
        remove(spark, f"{store}/{_LOG}/{s}.json")
    gone = [n for n in _names(spark, store) if n != _LOG and n not in kept]
    for n in gone:
        remove(spark, f"{store}/{n}")
    return gone


def load(spark: SparkSession, store: str, fetch: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """Read-through: fetch and snapshot when forced or when no version exists.

    A fetch without rows is a version too: it is not fetched again, and after a
    forced refresh it stands for the source.
    """
    if not force:
        cached = latest_snapshot(spark, store)
        if cached is not None:
            return cached
    return snapshot(spark, store, write_snapshot(fetch(), store))


def latest_per_object(df: DataFrame, obj_col: str, snap_col: str, few: int = 10_000) -> DataFrame:
    """Rows of each object's newest snapshot.

    A NULL object is an object; an object without any stamp keeps its rows.
    The maxima are one row an object.  Up to ``few`` of them (checked by a job
    that reads the one column) are broadcast, so that the table is not
    shuffled on its few object names; beyond, they are joined.
    """
    latest = df.groupBy(F.col(obj_col).alias("__object")).agg(F.max(snap_col).alias("__latest"))
    if df.select(obj_col).distinct().limit(few + 1).count() <= few:
        latest = F.broadcast(latest)
    newest = F.col(obj_col).eqNullSafe(F.col("__object")) & F.col(snap_col).eqNullSafe(F.col("__latest"))
    return df.join(latest, newest, "left_semi")


def roundtrip(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write two snapshots to the shared scratch folder and read back the newest."""
    store = scratch_dir(spark, "snapshots")
    write_snapshot(df.limit(0), store, "20000101000000")
    write_snapshot(df, store, "20990101000000")
    return latest_snapshot(spark, store)


# --- tables memoised by what they are computed from -------------------------------


#: Operators of an optimised plan that run code of the user.
_CODE = re.compile(r"EvalPython|InPandas|InArrow|PythonUDF|UDF\(|MapElements|MapPartitions|MapGroups")


def _leaves(plan) -> list:
    found = plan.collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def _files(spark: SparkSession, leaf) -> list[tuple[str, int, int]] | None:
    """(path, bytes, time) of a leaf's files, or None if the leaf is no file scan."""
    if not hasattr(leaf, "getClass") or leaf.getClass().getSimpleName() != "LogicalRelation":
        return None
    relation = leaf.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation":
        return None
    paths = set(relation.location().inputFiles())
    found = []
    for folder in sorted({p.rsplit("/", 1)[0] for p in paths}):
        fs, at = _at(spark, folder)
        for st in fs.listStatus(at):
            if st.getPath().toUri().toString() in paths or st.getPath().toString() in paths:
                found.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return sorted(found) if len(found) == len(paths) else None


def content_key(df: DataFrame, *more: str) -> str | None:
    """A name of what ``df`` computes: its plan, freed of ids, and the files that each of its scans reads.

    None if the result may differ from run to run, or if there is nothing to
    tell a change by: rows that come from the driver (a range is fine), user
    functions, whose code the plan does not show, and subqueries.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic() or not plan.subqueriesAll().isEmpty():
        return None
    if _CODE.search(df._jdf.queryExecution().optimizedPlan().toString()):
        return None
    inputs = []
    for leaf in _leaves(plan):
        files = _files(spark, leaf)
        if files is None and leaf.getClass().getSimpleName() not in ("Range", "OneRowRelation"):
            return None
        inputs.append(files)
    fields = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(fields)
    spark.conf.set(fields, str(2**31 - 1))  # the whole plan, not its first 25 columns
    try:
        text = plan.canonicalized().toString()
    finally:
        spark.conf.set(fields, before)
    return hashlib.sha256(json.dumps([spark.version, text, inputs, df.schema.json(), *more]).encode()).hexdigest()[:40]


def memo_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/memo"


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = (),
                form: Callable[[], AbstractContextManager[DataFrame]] | None = None) -> DataFrame:
    """``df`` written once, in the session's shared checkpoint folder, and read back.

    The table is found again by :func:`content_key`: the same plan over the same
    files starts no job, a changed plan or input is written anew.  Later
    branches read only the columns and partitions they need, and the table
    survives executor loss (unlike a cache or a local checkpoint).  A frame
    without a key is written on every call.  :func:`forget` removes tables.

    ``form`` gives the same rows by another plan, entered only if the table is
    written; the key is always that of ``df``.
    """
    spark = df.sparkSession
    key = content_key(df, *partition_by) or uuid.uuid4().hex
    store = f"{memo_folder(spark)}/{name}/{key}"
    found = latest_snapshot(spark, store)
    if found is not None:
        return found
    with form() if form else nullcontext(df) as rows:
        return snapshot(spark, store, write_snapshot(rows, store, partition_by=partition_by))


def memoised(spark: SparkSession, name: str) -> list[str]:
    """Keys of the tables written under ``name``."""
    return _names(spark, f"{memo_folder(spark)}/{name}")


def forget(spark: SparkSession, name: str, but: DataFrame | None = None, partition_by: Sequence[str] = ()) -> list[str]:
    """Remove the tables written under ``name``, but the one that ``but`` computes; returns the removed keys."""
    kept = content_key(but, *partition_by) if but is not None else None
    gone = [k for k in memoised(spark, name) if k != kept]
    for k in gone:
        remove(spark, f"{memo_folder(spark)}/{name}/{k}")
    return gone
