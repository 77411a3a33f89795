"""File sources and sinks: CSV scan/write, trailing-row trim."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir


#: Stands for a missing value.  A text that begins with a backslash is written
#: with one more, so no text equals it.
MISSING = "\\N"
_FORMAT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def read_csv(spark: SparkSession, path: str, schema=None, infer: bool = False, missing: str = MISSING,
             corrupt: str | None = None) -> DataFrame:
    """CSV with a header; explicit schema preferred (inference is a full extra pass).

    Reads what :func:`write_csv` wrote back value for value.  ``missing`` names
    another mark of missing values in files from elsewhere (``NA``); their texts
    are taken as they stand.  A row that does not fit the schema stops the job;
    with ``corrupt`` it is kept, its text in the column of that name and the
    values that could be read in theirs.  Quoted texts may hold line feeds,
    quotes and commas; they make a file unsplittable, so large tables should
    come as many files.
    """
    r = spark.read.options(multiLine=True, emptyValue="", nullValue=missing, **_FORMAT)
    if schema is None:
        out = r.option("inferSchema", infer).option("mode", "FAILFAST").csv(path)
    else:
        schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        if corrupt is None:
            # every column is parsed, also those that a query leaves out: a bad row is found always
            out = r.schema(schema).option("mode", "FAILFAST").option("columnPruning", False).csv(path)
        else:
            kept = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType(), True)])
            out = (r.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
                   .option("columnPruning", False).csv(path))
    if missing != MISSING:
        return out
    plain = lambda c: F.when(F.col(f"`{c}`").startswith("\\"), F.substring(f"`{c}`", 2, 2**31 - 1)).otherwise(F.col(f"`{c}`"))
    return out.withColumns({c: plain(c) for c in _texts(out) if c != corrupt})


def write_csv(df: DataFrame, path: str, single_file: bool = False, missing: str = MISSING) -> None:
    """CSV sink: header, a mark for missing values, ``""`` for the empty text,
    quotes doubled, white space kept.

    By default no text equals the mark.  Another one (``NA``, for readers that
    expect it) is written as it is, and a text that equals it stops the job.
    ``single_file`` is for small report tables only (coalesce(1) funnels the
    data through one task)."""
    out = df.coalesce(1) if single_file else df

    def cell(c: str):
        text = F.col(f"`{c}`")
        if missing == MISSING:
            return F.when(text.startswith("\\"), F.concat(F.lit("\\"), text)).otherwise(text)
        stop = F.raise_error(F.lit(f"write_csv: a text of {c} equals the mark of missing values, {missing!r}"))
        return F.when(text == missing, stop.cast("string")).otherwise(text)

    out = out.withColumns({c: cell(c) for c in _texts(df)})
    out.write.mode("overwrite").options(emptyValue='""', nullValue=missing, **_FORMAT).csv(path)


def csv_roundtrip(spark: SparkSession, df: DataFrame, single_file: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back."""
    path = scratch_dir(spark, "csv")
    write_csv(df, path, single_file=single_file)
    return read_csv(spark, path, schema=df.schema)


def drop_last(df: DataFrame, order_col: str, n: int = 2, ties: Sequence[str] = ()) -> DataFrame:
    """Drop the last ``n`` rows in the order of ``order_col``, then ``ties``.

    Rows have no file order in Spark, so "last" is by explicit columns, and they
    must tell the last rows apart: if two of the last n + 1 rows are equal in
    all of them, the job stops (give a row id as ``ties``).  NULLs come first.
    The rows are found with a top-n (TakeOrdered: per-task top n, then merge)
    and removed with an anti join: no global sort, no unpartitioned window.
    """
    keys = [order_col, *ties]
    last = df.select(*keys).orderBy(*[F.col(k).desc_nulls_last() for k in keys]).limit(n + 1)
    # n + 1 keys by construction: they fit into one row, and the tail may be broadcast
    listed = last.agg(F.sort_array(F.collect_list(F.struct(*keys)), asc=False).alias("__last"))
    stop = F.raise_error(F.lit(f"drop_last: {keys} do not tell the last rows apart"))
    tail = F.when(F.size(F.array_distinct("__last")) == F.size("__last"), F.slice("__last", 1, n)).otherwise(stop)
    tail = listed.select(F.explode(tail).alias("__t"))
    return df.join(F.broadcast(tail), [F.col(k).eqNullSafe(F.col(f"__t.{k}")) for k in keys], "left_anti")
