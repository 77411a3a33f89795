"""Nested-record sources: JSON records with parent objects, flattened to columns.

A CRM-style export nests each record's parents (``Customer -> Nation``) and
tags every object with an ``attributes`` member.  Reading is schema-first
(``from_json`` with an explicit schema, no inference pass), the flattening is a
driver-side walk over the StructType (metadata only), and every parent is
optional: a missing parent yields NULL columns, never a shifted schema.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .panel import table

META_FIELD = "attributes"


def strip_meta(schema: T.StructType, meta: str = META_FIELD) -> T.StructType:
    """Schema without the metadata member, recursively, inside arrays and maps too."""

    def clean(t: T.DataType) -> T.DataType:
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(f.name, clean(f.dataType), True) for f in t.fields if f.name != meta])
        if isinstance(t, T.ArrayType):
            return T.ArrayType(clean(t.elementType), True)
        if isinstance(t, T.MapType):
            return T.MapType(t.keyType, clean(t.valueType), True)
        return t

    return clean(schema)


def flat_columns(schema: T.StructType, prefix: str = "", sep: str = ".") -> list[tuple[str, str]]:
    """(path, flat name) of every leaf field, depth first, in schema order."""
    out = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out += flat_columns(f.dataType, path + ".", sep)
        else:
            out.append((path, path.replace(".", sep)))
    return out


def _flatten(parsed: DataFrame, root: str, clean: T.StructType, rename: dict[str, str] | None) -> DataFrame:
    leaves = flat_columns(clean)
    rename = rename or {}
    missing = set(rename) - {p for p, _ in leaves}
    if missing:
        raise ValueError(f"rename paths not in schema: {sorted(missing)}")
    prefix = f"{root}." if root else ""
    return parsed.select(*[F.col(f"{prefix}{p}").alias(rename.get(p, flat)) for p, flat in leaves])


def flatten_records(df: DataFrame, json_col: str, schema: T.StructType,
                    rename: dict[str, str] | None = None, meta: str = META_FIELD) -> DataFrame:
    """Parse JSON records held in a string column, drop metadata members,
    flatten nested parents.

    ``rename`` maps flattened dotted paths to canonical names; every mapped path
    must exist in the schema (fails loudly instead of renaming by position).
    """
    clean = strip_meta(schema, meta)
    # FAILFAST: a malformed record stops the job instead of becoming a row of NULLs
    parsed = df.select(F.from_json(F.col(json_col), clean, {"mode": "FAILFAST"}).alias("__r"))
    return _flatten(parsed, "__r", clean, rename)


def read_records(spark: SparkSession, path: str, schema: T.StructType,
                 rename: dict[str, str] | None = None, meta: str = META_FIELD,
                 corrupt: str | None = None) -> DataFrame:
    """Landed JSON-lines record files -> flat columns.

    A malformed record stops the job; with ``corrupt`` it is kept as a row that
    holds its text in the column of that name.

    The reader gets the schema without metadata members, so they are never
    parsed, and no inference pass runs over the files.
    """
    clean = strip_meta(schema, meta)
    if corrupt is None:
        return _flatten(spark.read.schema(clean).json(path, mode="FAILFAST"), "", clean, rename)
    kept = T.StructType([*clean.fields, T.StructField(corrupt, T.StringType(), True)])
    read = spark.read.schema(kept).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt)
    return _flatten(read, "", kept, rename)


def flatten_unknown(df: DataFrame, json_col: str, keep: Sequence[str] = (), meta: str = META_FIELD, sep: str = ".") -> DataFrame:
    """JSON records of any shapes -> one flat column per leaf found in any of them.

    Each record is parsed once, into a VARIANT.  The merged shape of all records
    is one aggregate (the schema depends on the data, so a job is needed); its
    members named ``meta`` are left out at every depth, also inside arrays.
    Leaves come in the order of their names; a record without one has NULL.  A
    leaf that is an object in some records and a value in others, and one of
    several types, is its whole JSON text.  ``keep`` columns are handed through.
    Malformed records stop the job; NULL records give rows of NULLs.
    """
    parsed = df.select(*keep, F.parse_json(json_col).alias("__v"))
    shape = parsed.agg(F.schema_of_variant_agg("__v")).first()[0]
    kind = _variant_type(shape or "VOID")
    leaves = _variant_leaves(kind, meta)
    cell = lambda path, t: F.variant_get("__v", "$" + "".join(f"['{k}']" for k in path), t)
    # a value of several types is a VARIANT still; its text is that of the JSON
    columns = [(F.when(F.is_variant_null(cell(p, "variant")), None).otherwise(F.to_json(cell(p, "variant"))) if t == "variant"
                else cell(p, t)).alias(sep.join(p)) for p, t in leaves]
    return parsed.select(*keep, *columns)


def _variant_type(shape: str):
    """The nested dict, ``[element]`` list or type name of a text such as ``OBJECT<a: ARRAY<BIGINT>>``."""
    token = re.compile(r"`((?:[^`]|``)*)`|([A-Za-z_][\w]*(?:\(\d+,\s*\d+\))?)|([<>:,])")
    parts = [(m[1].replace("``", "`") if m[1] is not None else m[2] or m[3], m[3]) for m in token.finditer(shape)]
    at = 0

    def take():
        nonlocal at
        name, at = parts[at][0], at + 1
        if name not in ("OBJECT", "ARRAY") or at >= len(parts) or parts[at][1] != "<":
            return name.lower()
        at += 1
        found: dict | list = {} if name == "OBJECT" else []
        while parts[at][1] != ">":
            if parts[at][1] == ",":
                at += 1
            if name == "OBJECT":
                key, at = parts[at][0], at + 2
                found[key] = take()
            else:
                found.append(take())
        at += 1
        return found

    return take()


def _type_text(kind, meta: str) -> str:
    """The SQL type of a value inside an array, metadata members left out."""
    if isinstance(kind, list):
        return f"array<{_type_text(kind[0], meta)}>"
    if isinstance(kind, dict):
        members = ", ".join(f"`{k}`: {_type_text(v, meta)}" for k, v in kind.items() if k != meta)
        return f"struct<{members}>" if members else "string"
    return "string" if kind == "void" else kind


def _variant_leaves(kind, meta: str, path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], str]]:
    if isinstance(kind, dict):
        return [leaf for k, v in kind.items() if k != meta for leaf in _variant_leaves(v, meta, (*path, k))]
    return [(path, _type_text(kind, meta))] if path else []


def json_int(c: str, path: str) -> Column:
    """Explicit JSON path access on a string column, as an integer."""
    return F.get_json_object(F.col(c), path).try_cast("int")


# Canonical names of the order-record export (explicit map, see decision D12).
ORDER_RECORD_NAMES = {
    "Id": "order_id",
    "TotalPrice": "total_price",
    "Status": "status",
    "Customer.Name": "customer_name",
    "Customer.Segment": "segment",
    "Customer.Nation.Key": "nation_key",
}


def order_record_schema() -> T.StructType:
    meta = T.StructType([T.StructField("type", T.StringType())])
    nation = T.StructType([T.StructField("attributes", meta), T.StructField("Key", T.IntegerType())])
    customer = T.StructType([T.StructField("attributes", meta), T.StructField("Name", T.StringType()),
                             T.StructField("Segment", T.StringType()), T.StructField("Nation", nation)])
    return T.StructType([T.StructField("attributes", meta), T.StructField("Id", T.LongType()),
                         T.StructField("TotalPrice", T.DoubleType()), T.StructField("Status", T.StringType()),
                         T.StructField("Customer", customer)])


def order_records(spark: SparkSession, d: str) -> DataFrame:
    """Orders exported as nested JSON records with their (optional) customer."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    meta = lambda t: F.struct(F.lit(t).alias("type"))
    nation = F.when(F.col("c_custkey").isNotNull(),
                    F.struct(meta("Nation").alias("attributes"), F.col("c_nationkey").alias("Key")))
    customer = F.when(F.col("c_custkey").isNotNull(), F.struct(
        meta("Customer").alias("attributes"), F.col("c_name").alias("Name"),
        F.col("c_mktsegment").alias("Segment"), nation.alias("Nation")))
    rec = F.struct(meta("Order").alias("attributes"), F.col("o_orderkey").alias("Id"),
                   F.col("o_totalprice").alias("TotalPrice"), F.col("o_orderstatus").alias("Status"),
                   customer.alias("Customer"))
    return j.select(F.to_json(rec).alias("record"))


def order_records_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    return flatten_records(order_records(spark, d), "record", order_record_schema(), ORDER_RECORD_NAMES)


def unlike_records(spark: SparkSession, d: str) -> DataFrame:
    """(source, record): orders with their customers, events with their props as an object, suppliers with a list."""
    orders = order_records(spark, d).select(F.lit("order").alias("source"), "record")
    events = table(spark, d, "events").select(F.lit("event").alias("source"), F.concat(
        F.lit('{"Id":'), F.col("event_id").cast("string"), F.lit(',"attributes":{"type":"Event"},"props":'), F.col("props"), F.lit("}")).alias("record"))
    parts = F.array(*[F.struct(F.struct(F.lit("Part").alias("type")).alias("attributes"), (F.col("s_suppkey") + i).alias("part")) for i in range(2)])
    suppliers = table(spark, d, "supplier").select(F.lit("supplier").alias("source"), F.to_json(F.struct(
        F.col("s_name").alias("Id"), F.struct(F.col("s_nationkey").alias("Key"), parts.alias("parts")).alias("Nation"))).alias("record"))
    return orders.unionByName(events).unionByName(suppliers)


def relationship_extract(spark: SparkSession, d: str, segments: Sequence[str]) -> DataFrame:
    """Child records with their optional parents (customer -> nation -> region)
    and an ``IN`` filter that Spark pushes into the parquet scan."""
    c = table(spark, d, "customer").filter(F.col("c_mktsegment").isin(list(segments)))
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")
    return j.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                    F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation_name"),
                    F.col("r_name").alias("region_name"))
