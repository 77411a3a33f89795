"""Repeated lines over a whole corpus, with DataFrame operations alone.

Method: every line becomes two 64-bit hashes with its document and position.
These rows are range-partitioned by hash and document and sorted by hash,
document and position, so a line that a third of the corpus holds is spread
over many tasks.  The sorted stream marks the first occurrence of each line in
each document; first occurrences are counted within a range, and the few keys
that reach over a range's edge are counted apart.  The result is a bitmap per
document, not text.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, release

#: Stripped at both ends of a line.
SPACE = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased and no other letter."""
    bare = F.btrim(line, F.lit(SPACE))
    # lower() is the faster way, and the same one where every character is ASCII
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, ascii_uppercase, ascii_lowercase))


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, d1, d2): the 128-bit name of a document comes from its id and whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("d1"),
                       F.xxhash64(F.lit(7), F.col(id_col), text).alias("d2"))


def line_stream(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """(h1, h2, id, d1, d2, pos, first, part), range-partitioned and sorted by the first six, materialised.

    ``first`` marks a line's first occurrence in its document, ``part`` is the
    range.  Lines whose key has less than ``min_chars`` code points are left out.
    """
    lines = _named(docs, id_col, text_col).select("id", "d1", "d2", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))).filter(F.char_length("key") >= min_chars)
    rows = keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"), "id", "d1", "d2", "pos")
    by = ["h1", "h2", "id", "d1", "d2"]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by, "pos")
    # Ranges hold whole (line, document) groups in order, so this window adds no exchange and no sort.
    nth = F.row_number().over(Window.partitionBy(*by).orderBy("pos"))
    return materialize(ranged.select("*", (nth == 1).alias("first"), F.spark_partition_id().alias("part")), "lines")


def repeated_lines(stream: DataFrame, min_docs: int, keep_first: bool) -> DataFrame:
    """(d1, d2, pos): lines to drop, of a table from :func:`line_stream`."""
    # A key that reaches over the edge of a range holds the range's first or last hash: two numbers a range at most.
    edges = stream.groupBy("part").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
    edges = edges.select(F.explode(F.array("lo", "hi")).alias("h1")).distinct()
    across = (stream.join(F.broadcast(edges), "h1", "left_semi").groupBy("h1", "h2")
              .agg(F.count_if("first").alias("n_across"), F.min("part").alias("from_part")))
    # No group here is larger than one range, however often a line occurs.
    here = Window.partitionBy("part", "h1", "h2")
    counted = stream.withColumn("n_here", F.sum(F.col("first").cast("long")).over(here))
    if keep_first:
        counted = counted.withColumn("nth", F.rank().over(here.orderBy(F.col("id").asc_nulls_first(), "d1", "d2", "pos")))
    counted = counted.join(F.broadcast(across), ["h1", "h2"], "left")
    gone = counted.filter(F.coalesce("n_across", "n_here") >= min_docs)
    if keep_first:
        gone = gone.filter((F.col("nth") > 1) | (F.col("part") > F.coalesce("from_part", "part")))
    return gone.select("d1", "d2", "pos")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                 min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(d1, d2, n_dropped, dropped): one row per document that loses lines.

    ``dropped`` lists, in order, (word, bits) for each run of 64 lines with a
    dropped line among them: bit b of word w is line 64 w + b; lines without a
    bit stay.  (d1, d2) names a document by its id and text.  A key found in at
    least ``min_docs`` documents loses all its lines or, with ``keep_first``,
    all but the first by id and position.
    """
    stream = line_stream(docs, id_col, text_col, min_chars)
    gone = repeated_lines(stream, min_docs, keep_first)
    words = gone.groupBy("d1", "d2", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("bits"))
    maps = words.groupBy("d1", "d2").agg(F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
                                         F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"))
    out = materialize(maps, "bitmaps")
    release(stream)
    return out


def kept_texts(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, kept): every document with the lines that its bitmap leaves."""
    gap = lambda x, i: x["word"] - F.coalesce(F.get("dropped", i - 1)["word"], F.lit(-1)) - 1
    dense = F.flatten(F.transform("dropped", lambda x, i: F.concat(F.array_repeat(F.lit(0).cast("long"), gap(x, i)), F.array(x["bits"]))))
    masks = bitmaps.select("d1", "d2", "n_dropped", dense.alias("mask"))
    both = _named(docs, id_col, text_col).join(masks, ["d1", "d2"], "left")
    stays = F.expr("filter(split(text, '\n'), (x, i) -> getbit(coalesce(get(mask, shiftright(i, 6)), 0L), i & 63) = 0)")
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return both.select(F.col("id").alias(id_col), n_lines.cast("long").alias("n_lines"),
                       F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
                       F.when(F.col("mask").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n")).alias("kept"))


def dedup_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_lines, n_dropped, kept_sha256), one row per document.

    Defined cases: a NULL text counts as empty and has one empty line; empty
    keys are never dropped; a text that loses all its lines is empty; rows of
    one id and text are one document for the counts, and each is returned; rows
    of one id with other texts, and rows with a NULL id, are documents of their
    own; other columns are not read; an empty table gives an empty result.
    """
    kept = kept_texts(docs, keep_bitmaps(docs, id_col, text_col, **options), id_col, text_col)
    return kept.select(id_col, "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
