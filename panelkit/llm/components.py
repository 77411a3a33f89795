"""Connected components of a link table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _least_neighbour(directed: DataFrame) -> DataFrame:
    """Per node u the least of u and its neighbours.  Written out, so that the
    join that follows shuffles both sides and a hot node can be split."""
    return materialize(directed.groupBy("u").agg(F.min("v").alias("m"))
                       .select("u", F.least("u", "m").alias("m")), "least")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v: long, any order).

    Alternating large-star and small-star rounds: each hangs the neighbours of
    a node on its least neighbour, until nothing changes.  The component is its
    least node.  The number of links never grows, no group is ever collected
    (only minima are), and each round is written to the shared folder.  NULL
    ends and self links are ignored; an empty table gives an empty result.
    """
    links = materialize(links.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state, spent = _state(links), []
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = _least_neighbour(both)
        large = (both.join(near, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = materialize(large.filter("u <> v").distinct(), "large")
        least = _least_neighbour(large)
        small = large.join(least, "u")
        small = (small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").filter("u <> v").distinct())
        spent += [links, near, large, least]
        links = materialize(small, "small")
        after = _state(links)
        if after == state:
            break
        state = after
    if spent:
        release(*spent)  # the last round is written out; nothing reads the earlier ones again
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
