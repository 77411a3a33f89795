"""SimHash near-duplicates, linked through BK-trees.

Method: a document's fingerprint is the bitwise majority of its shingle hashes.
Two fingerprints within ``radius`` bits agree on all but ``radius`` of b bit
blocks, so each fingerprint goes to one shard per choice of b - radius blocks.
Every shard has its own BK-tree (children keyed by their Hamming distance to
the parent) and each member follows only the edges within the radius.  Shards
are bounded; the members of a larger shard are linked exactly by the values one
bit flip away (two fingerprints at most two bits apart share one), whose groups
hold at most 65 fingerprints however skewed the corpus is.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, spare_prefix
from .components import components

BITS = 64
#: Texts whose shingles a worker holds at once.
ROWS = 256
#: Members of a shard that get a BK-tree; larger shards take the bit-flip way.
SHARD = 1024

_LANES = np.uint64(0x0101010101010101)


def shingles(text: str | None, k: int) -> list[bytes]:
    """Space-joined shingles of k words (A-Z lower-cased); the whole sequence if shorter."""
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return [b" ".join(words)] if words else []
    whole = b" ".join(words)
    end = list(accumulate(len(w) + 1 for w in words))
    return [whole[a:b - 1] for a, b in zip([0, *end], end[k - 1:])]


def majority_bits(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Per document the 64-bit majority of its hashes (0 without any).

    Eight bits are counted at once, one to each byte of a word, over runs of at
    most 255 hashes so that no byte overflows.
    """
    out = np.zeros(len(count), dtype=np.uint64)
    full = np.flatnonzero(count)
    if not len(full):
        return out
    n = count[full]
    first = np.cumsum(n) - n
    runs = (n + 254) // 255
    run0 = np.cumsum(runs) - runs
    at = np.arange(runs.sum()) - np.repeat(run0, runs)
    begin = np.repeat(first, runs) + 255 * at
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, begin)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), run0, axis=0)
        major = ones * 2 > n[:, None]
        for lane in range(8):
            out[full] |= major[:, lane].astype(np.uint64) << np.uint64(8 * lane + bit)
    return out


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """SimHash of a text column as a long (the 64 bits, signed); NULL counts as empty: 0."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        digest = xxhash.xxh64_intdigest
        out = np.zeros(len(texts), dtype=np.int64)
        for lo in range(0, len(texts), ROWS):
            found = [shingles(t, shingle) for t in texts.iloc[lo:lo + ROWS]]
            count = np.array([len(f) for f in found], dtype=np.int64)
            hashes = np.fromiter((digest(s, 42) for f in found for s in f), np.uint64, int(count.sum()))
            out[lo:lo + ROWS] = majority_bits(hashes, count).view(np.int64)
        return pd.Series(out)

    return of(text)


class BKTree:
    """Burkhard-Keller tree of 64-bit words under the Hamming distance."""

    def __init__(self):
        self.words: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, word: int) -> None:
        self.words.append(word)
        self.edges.append({})
        new = len(self.words) - 1
        at = 0
        while at != new:
            distance = (self.words[at] ^ word).bit_count()
            at = self.edges[at].setdefault(distance, new)

    def within(self, word: int, radius: int) -> list[int]:
        """Indices of the words at most ``radius`` bits away."""
        found, todo = [], [0] if self.words else []
        while todo:
            at = todo.pop()
            distance = (self.words[at] ^ word).bit_count()
            if distance <= radius:
                found.append(at)
            edges = self.edges[at]
            for step in range(max(distance - radius, 0), distance + radius + 1):
                if step in edges:
                    todo.append(edges[step])
        return found


def shard_links(words: list[int], names: list[int], radius: int) -> list[tuple[int, int]]:
    """Spanning links of one shard: each component of its members as a star.

    ``words`` are distinct.  Returns (name, least name of its component).
    """
    tree, parent = BKTree(), list(range(len(words)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, w in enumerate(words):
        for j in tree.within(w, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
        tree.add(w)
    least: dict[int, int] = {}
    for i, name in enumerate(names):
        r = root(i)
        least[r] = min(least.get(r, name), name)
    return [(name, least[root(i)]) for i, name in enumerate(names) if name != least[root(i)]]


def _layout(distinct: int, radius: int) -> int:
    """Number of blocks: shard keys have two bits more than the fingerprints need."""
    need = max(distinct, 1).bit_length() + 2
    blocks = radius + 1
    while blocks < 8 and BITS * (blocks - radius) // blocks < need:
        blocks += 1
    return blocks


def _shard_keys(blocks: int, radius: int) -> Column:
    """Array of shard keys of column ``fp``: one for each choice of blocks - radius blocks."""
    edge = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in range(blocks)]
    keys = []
    for tag, kept in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(masks[i] for i in kept)
        mask -= (1 << 64) * (mask >> 63)
        keys.append(F.struct(F.lit(tag).alias("tag"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bits")))
    return F.array(*keys)


def links(classes: DataFrame, radius: int) -> DataFrame:
    """Links (u, v) that connect all fingerprints within ``radius`` bits.

    ``classes``: one row per distinct fingerprint (fp long, rep long).  The links
    span the same components as all pairs would, without listing all pairs.
    """
    if radius not in (0, 1, 2):
        raise ValueError("radius: 0, 1 or 2 (the bit-flip way of large shards covers these)")
    schema = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])
    if radius == 0:
        return classes.sparkSession.createDataFrame([], schema)
    keyed = classes.select("fp", "rep", F.explode(_shard_keys(_layout(classes.count(), radius), radius)).alias("key"))
    keyed = keyed.select("fp", "rep", "key.tag", "key.bits")
    sizes = materialize(keyed.groupBy("tag", "bits").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "shards")
    members = materialize(keyed.join(sizes, ["tag", "bits"]), "members")

    def search(frames):
        for frame in frames:
            found = [link for words, names in zip(frame["words"], frame["names"])
                     for link in shard_links([int(w) & (2**64 - 1) for w in words], [int(n) for n in names], radius)]
            yield pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    shards = (members.filter(F.col("size") <= SHARD).groupBy("tag", "bits")
              .agg(F.collect_list(F.struct("rep", "fp")).alias("m"))
              .select(F.col("m.fp").alias("words"), F.col("m.rep").alias("names")))
    small = shards.mapInPandas(search, schema)

    hot = members.filter(F.col("size") > SHARD).select("fp", "rep").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << b) - (1 << 64) * (b == 63))) for b in range(BITS)])
    near = hot.select("rep", F.explode(flips).alias("near"), "fp")
    if radius == 1:  # a shared value one flip from both means two bits: keep only a value that is a member
        near = near.join(hot.select(F.col("fp").alias("near"), F.col("rep").alias("v")), "near")
        large = near.select(F.col("rep").alias("u"), "v").filter("u <> v")
    else:
        least = near.groupBy("near").agg(F.min("rep").alias("v"), F.collect_set("rep").alias("all")).filter(F.size("all") > 1)
        large = least.select(F.explode("all").alias("u"), "v").filter("u <> v")
    return small.unionByName(large)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links of at most ``radius``
    differing bits, the document's own included.  Defined cases: a NULL, empty
    or blank text has fingerprint zero and is linked like any other; a text of
    fewer than ``shingle`` words is one shingle; a repeated row is returned as
    often as it comes; a row with a NULL id gets the component of its
    fingerprint (NULL if no row with an id has it) and makes no links.  Other
    columns are not read.  An empty table gives an empty result.
    """
    prints = materialize(docs.select(F.col(id_col).cast("long").alias("id"),
                                     fingerprint(F.col(text_col), shingle).alias("fp")), "prints")
    classes = materialize(prints.filter("id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "classes")
    found = components(links(classes, radius))
    named = materialize(classes.join(found, classes["rep"] == found["node"], "left")
                        .select("fp", F.coalesce("component", "rep").alias("component_id")), "named")
    return prints.join(named, "fp", "left").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` whose id names their component: one document of each group.

    Of rows that repeat that id one stays.  Rows with a NULL id stay: there is
    no id to decide on.  All columns are kept as they are.
    """
    p = spare_prefix(docs)
    found = near_duplicates(docs, id_col, text_col, shingle, radius)
    kept = found.filter(F.col(id_col) == F.col("component_id"))
    kept = materialize(kept.groupBy(F.col(id_col).alias(f"{p}kept")).agg(F.count(F.lit(1)).alias(f"{p}times")), "kept")
    out = docs.join(kept.select(f"{p}kept"), docs[id_col] == F.col(f"{p}kept"), "left_semi")
    if kept.filter(f"{p}times > 1").limit(1).count():
        out = out.dropDuplicates([id_col])
    return out.unionByName(docs.filter(F.col(id_col).isNull()))
