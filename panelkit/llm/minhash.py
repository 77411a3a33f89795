"""MinHash document fingerprints, and near-duplicate links through signature bands.

Method: the word shingles of a text are hashed; each of PERMUTATIONS universal
hash permutations (multiply and add modulo 2**64, odd multipliers) gives the
least value over the shingles, all in numpy over whole batches.  The share of
equal places in two fingerprints estimates the Jaccard similarity of the
shingle sets.  For links, bands of the signature are joined in Spark and the
exact Jaccard similarity of each candidate pair is verified.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialize
from .components import components
from .textnum import Words, mix, random_words, shingle_hashes, text_batches

SHINGLE = 5
PERMUTATIONS = 128
#: Bits kept of each minimum; two unequal minima agree in them once in 65,536.
PLACE_BITS = 16
#: Bands of PERMUTATIONS / BANDS places: a pair at similarity 0.8 shares none once in 20 million.
BANDS = 32
#: Bucket members compared at once; larger buckets are compared in pairs of blocks of half as many.
BUCKET = 512
#: Estimates this far below the threshold are still verified: five standard errors.
SLACK = 0.18
#: Id ranges at most; each is sorted by one task.
RANGES = 4096
THRESHOLD = 0.8
#: Texts fingerprinted at a time.
ROWS = 512
#: 64-bit words of the bitmap that drops texts without a candidate: 1 MB at any size of the table.
BITMAP = 1 << 17
#: Shingle hashes that are permuted at once: small enough for a core's cache.
_TILE = 1 << 14


def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, count per text) of the k-word shingles; a shorter text is one shingle, a blank one none."""
    w = Words(texts)
    name = w.hashes(41)
    whole = shingle_hashes(name, k)
    count = np.maximum(w.count - k + 1, (w.count > 0).astype(np.int64))
    hashes = []
    for first, n in zip(w.first, w.count):
        if n >= k:
            hashes.append(whole[first:first + n - k + 1])
        elif n:
            hashes.append(shingle_hashes(name[first:first + n], n) ^ np.uint64(n))
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), count


def signatures(texts: list[bytes], k: int = SHINGLE, permutations: int = PERMUTATIONS) -> np.ndarray:
    """One row of ``permutations`` 16-bit places per text; zeros for a text without words."""
    out = np.zeros((len(texts), permutations), np.uint16)
    factor, shift = random_words(permutations, 1) | np.uint64(1), random_words(permutations, 2)
    for lo, hi in text_batches(texts, 1_000_000):
        hashes, count = shingle_sets(texts[lo:hi], k)
        rows = np.flatnonzero(count)
        if not len(rows):
            continue
        # Tiles of whole or cut texts; a cut text's minima are combined below.
        first = np.cumsum(count[rows]) - count[rows]
        cuts = np.unique(np.concatenate([first, np.arange(0, len(hashes), _TILE)]))
        owner = np.searchsorted(first, cuts, side="right") - 1
        least = np.full((permutations, len(rows)), np.iinfo(np.uint64).max, np.uint64)
        tiles = np.arange(0, len(hashes), _TILE)
        lim = np.append(np.searchsorted(cuts, tiles), len(cuts))
        with np.errstate(over="ignore"):
            for t, (i, j) in zip(tiles, zip(lim[:-1], lim[1:])):
                part, at, own = hashes[t:t + _TILE], cuts[i:j] - t, owner[i:j]
                for p in range(permutations):
                    m = np.minimum.reduceat(part * factor[p] + shift[p], at)
                    least[p, own] = np.minimum(least[p, own], m)
        out[lo + rows] = (mix(least) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.uint16).T
    return out


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (rounded down) replaced by as many first code points of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _ranges(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text) and, per id range, the first row of the next range; columns part, kind, id, h, text.

    Ids are cut into ranges of about equal counts by one aggregate: at most
    RANGES numbers, however large the table.  An id (or NULL, which counts as
    the least number) on which several cuts fall has as many ranges, over which
    its rows are dealt by the hash of their texts.  The row after a range (kind
    1; the first row of all after the last range) is found by its id and hash,
    from a table of one row a range.
    """
    count = rows.count()
    pieces = int(min(RANGES, max(2, count // 256)))
    key = F.coalesce("id", F.lit(-2**63))
    cuts = rows.agg(F.percentile_approx(key, [i / pieces for i in range(1, pieces)], 20_000)).first()[0] or []
    times = sorted(Counter(cuts).items())  # (cut, ranges that it stands for)
    ahead = np.cumsum([0] + [m - 1 for _, m in times]).tolist()

    def at(values: list) -> Column:
        """The value for the last cut not above the id."""
        return F.element_at(F.array(*[F.lit(v) for v in values]).cast("array<bigint>"), F.col("n") + 1)

    limits = F.array(*[F.lit(c) for c, _ in times]).cast("array<bigint>")
    rows = rows.withColumn("key", key).withColumn("h", F.xxhash64("text"))
    rows = rows.withColumn("n", F.size(F.filter(limits, lambda x: x <= F.col("key"))))
    # Rows of the cut itself are dealt over its ranges; the ids behind it are in the last of them.
    last = at([1] + [m for _, m in times]) - 1
    place = (F.col("h").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    own = F.when(F.col("key") == at([None] + [c for c, _ in times]), F.least(F.floor(place * (last + 1)), last)).otherwise(last)
    part = F.col("n") + at([0] + ahead[:-1]) + own
    rows = rows.select(part.cast("int").alias("part"), F.lit(0).alias("kind"), "id", "h", "text")
    heads = [tuple(r) for r in rows.groupBy("part").agg(F.min(F.struct(F.coalesce("id", F.lit(-2**63)).alias("id"), "h")).alias("m"))
             .select("part", "m.id", "m.h").sort("part").collect()]  # one row a range
    before = [(heads[i - 1][0], *h[1:]) for i, h in enumerate(heads)]
    spark = rows.sparkSession
    wanted = spark.createDataFrame(before, "q int, i long, g long")
    found = rows.join(F.broadcast(wanted), (F.coalesce("id", F.lit(-2**63)) == F.col("i")) & (F.col("h") == F.col("g")))
    found = found.select(F.col("q").alias("part"), F.lit(1).alias("kind"), "id", "h", "text")
    return rows.unionByName(found)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text's last floor(n_chars / 4) code points are replaced by the
    first as many (or all) of the next document by ascending id; the first
    follows the last.  Fingerprints are PERMUTATIONS places of 16 bits in hex;
    near_* are shares of equal places.  Defined cases: a NULL text counts as
    empty; texts without words share the fingerprint of zeros and are alike (1);
    rows of one id are ordered by a hash of their texts, NULL ids come first;
    a single row follows itself; other columns are not read; an empty table
    gives an empty result.
    """
    schema = (f"{id_col} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def report(ids: list, texts: list[str], ends: np.ndarray) -> pd.DataFrame:
        """Rows of ``texts`` but those marked in ``ends``; each is followed by the row after it."""
        at = np.flatnonzero(~ends[:-1])
        changed = [edited(texts[i], texts[i + 1]) for i in at]
        own = signatures([t.encode() for t in texts])
        near = signatures([t.encode() for t in changed])
        return pd.DataFrame({
            id_col: pd.array([ids[i] for i in at], dtype="Int64"), "n_chars": [len(texts[i]) for i in at],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": [own[i].astype(">u2").tobytes().hex() for i in at],
            "edited_fingerprint": [s.astype(">u2").tobytes().hex() for s in near],
            "near_edited": (own[at] == near).mean(axis=1), "near_next": (own[at] == own[at + 1]).mean(axis=1)})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, texts, ends = [], [], []
        for frame in frames:
            for i, t, kind in zip(frame["id"], frame["text"], frame["kind"]):
                if kind and ends and ends[-1]:
                    continue  # repeated rows at a range limit: one of them is enough
                ids.append(None if pd.isna(i) else int(i))
                texts.append(t)
                ends.append(bool(kind))
                if len(texts) >= 512:
                    yield report(ids, texts, np.array(ends))
                    ids, texts, ends = ids[-1:], texts[-1:], ends[-1:]
        if len(texts) > 1:
            yield report(ids, texts, np.array(ends))

    dealt = _ranges(rows).repartition("part").sortWithinPartitions("part", "kind", F.col("id").asc_nulls_first(), "h")
    return dealt.select("id", "text", "kind").mapInPandas(run, schema)


# --- near-duplicate links -----------------------------------------------------------


def signature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, words, signature) of the rows with an id; ``words`` is a digest of the word sequence."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo in range(0, len(frame), ROWS):
                part = frame.iloc[lo:lo + ROWS]
                texts = [t.encode() for t in part["text"]]
                yield pd.DataFrame({"id": part["id"].array, "words": [hashlib.sha256(b" ".join(t.split())).digest() for t in texts],
                                    "signature": [s.astype(">u2").tobytes() for s in signatures(texts)]})

    rows = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return materialize(rows.mapInPandas(run, "id long, words binary, signature binary"), "signatures")


def classes(table: DataFrame) -> DataFrame:
    """(id, class_id) of a signature table: the smallest id with the same words."""
    reps = materialize(table.groupBy(F.col("words").alias("w")).agg(F.min("id").alias("class_id")), "classes")
    return table.join(reps, table["words"] == reps["w"]).select("id", "class_id")


def _alike(left: np.ndarray, right: np.ndarray, band: int, least: float) -> np.ndarray:
    """Pairs of rows whose estimate reaches ``least`` and whose first common band is ``band``."""
    width = PERMUTATIONS // BANDS
    found = []
    for i, row in enumerate(left):
        same = right == row
        near = np.flatnonzero(same.mean(axis=1) >= least)
        if len(near):
            first = same[near].reshape(len(near), BANDS, width).all(axis=2).argmax(axis=1)
            found += [(i, j) for j in near[first == band]]
    return np.array(found, np.int64).reshape(-1, 2)


def _forest(pairs: np.ndarray) -> np.ndarray:
    """Those of the pairs that connect what the pairs before them leave apart."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while x in above:
            if above[x] in above:
                above[x] = above[above[x]]
            x = above[x]
        return x

    keep = []
    for n, (i, j) in enumerate(pairs.tolist()):
        i, j = top(i), top(j)
        if i != j:
            above[j] = i
            keep.append(n)
    return pairs[keep]


def _blocks(frames: Iterator[pd.DataFrame], key: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Whole groups of frames sorted by ``key``, as (frame, first row of each group)."""
    held = None
    for frame in frames:
        if not len(frame):
            continue
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        values = frame[key].to_numpy()
        start = np.append(0, 1 + np.flatnonzero((values[1:] != values[:-1]).any(axis=1)))
        held = frame.iloc[start[-1]:]
        if len(start) > 1:
            yield frame.iloc[:start[-1]], start[:-1]
    if held is not None:
        yield held, np.zeros(1, np.int64)


def _compare(frames: Iterator[pd.DataFrame], least: float, spanning: bool = False) -> Iterator[pd.DataFrame]:
    """Candidate pairs (u, v) of blocks sorted by (band, h, a, b); with ``spanning`` only as many as connect a block's."""

    def pairs(frame: pd.DataFrame, start: np.ndarray) -> pd.DataFrame:
        matrix = np.frombuffer(b"".join(frame["signature"]), ">u2").astype(np.uint16).reshape(len(frame), -1)
        ids, own, band, a, b = (frame[c].to_numpy() for c in ("id", "own", "band", "a", "b"))
        end = np.append(start[1:], len(frame))
        # Most blocks are two members of one small bucket: all of them at once.
        two = start[(end - start == 2) & (a[start] == b[start])]
        same = matrix[two] == matrix[two + 1]
        first = same.reshape(len(two), BANDS, PERMUTATIONS // BANDS).all(axis=2).argmax(axis=1)
        two = two[(same.mean(axis=1) >= least) & (first == band[two])]
        u, v = [ids[two]], [ids[two + 1]]
        for s, e in zip(start, end):
            if e - s < 2 or (e - s == 2 and a[s] == b[s]):
                continue
            left, right = s + np.flatnonzero(own[s:e] == a[s]), s + np.flatnonzero(own[s:e] == b[s])
            found = _alike(matrix[left], matrix[right], band[s], least)
            found = np.stack([left[found[:, 0]], right[found[:, 1]]], axis=1)
            found = found[(found[:, 0] < found[:, 1]) if a[s] == b[s] else (found[:, 0] != found[:, 1])]
            found = _forest(found) if spanning else found
            u.append(ids[found[:, 0]])
            v.append(ids[found[:, 1]])
        u, v = np.concatenate(u), np.concatenate(v)
        return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)})

    for frame, start in _blocks(frames, ["band", "h", "a", "b"]):
        yield pairs(frame, start)


def _representatives(table: DataFrame) -> DataFrame:
    """(words, class_id, signature, id) of a signature table, one row for each word sequence; ``id`` numbers them."""
    reps = table.groupBy("words").agg(F.min("id").alias("class_id"), F.first("signature").alias("signature"))
    return materialize(reps.withColumn("id", F.monotonically_increasing_id()), "reps")


def _dealt(members: DataFrame, size: str) -> DataFrame:
    """``members`` with (own, a, b): one block up to BUCKET members, else a copy for each pair of blocks that holds it."""
    blocks = F.when(F.col(size) <= BUCKET, F.lit(1)).otherwise(F.ceil(F.col(size) * 3 / F.lit(BUCKET))).cast("int")
    members = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (members.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))
            .drop(size, "blocks", "other"))


def _candidates(reps: DataFrame, least: float, spanning: bool = False) -> DataFrame:
    """(u, v), numbers of representatives that share a band and whose estimate reaches ``least``."""
    width = 2 * PERMUTATIONS // BANDS
    bands = F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(F.substring("signature", 1 + width * b, width)).alias("h"))
                      for b in range(BANDS)])
    keyed = reps.select("id", F.explode(bands).alias("key")).select("id", "key.*")
    sizes = materialize(keyed.groupBy("band", "h").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "buckets")
    members = materialize(_dealt(keyed.join(sizes, ["band", "h"]), "size"), "members")
    block = ["band", "h", "a", "b"]
    named = members.join(reps.select(F.col("id").alias("rep"), "signature"), F.col("id") == F.col("rep")).drop("rep")
    named = named.repartition(*block).sortWithinPartitions(*block)
    return materialize(named.mapInPandas(lambda frames: _compare(frames, least, spanning), "u long, v long").distinct(), "candidates")


def _among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` but most of those whose ``key`` is not in ``wanted`` (one long column of the same name).

    A bitmap of BITMAP words, whatever the table's size, is broadcast; a row
    whose bit is set by another key stays, so an exact join has to follow.
    """
    place = F.pmod(F.xxhash64(key), F.lit(64 * BITMAP))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{key}`), 64) AS int))")
    place = F.floor(place / 64).cast("int")
    bits = wanted.groupBy(place.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    rows = rows.withColumn("_word", place).join(F.broadcast(bits), "_word")
    return rows.filter(F.col("_bits").bitwiseAND(bit) != 0).drop("_word", "_bits")


def _sets(docs: DataFrame, reps: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, class_id, s): the shingle sets of the representatives whose numbers are in ``wanted`` (column w)."""

    @F.pandas_udf("array<long>")
    def shingle_set(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_sets([(t or "").encode()])[0]).view(np.int64) for t in texts], dtype=object)

    wanted = wanted.join(reps.select(F.col("id").alias("rep"), "class_id", "words"), F.col("w") == F.col("rep"))
    wanted = materialize(wanted.select("w", "class_id", "words"), "wanted")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    texts = _among(texts, "_id", wanted.select(F.col("class_id").alias("_id")))
    digest = F.unhex(F.sha2(F.array_join(F.regexp_extract_all("_text", F.lit(WORD), 0), " ").cast("binary"), 256))
    sets = texts.join(wanted, (F.col("_id") == F.col("class_id")) & (digest == F.col("words"))).dropDuplicates(["w"])
    return materialize(sets.select(F.col("w").alias("id"), "class_id", shingle_set(F.col("_text")).alias("s")), "sets")


def _verified(docs: DataFrame, reps: DataFrame, threshold: float, id_col: str, text_col: str) -> DataFrame:
    candidates = _candidates(reps, threshold - SLACK)
    wanted = candidates.select(F.col("u").alias("w")).union(candidates.select("v")).distinct()
    sets = _sets(docs, reps, wanted, id_col, text_col)
    both = (candidates.join(sets.select(F.col("id").alias("u"), F.col("class_id").alias("cu"), F.col("s").alias("su")), "u")
            .join(sets.select(F.col("id").alias("v"), F.col("class_id").alias("cv"), F.col("s").alias("sv")), "v"))
    common = F.size(F.array_intersect("su", "sv"))
    both = both.withColumn("jaccard", common / (F.size("su") + F.size("sv") - common))
    found = both.filter((F.col("jaccard") >= threshold) & (F.col("cu") != F.col("cv")))
    return found.groupBy(F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).agg(F.max("jaccard").alias("jaccard"))


def similar_pairs(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(u, v, jaccard): pairs u < v of class representatives with a Jaccard
    similarity of their 5-word shingle sets of at least ``threshold``.

    Of several texts under one repeated id each is compared; of a pair of ids
    the greatest similarity is given.

    Equal texts count once, by their representative (see :func:`classes`).  The
    signature bands meet in Spark; a bucket's members are compared by their
    fingerprints in one task, a large bucket's in pairs of blocks, and only
    pairs that look similar leave it, each from its first common band.  Their
    exact similarity is then verified.  NULL texts count as empty; rows with a
    NULL id take no part.
    """
    return _verified(docs, _representatives(signature_table(docs, id_col, text_col)), threshold, id_col, text_col)


def _links(frames: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """(id, n, jaccard, near): verified links of each member within its block, and the best of them.

    Blocks are sorted by (component, a, b).  Pairs are compared by their
    fingerprints, then by their sets, and only counted: none leaves the task.
    """
    for frame, start in _blocks(frames, ["component", "a", "b"]):
        matrix = np.frombuffer(b"".join(frame["signature"]), ">u2").astype(np.uint16).reshape(len(frame), -1)
        ids, classes, own, a, b = (frame[c].to_numpy() for c in ("id", "class_id", "own", "a", "b"))
        sets = frame["s"].tolist()
        count, best, near = np.zeros(len(frame), np.int64), np.zeros(len(frame)), np.full(len(frame), -1)

        def note(i: int, j: int, likeness: float) -> None:
            count[i] += 1
            if (-likeness, classes[j]) < (-best[i], classes[near[i]]):
                best[i], near[i] = likeness, j

        for s, e in zip(start, np.append(start[1:], len(frame))):
            left, right = s + np.flatnonzero(own[s:e] == a[s]), s + np.flatnonzero(own[s:e] == b[s])
            code = np.unique(np.concatenate(sets[s:e]), return_inverse=True)[1]
            code = np.split(code, np.cumsum([len(x) for x in sets[s:e]])[:-1])
            has = np.zeros(1 + max((c.max() for c in code if len(c)), default=0), bool)
            for i in left:
                others = right[right > i] if a[s] == b[s] else right
                others = others[(matrix[others] == matrix[i]).mean(axis=1) >= threshold - SLACK]
                if not len(others):
                    continue
                has[code[i - s]] = True
                for j in others:
                    common = np.count_nonzero(has[code[j - s]])
                    likeness = common / max(1, len(code[i - s]) + len(code[j - s]) - common)
                    if likeness >= threshold:
                        note(i, j, likeness)
                        note(j, i, likeness)
                has[code[i - s]] = False
        hit = np.flatnonzero(count)
        yield pd.DataFrame({"id": ids[hit], "n": count[hit], "jaccard": best[hit], "near": classes[near[hit]]})


def near_links(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, class_id, n_links, near_id, near_jaccard.

    ``class_id`` is the least id with the same words; ``n_links`` counts the
    other word sequences whose 5-word shingle sets have a Jaccard similarity of
    at least ``threshold`` to it; ``near_id`` is the class_id of the most similar
    of them, of equals the least, and ``near_jaccard`` that similarity.

    Band buckets only say which texts hang together: as many candidate pairs
    leave a bucket as connect its members.  The members of a component then meet
    in blocks with their fingerprints and sets, where pairs are verified and
    counted, so no table of pairs is ever made.

    Defined cases: a document without a link has n_links 0 and no near_id; texts
    without words are one class without links; a NULL id takes no part (class_id
    NULL, n_links 0); several texts of a repeated id are each judged by their own
    words; repeated rows are each returned; an empty table gives an empty result.
    """
    table = signature_table(docs, id_col, text_col)
    reps = _representatives(table)
    nodes = materialize(components(_candidates(reps, threshold - SLACK, spanning=True)), "nodes")
    sets = _sets(docs, reps, nodes.select(F.col("node").alias("w")), id_col, text_col)
    sizes = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    members = nodes.join(sizes, "component").join(sets, F.col("node") == F.col("id")).drop("node")
    members = _dealt(members.join(reps.select(F.col("id").alias("rep"), "signature"), F.col("id") == F.col("rep")).drop("rep"), "size")
    block = ["component", "a", "b"]
    members = members.repartition(*block).sortWithinPartitions(*block)
    found = members.mapInPandas(lambda frames: _links(frames, threshold), "id long, n long, jaccard double, near long")
    nearest = F.min(F.struct((-F.col("jaccard")).alias("far"), F.col("near").alias("o")))
    per_text = materialize(found.groupBy("id").agg(F.sum("n").alias("n"), nearest.alias("near")), "links")
    per_class = reps.select("id", "words").join(per_text, "id").select(F.col("words").alias("c"), "n", "near")
    member = table.select(F.col("id"), F.col("words").alias("w")).join(reps.select("words", "class_id"), F.col("w") == F.col("words"))
    out = member.join(per_class, F.col("w") == F.col("c"), "left").select(
        F.col("id").alias(id_col), "class_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.col("near.o").alias("near_id"), (-F.col("near.far")).alias("near_jaccard"))
    absent = docs.filter(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias(id_col), F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(None).cast("long").alias("near_id"), F.lit(None).cast("double").alias("near_jaccard"))
    return out.unionByName(absent)
