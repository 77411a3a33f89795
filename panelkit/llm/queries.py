"""Registered queries of the subpackage: (spark, sf_dir) -> DataFrame.

Each applies one operator, with production parameters, to its whole table.
ORACLE holds DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import curriculum, fim, hilbert, html_extract, language_id, line_dedup, minhash, pieces, quality, recompression, simhash, topk, zone_clusters
from .common import table


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints(table(spark, sf_dir, "documents"))


def minhash_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of operator 1: bands joined, Jaccard verified."""
    return minhash.near_links(table(spark, sf_dir, "documents"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = curriculum.mix_plan(table(spark, sf_dir, "documents"))
    plan = plan.withColumn("position", F.round("position", 9))
    return (plan.select("doc_id", "size", "source_size", "target", "taken", "position")
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.dedup_digests(table(spark, sf_dir, "documents"))


def op6_hilbert_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.hilbert_shards(table(spark, sf_dir, "documents"), shards=40, bits=4, dims=("source", "lang"))


def op7_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op8_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"))


def op10_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_digests(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


def op12_fim_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def op13_zone_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_clusters.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dim=64, scale=64, seed=1)


#: Further queries, each a part of a dealt operator that its own query does not return.
PARTS = {"minhash_links": minhash_links}

QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_html_extract": op2_html_extract,
    "op3_curriculum_mix": op3_curriculum_mix,
    "op4_language_id": op4_language_id,
    "op5_recompression_dedup": op5_recompression_dedup,
    "op6_hilbert_shard": op6_hilbert_shard,
    "op8_fm_quality": op8_fm_quality,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_block_topk": op10_block_topk,
    "op7_simhash_bktree": op7_simhash_bktree,
    "op11_line_dedup": op11_line_dedup,
    "op12_fim_rotation": op12_fim_rotation,
    "op13_zone_clusters": op13_zone_clusters,
}

def _cluster_sql(rounds: int = 3) -> str:
    """The clustering of op13 with one pair of CTEs a round: vectors to centroids, then means."""
    nearest = """a{i} AS (
  SELECT uid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT v.uid, m.c, list_sum(list_transform(list_zip(v.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM kept v, m{i} m) GROUP BY uid
)"""
    means = """m{j} AS (
  SELECT m.c, coalesce(f.v, m.v) AS v FROM m{i} m LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY p) AS v FROM (
      SELECT a.c, e.p, sum(e.x)::HUGEINT AS s, count(*)::HUGEINT AS n
      FROM a{i} a JOIN (SELECT uid, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM kept) e USING (uid) GROUP BY a.c, e.p
    ) GROUP BY c) f ON m.c = f.c
)"""
    steps = [step.format(i=i, j=i + 1) for i in range(rounds) for step in (nearest, means)] + [nearest.format(i=rounds)]
    return """
WITH kept AS (
  SELECT row_number() OVER () AS uid, vec_id, sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), m0 AS (
  SELECT row_number() OVER (ORDER BY h, vec_id NULLS FIRST, v) - 1 AS c, v FROM kept ORDER BY h, vec_id NULLS FIRST, v LIMIT 16
), """ + ", ".join(steps) + f"""
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(m.v, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept k USING (uid) JOIN m{rounds} m ON a.c = m.c
"""


ORACLE: dict[str, str] = {
    "op3_curriculum_mix": r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents
), sized AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS kind
  FROM docs GROUP BY source
), weighted AS (
  SELECT *, [5, 2, 1][1 + kind % 3] AS w, 2 * source_size AS cap FROM sized
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, kind) AS n,
         sum(source_size) OVER () AS total,
         sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left,
         coalesce(sum(cap) OVER (ORDER BY cap / w, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before
  FROM weighted
), level AS (
  SELECT n AS level_n, 3 * total - 2 * cap_before AS left2, w_left AS level_w FROM ranked
  WHERE (3 * total - 2 * cap_before) * w <= 2 * cap * w_left ORDER BY n LIMIT 1
), goals AS (
  SELECT source, source_size, kind,
         CASE WHEN n < level_n THEN CAST(cap AS DOUBLE)
              ELSE CAST(left2 AS DOUBLE) / 2 * w / CAST(level_w AS DOUBLE) END AS target
  FROM ranked, level
), stream AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.kind, CAST(floor(g.target) AS BIGINT) AS goal,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS BIGINT) AS start
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
), placed AS (
  SELECT *, greatest(least(goal - start, size), 0) AS first, greatest(least(goal - start - source_size, size), 0) AS second,
         CAST(start AS DOUBLE) / CAST(goal AS DOUBLE) AS share
  FROM stream
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(first + second AS BIGINT) AS taken,
       CASE WHEN first > 0 THEN round(CASE kind % 3
         WHEN 0 THEN share * 2 / (0.5 + sqrt(0.25 + 2 * share))
         WHEN 1 THEN share
         ELSE CASE WHEN share < 0.625 THEN share * 2 / (1.5 + sqrt(2.25 - 2 * share))
                   ELSE 0.5 + (share - 0.625) * 2 / (1.0 + sqrt(1.0 - 2 * (share - 0.625))) END
         END, 9) END AS position
FROM placed
""",
    "op5_recompression_dedup": r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS uid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT uid, doc_id, p, array_to_string(w[p:p + 49], ' ') AS words
  FROM (SELECT uid, doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM docs WHERE doc_id IS NOT NULL)
), old AS (
  SELECT uid, p FROM (SELECT uid, doc_id, p, min(doc_id) OVER (PARTITION BY words) AS least FROM windows) WHERE doc_id > least
), gone AS (
  SELECT DISTINCT uid, unnest(range(p, p + 50)) AS p FROM old
), marks AS (
  SELECT uid, list(p) AS gone FROM gone GROUP BY uid
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(len(m.gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN m.gone IS NULL THEN array_to_string(d.w, ' ') ELSE
              coalesce(array_to_string(list_transform(list_filter(range(1, len(d.w) + 1), lambda i: NOT list_contains(m.gone, i)),
                                             lambda i: d.w[i]), ' '), '') END) AS kept_sha256
FROM docs d LEFT JOIN marks m ON d.uid = m.uid
""",
    "op10_block_topk": """
WITH clean AS (
  SELECT row_number() OVER () AS uid, vec_id,
         list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.uid, q.vec_id AS query_id, d.vec_id,
         CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
  FROM clean q JOIN clean d ON q.uid <> d.uid
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS n FROM scored
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 20
""",
    "op11_line_dedup": r"""
WITH docs AS (
  SELECT row_number() OVER () AS uid, dense_rank() OVER (ORDER BY doc_id, coalesce(text, '')) AS doc, doc_id, coalesce(text, '') AS t
  FROM documents
), lines AS (
  SELECT uid, doc, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), often AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc) >= 10
), kept AS (
  SELECT uid, count(*) AS n_lines, count(o.key) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE o.key IS NULL), '') AS text
  FROM keyed LEFT JOIN often o USING (key) GROUP BY uid
)
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM docs JOIN kept USING (uid)
""",
    "op12_fim_rotation": """
WITH seeded AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT *, length(t) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM seeded
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1) AS s FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM parts
""",
    "op13_zone_clusters": _cluster_sql(),
}
