import hashlib
import random
from collections import Counter, defaultdict

import pytest

from odd_rows import ODD
from panelkit.llm import line_dedup


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small tables keep their eight ranges, so that keys reach over edges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\f\r").translate(LOWER)


def order(row):
    return (row[0] is not None, row[0] or 0, row[1] or "")


def brute(rows, min_docs, keep_first=False):
    """Repeated (id, text) rows are one document; by keep_first, rows of one id must be alike."""
    found, first = defaultdict(set), {}
    for doc in sorted(set(rows), key=order):
        for i, line in enumerate((doc[1] or "").split("\n")):
            found[key(line)].add(doc)
            first.setdefault(key(line), (doc, i))
    out = []
    for doc in rows:
        lines = (doc[1] or "").split("\n")
        kept = [x for i, x in enumerate(lines) if not key(x) or len(found[key(x)]) < min_docs
                or (keep_first and first[key(x)] == (doc, i))]
        out.append((doc[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def corpus(n, seed):
    rng = random.Random(seed)
    common = ["Hot line", "  HOT LINE\t", "hot line\r", "Ünïcode É", "ünïcode É", "ÜNÏCODE é", "", "   ", "x"]
    rows = []
    for i in range(n):
        lines = [rng.choice(common) if rng.random() < 0.5 else f"line {rng.randrange(n // 2)}" for _ in range(rng.randrange(1, 12))]
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("min_docs,keep_first", [(10, False), (2, False), (2, True), (1, True)])
def test_equals_brute_force(make_docs, min_docs, keep_first):
    rows = corpus(400, min_docs) + ODD + [(9000, "\n" * 500 + "hot line\n" * 300 + "end"), (9001, "\n".join(f"own {i}" for i in range(5000)) + "\nhot line")]
    got = line_dedup.dedup_digests(make_docs(rows), min_docs=min_docs, keep_first=keep_first)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert Counter(map(tuple, got.collect())) == brute(rows, min_docs, keep_first)


def test_repeated_and_missing_ids(make_docs):
    rows = [(1, "same\nline")] * 15 + [(2, f"own {i}\nshared") for i in range(9)] + [(None, f"null {i}\nshared") for i in range(1)]
    got = Counter(map(tuple, line_dedup.dedup_digests(make_docs(rows)).collect()))
    assert got == brute(rows, 10) and sum(r[2] for r in got.elements()) == 10


def test_nothing_repeats_and_no_rows(make_docs):
    rows = [(i, f"a {i}") for i in range(20)]
    assert Counter(map(tuple, line_dedup.dedup_digests(make_docs(rows)).collect())) == brute(rows, 10)
    assert line_dedup.dedup_digests(make_docs([])).count() == 0


def test_one_line_in_every_document_is_spread(spark, make_docs):
    rows = [(i, "everywhere\n" + f"own {i}") for i in range(3000)]
    stream = line_dedup.line_stream(make_docs(rows))
    most = stream.groupBy("part").count().agg({"count": "max"}).first()[0]
    parts = stream.select("part").distinct().count()
    assert parts > 1 and most < 2 * 6000 / parts
    maps = line_dedup.keep_bitmaps(make_docs(rows))
    assert maps.count() == 3000 and all(r["n_dropped"] == 1 and [tuple(x) for x in r["dropped"]] == [(0, 1)] for r in maps.collect())


def test_the_first_occurrence_window_needs_no_exchange(spark, make_docs):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    by = ["h1", "h2"]
    rows = spark.range(100).selectExpr("id % 7 AS h1", "id % 3 AS h2", "id AS pos").repartitionByRange(*by).sortWithinPartitions(*by, "pos")
    p = rows.select("*", F.row_number().over(Window.partitionBy(*by).orderBy("pos")))._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange") == 1 and p.count("Sort [") == 1
