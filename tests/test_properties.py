"""Property checks against plain-Python references (random inputs, one Spark job per batch)."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelkit.functions import formatting
from panelkit.operators import aggregate


def test_whole_percent_is_half_even_for_random_fractions(spark):
    rnd = random.Random(7)
    pairs = [(n, N) for N in [rnd.randint(1, 10**6) for _ in range(3000)] for n in [rnd.randint(0, N)]]
    pairs += [(k, 2 * m) for m in range(1, 200) for k in range(0, 2 * m + 1, max(1, m // 3))]  # exact halves
    df = spark.createDataFrame(pairs, "n long, N_all long")
    got = [r[0] for r in df.select(formatting.whole_percent(F.col("n"), F.col("N_all"))).collect()]
    # Python's round() is half-to-even on the exactly represented quotient
    assert got == [round(n * 100 / N) for n, N in pairs]


rows_strategy = st.lists(
    st.tuples(st.integers(0, 3), st.integers(1, 3), st.one_of(st.none(), st.integers(-5, 5))),
    min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(rows=rows_strategy)
def test_consolidate_equals_first_non_missing_in_order(spark, rows):
    data = [(k, w, i, v) for i, (k, w, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, w int, rid int, v int")
    got = {r["k"]: r["v"] for r in aggregate.consolidate(df, ["k"], ["w", "rid"], ["v"]).collect()}
    expect = {}
    for k, w, rid, v in sorted(data, key=lambda t: (t[1], t[2])):
        if k not in expect or expect[k] is None:
            expect[k] = v if expect.get(k) is None else expect[k]
    assert got == expect
