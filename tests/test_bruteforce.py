"""Brute-force cross-checks in pandas on the smallest tables, written from the
report rules directly (independent of both the Spark code and the SQL oracle)."""

import pandas as pd

import __spark_entry__ as E
from paths import SMALL
from panelkit import codebook as cb
from panelkit.plans import pipeline
from panelkit.sources import panel


def first_non_missing(s: pd.Series):
    s = s.dropna()
    return s.iloc[0] if len(s) else None


def test_consolidation_matches_sorted_first_non_missing(spark):
    joined = pipeline.join_panel(panel.survey_roster(spark, SMALL), panel.responses(spark, SMALL))
    from panelkit.plans.harmonise import harmonise_baseline

    rows = harmonise_baseline(pipeline.baseline_rows(joined), panel.BOOK).toPandas()
    rows = rows.sort_values(["wave", "version", "response_id"])
    expect = rows.groupby("enrollment_id").agg(
        {c: first_non_missing for c in ["demo_province_fct", "demo_age", "demo_racialized_lgl"]})
    got = E.queries()["consolidate_baseline"](spark, SMALL).toPandas().set_index("enrollment_id")
    for c in expect.columns:
        for k, v in expect[c].items():
            g = got.loc[k, c]
            assert (pd.isna(v) and pd.isna(g)) or g == v, (c, k, v, g)


def test_quarterly_cells_match_counts(spark):
    root = E.queries()["consolidate_baseline"](spark, SMALL).toPandas()
    d = pd.DataFrame({
        "arm": root["assignment_label_fct"],
        "demo_immigrant_lgl": root["demo_immigrant_lgl"],
        "demo_young_lgl": root["demo_age"].map(lambda a: None if a is None or pd.isna(a) else a < 30),
    })
    table = E.queries()["quarterly_table"](spark, SMALL).toPandas().set_index("var")
    labels = dict(cb.QUARTERLY_LABELS)
    for flag in ["demo_immigrant_lgl", "demo_young_lgl"]:
        label = labels[flag].split("--", 1)[1]
        for arm in [*cb.ARM_LEVELS, cb.TOTAL_LABEL]:
            sub = d if arm == cb.TOTAL_LABEL else d[d["arm"] == arm]
            vals = sub[flag].dropna()
            n, N = int(vals.astype(bool).sum()), len(vals)
            pct = round(n * 100 / N)  # Python's round is half-to-even
            assert table.loc[label, arm] == f"{pct}% ({n}/{N})"


def test_top_box_strict_rule(spark):
    p = panel.responses(spark, SMALL).toPandas()
    got = E.queries()["top_box"](spark, SMALL).toPandas()
    w2 = p[(p["wave"] == 2) & p["response_id"].notna()]
    names = cb.SATISFACTION_NAMES[2]
    for version, grp in w2.groupby("version"):
        for j, name in enumerate(names, start=1):
            col = grp[f"satis_{j}"]
            mx = None if col.isna().any() else col.max()
            sub = got[(got["version"] == version) & (got["wave"] == 2)].set_index("response_id")[name]
            for rid, code in zip(grp["response_id"], col):
                exp = None if mx is None or pd.isna(code) else (mx - code) <= 1
                g = sub.loc[rid]
                assert (exp is None and pd.isna(g)) or bool(g) == exp
