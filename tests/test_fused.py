"""The one-pass participant table against the join of its four tables."""

import pytest
from pyspark.sql import functions as F

from panelkit.plans import fused, pipeline
from panelkit.sources import panel
from paths import SMALL


def joined_tables(roster, responses, repair):
    j = pipeline.join_panel(roster, responses, panel.BOOK)
    surveys = pipeline.survey_rows(roster, responses, panel.BOOK)
    outcomes = pipeline.nest_outcomes(pipeline.construct_outcomes(j, panel.BOOK, dedup=True), panel.BOOK)
    return pipeline.assemble(pipeline.construct_root(j, panel.BOOK), pipeline.construct_hope(surveys, repair, panel.BOOK),
                             outcomes, pipeline.construct_satis(responses, panel.BOOK))


def same(a, b):
    assert a.columns == b.columns and a.dtypes == b.dtypes
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_equals_the_four_tables(spark):
    tables = panel.survey_roster(spark, SMALL), panel.responses(spark, SMALL)
    for repair in (panel.repair(spark, SMALL), None):
        same(fused.participants(*tables, repair, panel.BOOK), joined_tables(*tables, repair))


@pytest.mark.parametrize("change", ["other people", "other waves", "other tags", "hot person", "null person", "null versions"])
def test_rows_whose_sides_differ(spark, change):
    roster, responses, repair = panel.survey_roster(spark, SMALL), panel.responses(spark, SMALL), panel.repair(spark, SMALL)
    odd = F.col("response_id") % 3 == 0
    if change == "other people":
        roster = roster.withColumn("enrollment_id", F.when(odd, F.col("enrollment_id") + 1).otherwise(F.col("enrollment_id")))
    elif change == "other waves":
        roster = roster.withColumn("wave", F.when(odd, F.pmod("wave", F.lit(5)) + 1).otherwise(F.col("wave")).cast("int"))
    elif change == "other tags":
        roster = roster.withColumn("survey_name", F.when(odd, F.concat("survey_name", F.lit("x"))).otherwise(F.col("survey_name")))
    elif change == "hot person":
        roster, responses = (t.withColumn("enrollment_id", F.when(F.col("enrollment_id") % 3 == 0, 3).otherwise(F.col("enrollment_id")).cast("long"))
                             for t in (roster, responses))
    elif change == "null person":
        roster, responses = (t.withColumn("enrollment_id", F.when(F.col("enrollment_id") % 9 != 0, F.col("enrollment_id"))) for t in (roster, responses))
    else:
        roster, responses = (t.withColumn("version", F.when(~odd, F.col("version"))) for t in (roster, responses))
    same(fused.participants(roster, responses, repair, panel.BOOK), joined_tables(roster, responses, repair))


def test_one_side_empty(spark):
    roster, responses, repair = panel.survey_roster(spark, SMALL), panel.responses(spark, SMALL), panel.repair(spark, SMALL)
    assert fused.participants(roster.limit(0), responses, repair, panel.BOOK).count() == 0
    assert fused.participants(roster, responses.limit(0), repair, panel.BOOK).count() == 0


def test_parts_alone(spark):
    tables = panel.survey_roster(spark, SMALL), panel.responses(spark, SMALL), panel.repair(spark, SMALL)
    whole = joined_tables(*tables)
    for part, columns in (("hope", ["ehs"]), ("outcomes", ["outcomes"]), ("satisfaction", [c for c in whole.columns if c.startswith("satis_")])):
        own = [c for c in whole.columns if c not in ("ehs", "outcomes") and not c.startswith("satis_")]
        same(fused.participants(*tables, panel.BOOK, parts=[part]), whole.select(*own, *columns))


def test_outcomes_with_their_responses(spark):
    from panelkit.operators import reshape

    tables = panel.survey_roster(spark, SMALL), panel.responses(spark, SMALL)
    people = fused.participants(*tables, None, panel.BOOK, parts=["outcomes"], counts=True)
    got = reshape.unnest(people.select("enrollment_id", "outcomes"), "outcomes")
    want = pipeline.outcomes_per_wave(pipeline.join_panel(*tables, panel.BOOK), panel.BOOK)
    want = want.join(people.select("enrollment_id"), "enrollment_id", "left_semi").select(got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
