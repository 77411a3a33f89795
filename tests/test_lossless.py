"""Values that must come back as they were: CSV cells, stacked types, unlike records and files."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.operators import joins, schema
from panelkit.session import scratch_dir
from panelkit.sources import files, landed, records

TEXTS = [None, "", "NA", "\\N", "\\", "\\\\N", " NA ", "null", '"', '""', "a,b", "line\nfeed", "\r", "'", "\\\"", "#", " ", "é日😀", ",", '\\"N']


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("single", [True, False])
def test_every_text_comes_back_from_csv(spark, single):
    path = scratch_dir(spark, "csv-texts")
    df = spark.createDataFrame([(i, t, None if i % 2 else i / 2, "x") for i, t in enumerate(TEXTS)], "id int, t string, `d d` double, last string")
    files.write_csv(df, path, single_file=single)
    assert rows(files.read_csv(spark, path, schema=df.schema)) == rows(df)
    assert rows(files.read_csv(spark, path, schema="id int, t string, `d d` double, last string")) == rows(df)


def test_missing_text_and_malformed_rows_come_apart(spark):
    path = scratch_dir(spark, "csv-bad")
    spark.createDataFrame([("id,t,n\n1,NA,5\n2,\\N,\\N\n3,\"\",7\nfour,x,8\n5,y,9,extra\n",)], "value string").coalesce(1).write.text(path)
    got = {r["t"]: (r["id"], r["n"], r["_bad"]) for r in files.read_csv(spark, path, schema="id int, t string, n int", corrupt="_bad").collect()}
    assert got["NA"] == (1, 5, None) and got[None] == (2, None, None) and got[""] == (3, 7, None)
    assert got["x"] == (None, 8, "four,x,8") and got["y"][2] == "5,y,9,extra"
    for columns in ("*", "t"):
        with pytest.raises(Exception, match="MALFORMED|malformed"):
            files.read_csv(spark, path, schema="id int, t string, n int").select(columns).collect()


def test_another_mark_of_missing_values(spark):
    path = scratch_dir(spark, "csv-na")
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "\\N")], "id int, t string")
    files.write_csv(df, path, missing="NA")
    assert rows(files.read_csv(spark, path, schema=df.schema, missing="NA")) == rows(df)
    with pytest.raises(Exception, match="equals the mark"):
        files.write_csv(df.union(spark.createDataFrame([(4, "NA")], df.schema)), path + "x", missing="NA")


def test_stacking_keeps_large_numbers(spark):
    big = 2**53 + 1
    of = lambda t, *v: spark.createDataFrame([(x,) for x in v], f"x {t}")
    out = joins.union_by_name([of("long", big), of("decimal(10,2)", Decimal("1.25")), of("int", 7)])
    assert out.dtypes == [("x", "decimal(21,2)")] and {r[0] for r in out.collect()} == {Decimal(big), Decimal("1.25"), 7}
    ok = joins.union_by_name([of("long", 2**53, None, -2**63), of("double", 0.5), of("float", 0.25)])
    assert {r[0] for r in ok.collect()} == {2.0**53, None, -2.0**63, 0.5, 0.25}
    for whole in (big, 2**63 - 1):
        with pytest.raises(Exception, match="is no double"):
            joins.union_by_name([of("long", whole), of("double", 0.5)]).collect()
    near = joins.union_by_name([of("decimal(3,1)", Decimal("0.1")), of("double", 0.5)])
    assert {r[0] for r in near.collect()} == {0.1, 0.5}
    assert joins.union_by_name([of("byte", 1), of("short", 300)]).dtypes == [("x", "smallint")]
    days = joins.union_by_name([of("date", dt.date(2024, 1, 2)), of("timestamp", dt.datetime(2024, 1, 2, 3))])
    assert {r[0] for r in days.collect()} == {dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 3)}


def test_names_spell_signs_out(spark):
    names = {"% done": "percent_done", "# jobs": "number_jobs", "Don't know": "dont_know", 'the "other"': "the_other", "Montréal (QC)": "montreal_qc",
             "%": "percent", "a%b": "a_percent_b", "custKey": "cust_key", "HTTPServer": "http_server", "2024": "x2024", "--": "x"}
    assert {n: schema.clean_name(n) for n in names} == names


def test_records_of_unlike_shapes(spark):
    df = spark.createDataFrame([(1, '{"a":1,"b c":{"attributes":1,"x":[{"attributes":2,"y":1},{"y":null}]},"attributes":{"t":1}}'),
                                (2, '{"a":"t","z":null,"only":{"attributes":{}},"deep":{"p":{"q":true}}}'), (3, None), (4, '{"a":null,"d`d":2.5}')], "k int, j string")
    out = records.flatten_unknown(df, "j", keep=["k"])
    got = {r["k"]: r.asDict(recursive=True) for r in out.collect()}
    assert set(out.columns) == {"k", "a", "b c.x", "d`d", "deep.p.q", "z"}
    assert got[1]["b c.x"] == [{"y": 1}, {"y": None}]
    assert [got[k]["a"] for k in (1, 2, 3, 4)] == ["1", '"t"', None, None]
    assert got[2]["deep.p.q"] is True and got[4]["d`d"] == Decimal("2.5")
    assert all(v is None for c, v in got[3].items() if c != "k")


def test_records_none_and_malformed(spark):
    none = spark.createDataFrame([], "j string")
    assert records.flatten_unknown(none, "j").count() == 0
    with pytest.raises(Exception, match="MALFORMED_RECORD|parse"):
        records.flatten_unknown(spark.createDataFrame([('{"a":',)], "j string"), "j").collect()


def test_landed_files_of_unlike_columns(spark):
    root = scratch_dir(spark, "landed-test")
    spark.createDataFrame([(1, 5)], "`Response Id` long, `Job Hours` int").write.parquet(f"{root}/SV_1")
    spark.createDataFrame([(2, 2**40, "x")], "response_id long, job_hours long, `% done` string").write.parquet(f"{root}/SV 2")
    spark.createDataFrame([], "`Response Id` long, `Job Hours` int").write.parquet(f"{root}/SV_3")
    got = landed.read_landed(spark, root)
    assert got.columns == ["response_id", "job_hours", "percent_done", "survey_id"]
    assert rows(got) == [(1, 5, None, "SV_1"), (2, 2**40, "x", "SV 2")]
    registry = StructType().add("Response Id", "long").add("% done", "string")
    assert rows(landed.read_landed(spark, root, registry).select("survey_id", "response_id", "percent_done")) == [("SV 2", None, "x"), ("SV_1", 1, None)]
    p = got._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan parquet") == 1
