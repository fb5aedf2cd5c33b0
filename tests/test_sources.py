import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from askloom.sources.tables import (
    append_metrics, ensure_schema, explode_items, merged_schema, preview, questions_to_df, read_csv_source,
    read_demos, read_source, reset_schema, rows_to_df, to_driver, write_csv, write_merged, write_new,
    write_overwrite, write_report,
)


@pytest.fixture
def db(spark):
    reset_schema(spark, "src_db", really=True)
    return "src_db"


def test_tables(spark, db):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    write_new(df, f"{db}.t")
    with pytest.raises(AnalysisException):
        write_new(df, f"{db}.t")
    assert read_source(spark, f"{db}.t").collect() == df.collect()
    write_overwrite(df.select(F.lit(2.5).alias("other")), f"{db}.t")
    assert spark.table(f"{db}.t").columns == ["other"]


def test_merging_write_keeps_old_columns(spark, db):
    write_merged(spark.createDataFrame([(1, "a")], "id int, old string"), f"{db}.m")
    write_merged(spark.createDataFrame([("x", 2)], "new string, id int"), f"{db}.m")
    spark.catalog.refreshTable(f"{db}.m")
    got = spark.table(f"{db}.m")
    assert got.columns == ["id", "old", "new"] and [tuple(r) for r in got.collect()] == [(2, None, "x")]


def test_schemas(spark, db):
    ensure_schema(spark, db)
    write_new(spark.range(1), f"{db}.x")
    with pytest.raises(ValueError):
        reset_schema(spark, db)
    assert spark.catalog.tableExists(f"{db}.x")
    reset_schema(spark, db, db, really=True)
    assert not spark.catalog.tableExists(f"{db}.x")


def test_csv_with_awkward_texts(spark, tmp_path):
    texts = ['say "hi", ok', "two\nlines", "back\\slash", " padded ", 'ends with \\"', "é,;'", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    write_csv(df, str(tmp_path / "c"))
    got = {r.id: r.t for r in read_csv_source(spark, str(tmp_path / "c"), df.schema).collect()}
    assert got == dict(enumerate(texts))


def test_plain_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text('ticket,text\n1,"a ""b"" c\nd"\n2,plain\n')
    got = read_csv_source(spark, str(tmp_path / "p.csv"), "ticket int, text string").collect()
    assert [tuple(r) for r in got] == [(1, 'a "b" c\nd'), (2, "plain")]


def test_rows(spark):
    got = rows_to_df(spark, {"a": ["x", "y"], "b": []}, "issue")
    assert got.columns == ["category", "issue"] and [tuple(r) for r in got.collect()] == [("a", "x"), ("a", "y")]
    assert all(f.nullable for f in got.schema)
    items = spark.createDataFrame([({"a": ["x", "y"], "b": []},)], "m map<string,array<string>>")
    assert sorted(map(tuple, explode_items(items, "m", "issue").collect())) == [("a", "x"), ("a", "y")]


def test_questions(spark):
    got = questions_to_df(spark, [{"chunk_id": "c", "question": "q"}, None]).collect()
    assert tuple(got[0]) == ("c", "q", None, None) and got[1].error == "no question"


def test_demos(spark, tmp_path):
    demo = {"augmented": True, "request": "r", "context": "a\nContext: b", "rationale": "w", "response": "s"}
    program = {"program": {"lm": None, "traces": [], "train": [], "demos": [demo, dict(demo, request="r2")],
                           "signature_prefix": "Response:"}}
    (tmp_path / "p.json").write_text(json.dumps(program, indent=2))
    got = read_demos(spark, str(tmp_path / "p.json")).collect()
    assert [r.request for r in got] == ["r", "r2"] and got[0].asDict() == demo


def test_sinks(spark, db, tmp_path):
    long = spark.createDataFrame([("run", "m", 1.0)], "run_url string, metric string, value double")
    for _ in range(2):
        append_metrics(long, f"{db}.metrics")
    assert spark.table(f"{db}.metrics").count() == 2
    write_report(long, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first().metric == "m"


def test_samples(spark):
    assert len(to_driver(spark.range(10), 3)) == 3 and preview(spark.range(10), 4).count() == 4


def test_nested_fields_are_merged(spark, db):
    old = spark.createDataFrame(
        [((1, ("x", 2)), [{"a": 1}], {"k": (1,)}, "gone")],
        "r struct<id:int,deep:struct<p:string,q:int>>, xs array<struct<a:int>>, m map<string,struct<u:int>>, o string",
    )
    new = spark.createDataFrame(
        [(((7,), "t"), [None, ("b1",)], {"k": None, "l": (2.5,)}, 5), (None, None, None, 6)],
        "R struct<deep:struct<n:int>,extra:string>, xs array<struct<b:string>>, m map<string,struct<v:double>>, added int",
    )
    write_merged(old, f"{db}.nested")
    write_merged(new, f"{db}.nested")
    got = spark.read.table(f"{db}.nested")
    assert got.dtypes == [
        ("r", "struct<id:int,deep:struct<p:string,q:int,n:int>,extra:string>"), ("xs", "array<struct<a:int,b:string>>"),
        ("m", "map<string,struct<u:int,v:double>>"), ("o", "string"), ("added", "int"),
    ]
    full, empty = (r.asDict(recursive=True) for r in got.orderBy("added").collect())
    assert full["r"] == {"id": None, "deep": {"p": None, "q": None, "n": 7}, "extra": "t"}
    assert full["xs"] == [None, {"a": None, "b": "b1"}] and full["m"] == {"k": None, "l": {"u": None, "v": 2.5}}
    assert empty == {"r": None, "xs": None, "m": None, "o": None, "added": 6}
    # Once more: nothing is left to add.
    write_merged(new, f"{db}.nested")
    assert spark.read.table(f"{db}.nested").dtypes == got.dtypes


@pytest.mark.parametrize("old, new, where", [
    ("v int", "v string", "v"), ("s struct<a:array<int>>", "s struct<a:int>", "s.a"),
    ("m map<string,int>", "m map<int,int>", "m"), ("xs array<struct<a:int>>", "xs array<struct<a:double>>", "xs[].a"),
])
def test_clashing_types_are_named(spark, old, new, where):
    with pytest.raises(ValueError, match=where.replace("[", r"\[").replace("]", r"\]")):
        merged_schema(spark.createDataFrame([], new), spark.createDataFrame([], old).schema)
