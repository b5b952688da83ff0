"""Documents patched as text, and files of their own names."""

import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from twinledger.functions.nested import patch_document
from twinledger.plans.standardise import Edit, Form, standardise
from twinledger.sources import named
from twinledger.sources.definitions import patched_documents, read_documents

SCHEMA = "a struct<own:string,sch:struct<x:int>>, s string, t boolean, items array<struct<v:string>>"


def patched(spark, text, change, schema=SCHEMA):
    df = spark.createDataFrame([(text,)], "t string").withColumn("before", F.from_json("t", schema))
    df = df.withColumn("after", change(F.col("before")))
    kinds = [df.schema[name].dataType for name in ("before", "after")]
    return df.select(patch_document(F.col("t"), F.col("before"), F.col("after"), *kinds)).head()[0]


def owned(doc):
    return doc.withField("a", doc["a"].withField("own", F.lit('new "x"')))


def test_what_is_unknown_stays(spark):
    text = (
        r'{"z": 1.50, "a": {"q" : 1e3, "own": "me", "b":[1, 2.0, null], "u":"{\"k\":1}"}, "s": "1", "n": null, "e":"",'
        r' "long": 12345678901234567890123456789012345678901234567890, "t": true, "odd":"\u0001s\"\u0001n1\""}'
    )
    new = patched(spark, text, owned)
    exact = {"parse_float": str, "parse_int": str, "object_pairs_hook": list}
    expected = text.replace('"me"', r'"new \"x\""')
    assert json.loads(new, **exact) == json.loads(expected, **exact)


def test_a_text_without_a_change_stays_byte_for_byte(spark):
    text = '{ "a" : {"own":"me"},\n  "x": 1.0 }'
    assert patched(spark, text, lambda doc: doc) == text


@pytest.mark.parametrize("text", [None, "", "no json", "[1]", "3", '{"a":', "{}"])
def test_no_object_to_change(spark, text):
    assert patched(spark, text, owned) == text


def test_fields_come_and_go(spark):
    text = '{"s":"1","a":{"sch":{"x":1,"y":2.50},"own":"me"},"t":null}'
    gone = patched(spark, text, lambda d: d.withField("a", d["a"].dropFields("own")).withField("new", F.lit(5)))
    assert gone == '{"s":"1","a":{"sch":{"x":1,"y":2.50},"own":"me"},"t":null,"new":5}'
    none = F.lit(None).cast("string")
    gone = patched(spark, text, lambda d: d.withField("a", d["a"].withField("own", none)))
    assert gone == '{"s":"1","a":{"sch":{"x":1,"y":2.50}},"t":null}'
    inner = patched(spark, text, lambda d: d.withField("a", d["a"].withField("sch", F.struct(F.lit(7).alias("x")))))
    assert inner == '{"s":"1","a":{"sch":{"x":7,"y":2.50},"own":"me"},"t":null}'


def test_items(spark):
    text = '{"items":[{"w":1.10,"v":"A"},null,{"v":"b","v2":[]}]}'
    upper = lambda doc: doc.withField("items", F.transform(doc["items"], lambda i: i.withField("v", F.upper(i["v"]))))
    assert patched(spark, text, upper) == '{"items":[{"w":1.10,"v":"A"},null,{"v":"B","v2":[]}]}'
    fewer = lambda doc: doc.withField("items", F.slice(doc["items"], 1, 1))
    assert patched(spark, text, fewer) == '{"items":[{"v":"A"}]}'


def test_a_repeated_key_is_set_throughout(spark):
    assert patched(spark, '{"a":{"own":"x","own":"y"}}', owned) == r'{"a":{"own":"new \"x\"","own":"new \"x\""}}'


def test_long_texts_and_odd_names(spark):
    long = "x\\n\\\"" * 200_000
    text = f'{{"a\\"b":1.0,"a":{{"own":"me","body":"{long}"}},"é\\u0001":[]}}'
    new = json.loads(patched(spark, text, owned))
    assert new["a"]["own"] == 'new "x"' and new["a"]["body"] == 'x\n"' * 200_000
    assert list(new) == ['a"b', "a", "é\x01"]


def test_edits_of_a_corpus(spark):
    texts = ['{"v":"1","more":{"n":1.0}}', '{"v":2,"more":[]}', "broken", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("doc", F.from_json("text", "v string"))
    edits = [Edit("v", lambda v, i, d: F.when(v == "1", "one").otherwise(v)), Edit("owner", lambda v, i, d: F.lit("me"), added=True)]
    done = patched_documents(standardise(docs, [Form(F.lit(True), edits)]))
    assert {r.text for r in done.collect()} == {
        '{"v":"one","more":{"n":1.0},"owner":"me"}', '{"v":2,"more":[],"owner":"me"}', "broken", None,
    }


def test_named_files(spark, tmp_path):
    root = f"{tmp_path}/out"
    given = {"a/b.json": '{"x":1.50,"s":"{,}","l":[],"m":[1,{}]}', "a/c/é f+.json": '{"x":2}', "d.json": None}
    df = spark.createDataFrame([(k, v, "extra") for k, v in given.items()], "path string, text string, name string")
    named.write_named(df.repartition(3), root, indent=4)
    assert sorted(os.listdir(root)) == ["_SUCCESS", "a", "d.json"]
    assert open(f"{root}/_SUCCESS").read() == "3"
    whole = '{"x":1.50,"s":"{,}","l":[],"m":[1,{}]}'
    laid_out = open(f"{root}/a/b.json").read()
    assert laid_out == json.dumps(json.loads(whole), indent=4).replace("1.5,", "1.50,")
    assert os.path.getsize(f"{root}/d.json") == 0
    read = read_documents(spark, root, "x double").select("path", "doc.x").collect()
    assert {r.path.split(root + "/")[-1]: r.x for r in read} == {"a/b.json": 1.5, "a/c/é f+.json": 2.0}
    with pytest.raises(ValueError, match="there already"):
        named.write_named(df, root)


@pytest.mark.parametrize("name", [None, "", "/etc/x.json", "../x.json", "a/../../x.json", "_x.json", "a/.x", "a//x", "a/"])
def test_names_that_are_refused(spark, tmp_path, name):
    df = spark.createDataFrame([(name, "{}")], "path string, text string")
    with pytest.raises(ValueError, match="not usable"):
        named.write_named(df, f"{tmp_path}/out")
    assert not os.path.exists(f"{tmp_path}/out")


def test_a_repeated_name_is_refused(spark, tmp_path):
    df = spark.createDataFrame([("x.json", "{}"), ("x.json", "[]")], "path string, text string")
    with pytest.raises(ValueError, match="x.json"):
        named.write_named(df, f"{tmp_path}/out")


def test_no_documents(spark, tmp_path):
    named.write_named(spark.createDataFrame([], "path string, text string"), f"{tmp_path}/out")
    assert os.listdir(f"{tmp_path}/out") == ["_SUCCESS"]


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    df = spark.range(8).select(
        F.format_string("n%s.json", "id").alias("path"),
        F.when(F.col("id") < 7, F.lit("{}")).otherwise(F.raise_error(F.lit("lost"))).alias("text"),
    )
    with pytest.raises(Exception, match="lost"):
        named.write_named(df, f"{tmp_path}/out")
    assert not os.path.exists(f"{tmp_path}/out")


def test_a_task_run_again_writes_the_same(tmp_path):
    writer = named.NamedWriter(f"file://{tmp_path}/out", None)
    rows = [("a/x.json", "{}"), ("y.json", "[]")]
    first = writer.write(iter(rows[:1]))
    assert first.files == 1
    again = writer.write(iter(rows))
    writer.commit([again, None])
    assert sorted(os.listdir(f"{tmp_path}/out")) == ["_SUCCESS", "a", "y.json"]
    assert open(f"{tmp_path}/out/_SUCCESS").read() == "2"
    writer.abort([SimpleNamespace(files=0)])
    assert not os.path.exists(f"{tmp_path}/out")
