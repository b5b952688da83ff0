"""Catalogs, rules, loads, versions, sources and the definition job."""

import json

from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import Row, functions as F, types as T
from twinledger.operators import load, rules, schema, versions
from twinledger.plans.standardise import changes, standardise, standardise_jobs, standardise_profiles
from twinledger.sources import shared, tables
from twinledger.sources.definitions import definition_schema, read_definitions, write_definitions
from twinledger.suite.corpus import POLICY, definitions, typed_definitions, typed_forms


def test_catalog_of_one_table(spark):
    base = spark.sql("select 1 a, 'x' B, date'2020-01-01' snapshot_day")
    other = spark.sql("select 'x' b, 2L A, 3 region_id")
    one, two = schema.describe(base, "S", "T"), schema.describe(other, "s", "t2")
    assert [r["column_name"] for r in schema.column_catalog(one.union(one), "s", "t").collect()] == ["a", "B", "snapshot_day"]
    with pytest.raises(Exception, match="no columns found"):
        schema.column_catalog(one, "s", "other").collect()
    assert {r["column_name"] for r in schema.common_columns(one, two).collect()} == {"a", "B"}
    assert [r["column_name"] for r in schema.only_columns(two, one).collect()] == ["region_id"]
    flags = schema.capability_flags(one).first()
    assert (flags["has_snapshot_day"], flags["has_region_id"]) == (True, False)
    assert rows(schema.summary(one, two)) == [("snapshot_day", "region_id", 3, 3, 2, "a int -> bigint")]
    assert schema.shared_names(base, other) == ["a", "B"]


def test_rules(spark):
    suites = spark.range(2).select(
        rules.build_suite(
            F.concat(F.lit("run"), "id"), F.concat(F.lit("diff"), "id"), F.lit("2024-01-01")
        ).alias("suite")
    )
    runs = spark.createDataFrame(
        [("run0", "SUCCESS", 3), ("diff0", "SUCCESS", 0), ("run1", "ERROR", 0)],
        "resource string, status string, rows_returned bigint",
    )
    result = rules.validate(rules.suite_rules(suites), runs)
    found = {(row["resource"], row["rule"]): row["outcome"] for row in result.collect()}
    assert found == {
        ("run0", "run succeeded"): "PASS",
        ("run0", "rows returned"): "PASS",
        ("diff0", "no difference"): "PASS",
        ("run1", "run succeeded"): "FAIL",
        ("run1", "rows returned"): "FAIL",
        ("diff1", "no difference"): "FAIL",
    }


def test_suite_reads_back_from_json(spark):
    suite = rules.build_suite(F.lit("r"), F.lit("d"), F.lit("2024-01-01"))
    text = spark.range(1).select(F.to_json(suite).alias("text"))
    parsed = text.select(F.from_json("text", rules.SUITE_SCHEMA).alias("suite"))
    assert rows(rules.suite_rules(parsed)) == rows(rules.suite_rules(spark.range(1).select(suite.alias("suite"))))


def test_clone_and_upsert(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    incoming = spark.createDataFrame([("new", 2, 0), ("c", 3, 0), ("m", None, 0)], "v string, k int, extra int")
    empty = load.clone_schema(base)
    assert empty.schema == base.schema and empty.count() == 0
    expected = sorted([(1, "a"), (2, "new"), (3, "c"), (None, "n"), (None, "m")], key=str)
    assert rows(load.upsert(base, incoming, ["k"])) == expected
    assert rows(load.upsert(base, incoming, ["k"], None)) == expected
    with pytest.raises(ValueError):
        load.upsert(base, incoming, ["k"], "OTHER")


def test_versions(spark):
    known = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "t string, v int, note string")
    asked = spark.createDataFrame([("a",), ("c",)], "t string")
    assert rows(versions.latest_version(known, ["t"], "v", ["note"])) == [("a", 3, "y"), ("b", 2, "z")]
    assert rows(versions.next_version(asked, known, ["t"], "v")) == [("a", 4), ("c", 1)]
    assert rows(versions.not_existing(asked, known, ["t"])) == [("c",)]


def test_materialise(spark):
    df = spark.range(10).select(F.when(F.col("id") > 4, "x y??").otherwise("z").alias("p"), "id")
    back = shared.materialise(df, "test", ("p",))
    assert back.columns == df.columns and rows(back) == rows(df)
    assert shared.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


class Settings(dict):
    """A session that only has settings."""

    @property
    def conf(self):
        return self


def test_shared_folder_without_the_setting():
    bare = Settings({"spark.master": "local[2]", "spark.sql.warehouse.dir": "hdfs://x/w/"})
    assert shared.shared_folder(bare) == "hdfs://x/w/_shared"
    own = Settings({"spark.sql.warehouse.dir": "file:/x/w"})
    own.sparkContext = SimpleNamespace(master="local[2]")
    assert shared.shared_folder(own) == "file:/x/w/_shared"
    own.sparkContext = SimpleNamespace(master="yarn")
    with pytest.raises(ValueError, match="one machine's own"):
        shared.shared_folder(own)
    named = Settings({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://x/y/"})
    assert shared.new_path(named, "t").startswith("hdfs://x/y/t-")


def test_tables_and_reports(spark, small, tmp_path):
    path = f"{small}/region.parquet"
    assert tables.read_table(spark, path).count() == tables.read_table(spark, path, "parquet").count()
    spark.read.parquet(path).createOrReplaceTempView("region_view")
    assert tables.read_table(spark, "region_view").count() == 5
    with pytest.raises(Exception):
        tables.read_table(spark, "no_such_table")
    written = tables.write_report(
        tables.read_table(spark, path), str(tmp_path) + "/DQ_{table}_{user}_{run}", "region", "ME", "7", 2
    )
    assert written.endswith("/DQ_REGION_me_7")
    assert spark.read.option("header", True).csv(written).count() == 5


def test_line_values_from_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("TableName: t1\nnoise\nVersionNumber: 3\nVersionNumber: 4\n")
    (tmp_path / "b.txt").write_text("nothing\n")
    labels = {"table": "TableName", "version": "VersionNumber"}
    found = tables.read_line_values(spark, str(tmp_path), labels).drop("path")
    assert rows(found) == [("t1", "4"), (None, None)]


def test_definitions_keep_unknown_fields(spark, tmp_path):
    jobs, profiles = tmp_path / "x" / "jobs", tmp_path / "x" / "y"
    jobs.mkdir(parents=True)
    profiles.mkdir()
    (jobs / "j.json").write_text(json.dumps({"definition": {"group": "PROMO 1", "odd": [1, 2], "schedule": {
        "type": "INTRADAY", "time": ["1"] * 12}}}, indent=4))
    (jobs / "note.txt").write_text("not a definition")
    (profiles / "my-profile.json").write_text(json.dumps({
        "definition": {"description": "Load - old", "loadOption": {"mergeOption": ""}},
        "inputs": [{"type": "FILE", "value": "a.txt", "keep": True}],
        "outputs": [{"value": "own.table_own"}, {"value": "PROMO.t"}]}, indent=4))
    docs = read_definitions(spark, str(tmp_path), definition_schema(spark, str(tmp_path)))
    assert {row["kind"] for row in docs.collect()} == {"job", "profile"}
    job = standardise_jobs(docs.filter("kind = 'job'"), POLICY)
    profile = standardise_profiles(docs.filter("kind = 'profile'"), POLICY)
    out = str(tmp_path / "out")
    named = [d.drop("before").withColumn("name", F.lit(n)) for d, n in ((job, "j"), (profile, "p"))]
    write_definitions(named[0], out + "/1", "name")
    write_definitions(named[1], out + "/2", "name")
    back = {}
    for file in (tmp_path / "out").rglob("*.json"):
        if file.read_text().strip():
            back[file.parent.name] = json.loads(file.read_text())
    assert back["file=j"] == {
        "definition": {"group": "$[TeamB]", "odd": [1, 2], "owner": "$[Keeper]"},
        "schedule": "$[Scheduled2Hourly]",
    }
    assert back["file=p"] == {
        "definition": {"description": "Load - my-profile$[Stage]", "loadOption": {"mergeOption": "UPSERT"}},
        "inputs": [{"type": "FILE", "value": "a$[Stage].txt", "keep": True}],
        "outputs": [{"value": "$[Source].table_$[Source]$[Stage]"}, {"value": "$[SourceB].t$[Stage]"}],
    }
    with pytest.raises(Exception):
        write_definitions(named[0], out + "/1", "name")


def test_standardising_twice_is_once(spark, small):
    docs = definitions(spark, small)
    for kind, job in (("job", standardise_jobs), ("profile", standardise_profiles)):
        once = job(docs.filter(F.col("kind") == kind), POLICY)
        twice = job(once.drop("before"), POLICY)
        assert rows(twice.select(F.to_json("doc"))) == rows(once.select(F.to_json("doc")))
        fields = ("definition.group", "definition.description", "outputs", "schedule")
        assert changes(twice, fields).count() == 0
        assert changes(once, fields).count() > 0


def test_all_forms_twice_are_once(spark, small):
    docs = typed_definitions(spark, small)
    once = standardise(docs, typed_forms())
    twice = standardise(once.drop("before"), typed_forms())
    assert rows(twice.select(F.to_json("doc"))) == rows(once.select(F.to_json("doc")))
    assert changes(once, ("outputs",)).count() > 0 and changes(twice, ("outputs", "inputs")).count() == 0


def test_odd_file_names_and_empty_arrays(spark, tmp_path):
    names = ["my load (1)", "50% off", "a+b", "plain"]
    (tmp_path / "jobs").mkdir()
    for name in names:
        doc = {"definition": {"description": "x - y"}, "inputs": [], "outputs": []}
        (tmp_path / "jobs" / f"{name}.json").write_text(json.dumps(doc))
    schema = definition_schema(spark, str(tmp_path))
    docs = read_definitions(spark, str(tmp_path), schema)
    assert {row["path"].rsplit("/", 1)[1] for row in docs.collect()} == {f"{n}.json" for n in names}
    done = standardise_profiles(docs, POLICY).select("doc.definition.description").collect()
    assert {row[0] for row in done} == {f"x - {n}$[Stage]" for n in names}
    known = T.StructType().add("inputs", T.ArrayType(T.StructType().add("type", "string").add("value", "string")))
    wide = definition_schema(spark, str(tmp_path), known)
    assert wide["inputs"].dataType == known["inputs"].dataType
    assert standardise_profiles(read_definitions(spark, str(tmp_path), wide), POLICY).count() == 4


def test_both_kinds_in_one_write(spark, small, tmp_path):
    docs = definitions(spark, small)
    write_definitions(docs, str(tmp_path / "out"))
    back = read_definitions(spark, str(tmp_path / "out"), docs.schema["doc"].dataType, one_per_file=False)
    assert rows(back.select("kind", F.to_json("doc"))) == rows(docs.select("kind", F.to_json("doc")))


def test_upsert_of_repeated_and_null_keys(spark):
    base = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, v string, w int")
    incoming = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (2, "z", 2), (None, "n", 1), (3, "q", 0)], "k int, v string, t int")
    with pytest.raises(Exception, match="repeat a key"):
        load.upsert(base, incoming, ["k"]).collect()
    once = load.upsert(base, incoming, ["k"], order=["t"])
    found = rows(once)
    assert (1, "a", 5) in found and (3, "q", None) in found and (None, "n", None) in found
    assert [r for r in found if r[0] == 2] in ([(2, "y", None)], [(2, "z", None)])
    turned = load.upsert(base, incoming.orderBy(F.desc("v")).repartition(3), ["k"], order=["t"])
    assert rows(turned) == found
    again = rows(load.upsert(once, incoming, ["k"], order=["t"]))
    assert len(again) == len(found) + 1  # only the row with a NULL key


def test_version_ties_and_stages(spark):
    known = spark.createDataFrame([("a", 1, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "n")], "t string, v int, note string")
    assert rows(versions.latest_version(known, ["t"], "v", ["note"])) == [("a", 1, "z"), ("b", None, None)]
    metadata = spark.createDataFrame([("a", "beta", 1, "s"), ("a", "prod", 2, "s"), ("b", "prod", 3, "s")], "t string, stage string, version int, scheme string")
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")
    found = versions.stage_lookup(asked, metadata, ["t"])
    assert rows(found.select("t", "missing_stages")) == [("a", None), ("b", "beta"), ("c", "beta,prod")]
    assert {r["t"] for r in versions.config_long(found.withColumn("abbreviation", F.lit("z"))).collect()} == {"a"}


def stored_table(spark, rows, schema, *parts):
    path = shared.new_path(spark, "base")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.createDataFrame(rows, schema).write.partitionBy(*parts).option("path", path).saveAsTable(name)
    return name


def test_upsert_into_partitions(spark):
    schema = "k int, v string, day string, zone int"
    base = [(1, "a", "mon", 1), (2, "b", "mon", 1), (3, "c", "tue", 1), (4, "d", None, 2), (5, "e", "o'x", 2), (None, "f", "wed", 1)]
    name = stored_table(spark, base, schema, "day", "zone")
    before = {r.day: r.file for r in spark.table(name).select("day", F.col("_metadata.file_path").alias("file")).collect()}
    incoming = [(2, "B", "mon", 1, 1), (3, "C", "mon", 1, 1), (3, "CC", "mon", 1, 2), (5, "E", None, 2, 1), (9, "N", "thu", 3, 1), (None, "F", "mon", 1, 1)]
    done = load.upsert_table(name, spark.createDataFrame(incoming, schema + ", n int"), ["k"], ["n"])
    assert sorted(map(tuple, done.collect()), key=str) == sorted(
        [(1, "a", "mon", 1), (2, "B", "mon", 1), (3, "CC", "mon", 1), (4, "d", None, 2), (5, "E", None, 2), (9, "N", "thu", 3),
         (None, "f", "wed", 1), (None, "F", "mon", 1)], key=str
    )
    after = {r.day: r.file for r in done.select("day", F.col("_metadata.file_path").alias("file")).collect()}
    assert after["wed"] == before["wed"] and after["mon"] != before["mon"] and "tue" not in after and "o'x" not in after
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 4


def test_upsert_into_partitions_reads_the_touched_ones(spark):
    schema = "k int, day string, v string"
    name = stored_table(spark, [(n, f"d{n % 5}", "x" * 5) for n in range(50)], schema, "day")
    rest = spark.table(name).filter(load._is_among({Row(day="d1"), Row(day="d3")}, ["day"]))
    assert len(rest.inputFiles()) == 5 * 2 or {f.split("day=")[1][:2] for f in rest.inputFiles()} == {"d1", "d3"}
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan
    load.upsert_table(name, spark.createDataFrame([], schema), ["k"])
    load.upsert_table(name, spark.createDataFrame([(1, "d1", "new")], schema), ["k", "day"])
    assert spark.table(name).count() == 50 and spark.table(name).filter("v = 'new'").count() == 1
    with pytest.raises(ValueError, match="no partitions"):
        path = shared.new_path(spark, "flat")
        spark.range(3).write.option("path", path).saveAsTable("flat_table")
        load.upsert_table("flat_table", spark.range(1), ["id"])


def test_unknown_fields_of_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"definition": {"owner": "x", "extra": 1, "list": [{"k": 1, "n": 2}]}, "more": 2}')
    schema = T._parse_datatype_string("definition struct<owner:string, list:array<struct<k:long>>>")
    read = read_definitions(spark, str(tmp_path), schema)
    assert read.first().doc.definition.owner == "x"
    with pytest.raises(ValueError, match=r"definition\.extra, definition\.list\[\]\.n, more"):
        read_definitions(spark, str(tmp_path), schema, strict=True)
    whole = definition_schema(spark, str(tmp_path), schema)
    assert read_definitions(spark, str(tmp_path), whole, strict=True).count() == 1


@pytest.mark.parametrize("bounds", [(3, 90), (None, None)])
def test_split_reads_ask_for_their_bounds(monkeypatch, bounds):
    """No database is at hand: what would be read."""
    asked = []

    def read(spark, name, format, **options):
        asked.append((name, options))
        return SimpleNamespace(head=lambda: bounds)

    monkeypatch.setattr(tables, "read_table", read)
    tables.read_split(None, "s.t", "id", 16, url="u")
    assert asked[0] == ("(SELECT MIN(id) AS lo, MAX(id) AS hi FROM s.t) bounds", {"url": "u"})
    split = {"partitionColumn": "id", "lowerBound": "3", "upperBound": "90", "numPartitions": 16}
    assert asked[1:] == [("s.t", {"url": "u"} | (split if bounds[0] else {}))]
