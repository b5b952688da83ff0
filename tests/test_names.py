"""Text, naming, schedules and nested edits: quirks and idempotence."""

import datetime
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from twinledger.functions import dates, nested, schedule, text
from twinledger.operators import naming
from twinledger.operators.naming import Rule


def one(spark, column, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, F.lit(value))
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "edit",
    [
        lambda v: text.insert_token(v, "."),
        lambda v: text.insert_token(v, "{", text.FILE_STAGE_TOKEN),
        lambda v: text.rebuild_text(v, F.lit("folder")),
        lambda v: text.append_suffix(v),
        lambda v: text.prefix_by_type(F.lit("LOAD"), v, (("LOAD", "Load-"),), "Done"),
        lambda v: naming.map_first_match(v, [Rule("a", "$[A]"), Rule("b", "$[B]")]),
    ],
)
@pytest.mark.parametrize("value", ["ab.c{d}", "plain", "", "x - y.z", "a$[Stage]"])
def test_twice_is_once(spark, edit, value):
    assert one(spark, edit(edit(F.col("v"))), v=value) == one(spark, edit(F.col("v")), v=value)


def test_insert_token(spark):
    assert one(spark, text.insert_token(F.col("v"), "."), v="a.b.c") == "a$[Stage].b.c"
    assert one(spark, text.insert_token(F.col("v"), "."), v=".b") == "$[Stage].b"
    assert one(spark, text.insert_token(F.col("v"), "."), v="none") == "none"


def test_rebuild_text(spark):
    folder = text.folder_of(F.lit("/x/y-z/profile.json"))
    assert one(spark, text.rebuild_text(F.col("v"), folder), v="Old -a-b") == "Old - profile$[Stage]"


def test_shadowed_rule(spark):
    rules = [Rule("DW", "$[Short]", whole=True), Rule("DWRS", "$[Long]", whole=True)]
    assert one(spark, naming.map_first_match(F.col("v"), rules), v="x DWRS") == "$[Short]"
    assert one(spark, naming.map_first_match(F.col("v"), rules), v="other") == "other"
    narrowed = [Rule("DW", "$[S]", where=F.lit(False)), Rule("DWRS", "$[L]")]
    assert one(spark, naming.map_first_match(F.col("v"), narrowed), v="x DWRS") == "x $[L]"


def test_routes_are_lists(spark):
    route = naming.route_by_type(F.col("v"), [("r", ["SCRIPT"])])
    assert one(spark, route, v="CRAD") is None
    assert one(spark, route, v="SCRIPT") == "r"


def test_replace_head(spark):
    assert one(spark, naming.replace_head(F.col("v"), "$[P]"), v="ab.x_ab") == "$[P].x_$[P]"
    assert one(spark, naming.replace_head(F.col("v"), "$[P]"), v="nodot") == "nodot"


def test_slug(spark):
    assert one(spark, text.slug(F.col("v")), v="A b*: [x](y)/z.{1}--") == "A-b-xy_z1"
    assert one(spark, text.slug(F.col("v")), v="a (b -)") == "a-b--"
    assert one(spark, text.slug(F.col("v")), v="end -: ") == "end"
    assert one(spark, text.slug(F.col("v"), lower=True, dropped=["_beta"]), v="T_BETA") == "t"


def test_prefix(spark):
    prefixes = (("LOAD_A", "TL-"), ("LOAD", "L-"))

    def named(kind, value):
        return one(spark, text.prefix_by_type(F.lit(kind), F.col("v"), prefixes, "Done"), v=value)

    assert named("LOAD_A", "a b") == "TL-a-b"
    assert named("SQL_LOAD", "a b") == "L-a-b"
    assert named("LOAD", "Done a b") == "Done a b"
    assert named("OTHER", "a b") == "a b"


def test_line_value(spark):
    log = "x\nTableName: a:b\nTableName:  c d \n TableName: e"
    assert one(spark, text.line_value(F.col("v"), "TableName"), v=log) == "c d"
    assert one(spark, text.line_value(F.col("v"), "Other"), v=log) is None


def test_abbreviations(spark):
    names = ["s.order_item", "s.open_invoice", "s.other_item", "t.o_i", "s.x"]
    df = spark.createDataFrame([(n,) for n in names * 2], "name string")
    result = {name: (base, short) for name, base, short in rows(naming.abbreviate(df))}
    assert len(result) == 5
    assert result["s.x"] == ("x", "x")
    group = {n: s for n, (base, s) in result.items() if base == "oi"}
    assert len(group) == 4 and "oi" in group.values()
    plain = [n for n, s in group.items() if s == "oi"]
    longer = sorted(s for n, s in group.items() if n not in plain)
    assert all(s.startswith("oi") for s in longer)


def test_abbreviation_counters(spark):
    """Names alike in base and last three characters: plain, 1, 2, 3."""
    df = spark.range(6).select(F.concat(F.lit("s.o"), "id", F.lit("_item")).alias("name"))
    found = sorted(row[2] for row in rows(naming.abbreviate(df)))
    assert found == ["oi", "oitem", "oitem1", "oitem2", "oitem3", "oitem4"]


def test_abbreviations_are_unique_over_bases_and_against_those_in_use(spark):
    names = ["p.a_b1cde", "p.a_b_c_d_e", "p.q_r", "p.o_i1", "q.o_i1", "r.o_i1", "s.o_i1_x"] + [
        f"t{i}.o_item" for i in range(30)
    ]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
    used = spark.createDataFrame([("qr",), ("oitem",), ("oitem3",), ("oi",)], "abbreviation string")
    result = {name: short for name, _, short in rows(naming.abbreviate(df, existing=used))}
    assert set(result) == set(names) and len(set(result.values())) == len(names)
    assert not set(result.values()) & {"qr", "oitem", "oitem3", "oi"}
    assert {result["p.a_b1cde"], result["p.a_b_c_d_e"]} & {"abcde", "ab"}


def test_many_ties_give_linear_text(spark):
    df = spark.range(6000).select(F.concat(F.lit("s.o"), "id", F.lit("_item")).alias("name"))
    result = naming.abbreviate(df)
    total, short, distinct = result.agg(
        F.sum(F.length("abbreviation")), F.max(F.length("abbreviation")), F.count_distinct("abbreviation")
    ).first()
    assert distinct == 6000 and short <= 9 and total < 60_000


def test_long_names_are_abbreviated_whole(spark):
    df = spark.createDataFrame([("a_" * 700_000,)], "name string")
    assert len(df.select(text.abbreviation_base(F.col("name")).alias("b")).first()["b"]) == 699_999


def test_slug_match_of_many_lengths(spark):
    import random

    draw = random.Random(3)
    word = lambda n: "".join(draw.choice("abC") for _ in range(n))
    needles, names = [word(draw.randrange(9)) for _ in range(60)], [word(draw.randrange(40)) for _ in range(80)]
    found = naming.slug_match(
        spark.createDataFrame([(n,) for n in needles] + [(None,)], "slug string"),
        spark.createDataFrame([(n,) for n in names] + [(None,)], "folder string"),
        "slug",
        "folder",
    )
    for slug, folder, matches in found.filter("slug IS NOT NULL").collect():
        hits = {n for n in names if slug.lower() in n.lower()}
        assert (folder, matches) == (min(hits, default=None), len(hits))


def test_rank_of_a_hot_group(spark):
    df = spark.range(3000).select(F.lit("g").alias("g"), F.col("id").cast("string").alias("name"))
    ranked = naming.rank_in_group(df, ["g"], "name", "r")
    expected = df.selectExpr("name", "row_number() over (order by md5(name), name) as r")
    assert rows(ranked.select("name", "r")) == rows(expected)


def test_slug_match(spark):
    needles = spark.createDataFrame([("ab",), ("C",), ("zzz",), ("",)], "slug string")
    names = spark.createDataFrame([("xAB-1",), ("aab",), ("c",), ("aab",)], "folder string")
    found = {row["slug"]: (row["folder"], row["matches"]) for row in
             naming.slug_match(needles, names, "slug", "folder").collect()}
    assert found["ab"] == ("aab", 2)
    assert found["C"] == ("c", 1)
    assert found["zzz"] == (None, 0)


def test_schedule_classes(spark):
    def named(kind, times, days):
        column = schedule.schedule_class(F.lit(kind), F.col("t"), F.col("d"))
        arrays = spark.range(1).select(
            (F.lit(None).cast("array<int>") if times is None else F.sequence(F.lit(1), F.lit(times))).alias("t"),
            (F.lit(None).cast("array<int>") if days is None else F.sequence(F.lit(1), F.lit(days))).alias("d"),
        )
        return arrays.select(column).first()[0]

    assert named("DAILY", None, 7) == "daily"
    assert named("DAILY", None, 5) == "unchanged"
    assert [named("INTRADAY", n, None) for n in (24, 12, 6, 3, 5)] == ["hourly", "2h", "4h", "8h", "unchanged"]
    assert named("INTRADAY", None, None) == "not scheduled"
    assert named("WEEKLY", 24, 7) == "not scheduled"


def test_json_merge(spark):
    merged = one(
        spark, nested.json_merge(F.col("a"), F.col("b")),
        a='{"k": 69, "list": [1, {"x": null}], "s": "t"}', b='{"k": "new", "more": {"y": 1.5}, "list": null}',
    )
    assert merged.startswith('{"k":"new"')
    import json

    assert json.loads(merged).get("more") == {"y": 1.5}
    assert json.loads(merged)["s"] == "t"
    assert json.loads(merged).get("list") is None


def test_array_add_unique_keeps_duplicates(spark):
    items = F.array(F.lit("a"), F.lit("a"))
    assert one(spark, nested.array_add_unique(items, F.col("v")), v="a") == ["a", "a"]
    once = nested.array_add_unique(items, F.col("v"))
    assert one(spark, nested.array_add_unique(once, F.col("v")), v="b") == ["a", "a", "b"]


def test_nested_fields(spark):
    df = spark.sql("select named_struct('a', named_struct('b', 1, 'c', cast(null as int)), 'd', 2) s")
    dtype = df.schema["s"].dataType
    json = lambda column: df.select(F.to_json(column)).first()[0]
    assert json(nested.drop_field(F.col("s"), dtype, "a.b", "x.y")) == '{"a":{},"d":2}'
    assert json(nested.set_field(F.col("s"), dtype, "a.b", F.lit(5))) == '{"a":{"b":5},"d":2}'
    assert json(nested.set_field(F.col("s"), dtype, "a.c", F.lit(5))) == '{"a":{"b":1},"d":2}'
    assert json(nested.set_field(F.col("s"), dtype, "x.c", F.lit(5))) == '{"a":{"b":1},"d":2}'


def test_dates(spark):
    start, end = dates.date_window(F.lit("2024-03-05").cast("date"))
    assert one(spark, start) == datetime.date(2024, 2, 24)
    assert one(spark, end) == datetime.date(2024, 3, 15)
    inside = dates.in_interval(F.col("v").cast("timestamp_ntz"), *dates.day_bounds("2024-01-01", "2024-01-02"))
    assert one(spark, inside, v="2024-01-01 00:00:00") is True
    assert one(spark, inside, v="2024-01-02 00:00:00") is False


def test_region_cutoffs_follow_summer_time(spark):
    df = spark.createDataFrame([(1,), (3,)], "region_id int")
    found = dict(rows(dates.region_cutoff(df, "2024/07/01 00:00:00").select("region_id", "cutoff")))
    assert found[1] == datetime.datetime(2024, 7, 1, 7)
    assert found[3] == datetime.datetime(2024, 6, 30, 15)


def test_regions_without_a_zone_stay(spark):
    df = spark.createDataFrame([(1,), (6,), (None,)], "region_id int")
    found = dict(rows(dates.region_cutoff(df, "2024/07/01 00:00:00").select("region_id", "cutoff")))
    assert len(found) == 3 and found[6] is None and found[None] is None
    zones = spark.createDataFrame([(6, "UTC")], "region_id int, zone string")
    own = dict(rows(dates.region_cutoff(df, "2024/07/01 00:00:00", zones=zones).select("region_id", "cutoff")))
    assert own[6] == datetime.datetime(2024, 7, 1) and own[1] is None


def test_json_merge_of_absent_sides(spark):
    merged = nested.json_merge(F.col("a"), F.col("b"))
    assert one(spark, merged, a='{"k":1}', b=None) == '{"k":1}'
    assert one(spark, merged, a='{"k":1}', b="oops") == '{"k":1}'
    assert one(spark, merged, a=None, b='{"k":1}') == '{"k":1}'
    assert one(spark, merged, a="oops", b=None) == "oops"


def test_split_list(spark):
    assert one(spark, text.split_list(F.col("v"), "int"), v=" 1, 2 ,3") == [1, 2, 3]
    assert text.split_names(" a, ,b ") == ["a", "b"]


def test_pieces_of_long_names_are_hashes(spark):
    long = "x" * 50_000 + "needle" + "y" * 50_000
    names = spark.createDataFrame([(long,), ("a needle",), ("Needless",), (None,), ("",)], "n string")
    needles = spark.createDataFrame([("NEEDLE",), ("needless",), ("",), (None,), ("yx",)], "s string")
    found = naming.slug_match(needles, names, "s", "n")
    got = {r.s: (r.n, r.matches) for r in found.collect()}
    assert got == {"NEEDLE": ("Needless", 3), "needless": ("Needless", 1), "": ("", 4), None: (None, 0), "yx": (None, 0)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    generated = [line for line in plan.splitlines() if "Generate explode(array_distinct" in line]
    assert generated and "_part" not in generated[0].split(", false, ")[0].split("), [")[1]


def first_rule(value, rules):
    """What the rules make of a value, by trying each."""
    if value is None or naming.TOKEN_MARK in value:
        return value
    for _, find, new, whole in sorted(rules):
        if find in value:
            return new if whole else (value.replace(find, new) if find else value)
    return value


def mapped_by(spark, values, rules):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    table = spark.createDataFrame(rules, "priority int, find string, new string, whole boolean")
    return [r.mapped for r in naming.map_by_rules(df, "v", table).orderBy("id").collect()]


def test_rules_as_a_table_agree_with_the_expression(spark):
    rules = [(1, "abc", "X", False), (2, "ab", "$[Y]", True), (3, "é", "e", False), (4, "q.", "", False)]
    values = ["abc abc", "ab", "xab", "", None, "ééq.", "q.", "qx", "ABC", naming.TOKEN_MARK + "abc", "ab"]
    by_case = naming.map_first_match(F.col("v"), [Rule(find, new, whole) for _, find, new, whole in rules])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    expected = [r.m for r in df.select("id", by_case.alias("m")).orderBy("id").collect()]
    assert mapped_by(spark, values, rules) == expected == [first_rule(v, rules) for v in values]


def test_five_thousand_rules(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    rules = [(i, word(rng.randint(3, 12)), f"$[{i}]", i % 2 == 0) for i in range(5000)]
    rules += [(7000, "", "last", True), (1, rules[9][1], "again", True)]
    values = [word(rng.randint(0, 40)) for _ in range(500)] + ["zz", "zz", ""]
    assert mapped_by(spark, values, rules) == [first_rule(v, rules) for v in values]


def test_rules_that_are_no_rules(spark):
    assert mapped_by(spark, ["a", None], []) == ["a", None]
    assert mapped_by(spark, [], [(1, "a", "b", True)]) == []
    assert mapped_by(spark, ["a", "b"], [(1, None, "x", True), (2, "a", None, True)]) == [None, "b"]
