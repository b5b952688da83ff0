"""Names, descriptions and definition documents, made from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from twinledger.functions import nested, schedule, text
from twinledger.operators import naming
from twinledger.operators.naming import Rule
from twinledger.operators import versions
from twinledger.plans.standardise import (
    Form,
    Insert,
    Policy,
    abbreviation_edits,
    changes,
    load_profile_edits,
    script_job_edits,
    script_profile_edits,
    standardise,
    standardise_jobs,
    standardise_profiles,
    table_profile_edits,
    transform_profile_edits,
)
from twinledger.sources.definitions import patched_documents, read_definitions, read_documents, write_definitions
from twinledger.sources.named import write_named
from twinledger.sources.shared import new_path
from twinledger.suite.registry import query, table

# PROMO is replaced inside the value, ECON overwrites it and shadows ECONOMY.
TYPE_RULES = (
    Rule("ECON", "$[A]", whole=True),
    Rule("ECONOMY", "$[B]", whole=True),
    Rule("PROMO", "$[C]"),
)


def part(spark, sf_dir):
    return table(spark, sf_dir, "part")


@query(
    "map_first_match",
    """
    SELECT p_partkey, CASE WHEN contains(v, 'ECON') THEN '$[A]'
                           WHEN contains(v, 'PROMO') THEN replace(v, 'PROMO', '$[C]') ELSE v END AS mapped
    FROM (SELECT p_partkey, p_type || ' ' || p_brand AS v FROM part)
    """,
)
def map_first_match(spark, sf_dir):
    value = F.concat("p_type", F.lit(" "), "p_brand")
    return part(spark, sf_dir).select(
        "p_partkey", naming.map_first_match(value, TYPE_RULES).alias("mapped")
    )


@query(
    "map_by_rules",
    """
    WITH rules AS (
        SELECT substr(p_name, 1 + p_partkey % 3, 2 + p_partkey % 9) AS find, min(p_partkey) AS priority FROM part GROUP BY 1),
    texts AS (SELECT p_partkey, p_name || ' ' || p_brand AS v FROM part),
    best AS (SELECT v, min(priority) AS priority FROM (SELECT DISTINCT v FROM texts) JOIN rules ON contains(v, find) GROUP BY v)
    SELECT p_partkey, CASE WHEN priority IS NULL THEN t.v WHEN priority % 2 = 0 THEN '$[R' || priority || ']'
                           ELSE replace(t.v, find, '$[R' || priority || ']') END AS mapped
    FROM texts t LEFT JOIN best USING (v) LEFT JOIN rules USING (priority)
    """,
)
def map_by_rules(spark, sf_dir):
    """Rules made of the names' own pieces, about as many as there are different ones."""
    parts = part(spark, sf_dir)
    find = F.substring("p_name", 1 + F.col("p_partkey").cast("int") % 3, 2 + F.col("p_partkey").cast("int") % 9)
    rules = (
        parts.groupBy(find.alias("find"))
        .agg(F.min("p_partkey").alias("priority"))
        .withColumns({"new": F.format_string("$[R%s]", "priority"), "whole": F.col("priority") % 2 == 0})
    )
    texts = parts.select("p_partkey", F.concat("p_name", F.lit(" "), "p_brand").alias("v"))
    return naming.map_by_rules(texts, "v", rules).drop("v")


@query(
    "schedule_class",
    """
    SELECT user_id, CAST(n AS INTEGER) AS times,
           CASE n WHEN 24 THEN 'hourly' WHEN 12 THEN '2h' WHEN 6 THEN '4h' WHEN 3 THEN '8h' ELSE 'unchanged' END AS class,
           CASE n WHEN 24 THEN '$[ScheduledHourly]' WHEN 12 THEN '$[Scheduled2Hourly]'
                  WHEN 6 THEN '$[Scheduled4Hourly]' WHEN 3 THEN '$[Scheduled8Hourly]' END AS token
    FROM (SELECT user_id, count(DISTINCT floor(hour(ts) / power(2, user_id % 4))) AS n FROM events GROUP BY user_id)
    """,
)
def schedule_class(spark, sf_dir):
    """Each user's hours of activity, at most 24, as the times of a schedule."""
    slot = F.floor(F.hour("ts") / F.pow(F.lit(2), F.col("user_id") % 4))
    times = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set(slot).alias("time"))
    name = schedule.schedule_class(F.lit("INTRADAY"), F.col("time"), F.lit(None).cast("array<string>"))
    return times.select(
        "user_id", F.size("time").alias("times"), name.alias("class")
    ).withColumn("token", schedule.schedule_token(F.col("class")))


@query(
    "insert_token",
    """
    SELECT page_id, CASE WHEN contains(url, '$[') OR instr(url, '.') = 0 THEN url
                         ELSE substring(url, 1, instr(url, '.') - 1) || '$[Stage]' || substring(url, instr(url, '.')) END AS stage_url,
           CASE WHEN contains(url, '$[') OR instr(url, '#') = 0 THEN url
                ELSE substring(url, 1, instr(url, '#') - 1) || '$[FPStage]_' || substring(url, instr(url, '#')) END AS file_url
    FROM pages
    """,
)
def insert_token(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        text.insert_token(url, ".").alias("stage_url"),
        text.insert_token(url, "#", text.FILE_STAGE_TOKEN).alias("file_url"),
    )


@query(
    "rebuild_text",
    """
    SELECT page_id, split_part(html, '-', 1) || '- ' ||
           regexp_split_to_array(url, '[/.]')[-2] || '$[Stage]' AS description
    FROM pages
    """,
)
def rebuild_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        text.rebuild_text(F.col("html"), text.folder_of(F.col("url"))).alias("description"),
    )


@query(
    "abbreviate",
    """
    WITH names AS (SELECT DISTINCT replace(p_name, ' ', '_') || '.' || replace(p_type, ' ', '_') || '_' || p_partkey AS name FROM part),
    based AS (SELECT name, substring(array_to_string(list_transform(regexp_split_to_array(name, '[._]'), lambda x: substring(x, 1, 1)), ''), 2) AS base FROM names),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY md5(name), name) AS r FROM based),
    one AS (SELECT name, base, CASE WHEN r = 1 THEN base ELSE base || right(name, 3) END AS text FROM ranked),
    used AS (SELECT DISTINCT lower(substring(p_type, 1, 1)) || p_size AS text FROM part
             UNION SELECT base || right(name, 3) FROM based WHERE right(name, 1) = '7'),
    first_try AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY md5(name), name) AS k,
                         text IN (FROM used) AS old FROM one),
    given AS (SELECT name, base, text FROM first_try WHERE k = 1 AND NOT old),
    two AS (SELECT name, base, text || CASE WHEN old THEN k ELSE k - 1 END AS text FROM first_try WHERE k > 1 OR old),
    second_try AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY md5(name), name) AS k,
                          text IN (FROM used) OR text IN (SELECT text FROM given) AS old FROM two)
    SELECT name, base, text AS abbreviation FROM given
    UNION ALL
    SELECT name, base, CASE WHEN k = 1 AND NOT old THEN text ELSE text || '-' || md5(name) END FROM second_try
    """,
)
def abbreviate(spark, sf_dir):
    """Against texts in use, which some of the names would get."""
    name = F.concat(
        F.replace("p_name", F.lit(" "), F.lit("_")),
        F.lit("."),
        F.replace("p_type", F.lit(" "), F.lit("_")),
        F.lit("_"),
        F.col("p_partkey"),
    )
    names = part(spark, sf_dir).select(name.alias("name"))
    used = part(spark, sf_dir).select(
        F.concat(F.lower(F.substring("p_type", 1, 1)), F.col("p_size")).alias("abbreviation")
    )
    ending = names.filter(F.right("name", F.lit(1)) == "7").select(
        F.concat(text.abbreviation_base(F.col("name")), F.right("name", F.lit(3))).alias("abbreviation")
    )
    return naming.abbreviate(names, existing=used.unionByName(ending))


@query(
    "slug",
    """
    SELECT page_id,
           regexp_replace(replace(regexp_replace(rtrim(regexp_replace(replace(url, ' ', '-'), '[*:]', '', 'g'), '-'),
                          '[().,;{}\\[\\]]', '', 'g'), '/', '_'), '[*:]', '', 'g') AS folder,
           regexp_replace(replace(regexp_replace(regexp_replace(replace(lower(html), ' ', '-'), '[*:]', '', 'g'),
                          '[().,\\[\\]]', '', 'g'), '/', '_'), '[*:]', '', 'g') AS page_folder
    FROM pages
    """,
)
def slug(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        text.slug(F.col("url")).alias("folder"),
        text.slug(F.col("html"), lower=True, removed="*:().[],", trim_dashes=False).alias(
            "page_folder"
        ),
    )


@query(
    "slug_match",
    """
    WITH folders AS (SELECT DISTINCT replace(p_type || ' ' || p_name || ' ' || p_partkey, ' ', '-') AS folder FROM part),
    slugs AS (SELECT DISTINCT replace(p_name, ' ', '-') AS slug FROM part)
    SELECT slug, min(folder) AS folder, count(folder) AS matches
    FROM slugs LEFT JOIN folders ON contains(lower(folder), lower(slug)) GROUP BY slug
    """,
)
def slug_match(spark, sf_dir):
    parts = part(spark, sf_dir)
    folder = F.concat("p_type", F.lit(" "), "p_name", F.lit(" "), F.col("p_partkey"))
    return naming.slug_match(
        parts.select(text.slug(F.col("p_name")).alias("slug")),
        parts.select(text.slug(folder).alias("folder")),
        "slug",
        "folder",
    )


@query(
    "fill_default",
    """
    SELECT p_partkey, CASE WHEN p_size % 3 = 0 OR p_size % 3 = 1 THEN 'UPSERT' ELSE p_type END AS merge_option
    FROM part
    """,
)
def fill_default(spark, sf_dir):
    option = F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 2, F.col("p_type"))
    return part(spark, sf_dir).select(
        "p_partkey", text.fill_default(option, "UPSERT").alias("merge_option")
    )


PREFIXES = (("LOAD_A", "Table-Load-"), ("LOAD", "Load-"), ("TRANSFORM", "Transform-"))


@query(
    "prefix_by_type",
    """
    SELECT p_partkey, CASE WHEN p_brand = 'Brand#5' THEN p_brand || ' ' || p_name
        WHEN p_size % 4 = 0 THEN 'Table-Load-' || replace(p_brand || ' ' || p_name, ' ', '-')
        WHEN p_size % 4 = 1 THEN 'Load-' || replace(p_brand || ' ' || p_name, ' ', '-')
        WHEN p_size % 4 = 2 THEN 'Transform-' || replace(p_brand || ' ' || p_name, ' ', '-')
        ELSE p_brand || ' ' || p_name END AS description
    FROM part
    """,
)
def prefix_by_type(spark, sf_dir):
    kind = (
        F.when(F.col("p_size") % 4 == 0, "LOAD_A")
        .when(F.col("p_size") % 4 == 1, "LOAD")
        .when(F.col("p_size") % 4 == 2, "TRANSFORM")
        .otherwise("OTHER")
    )
    value = F.concat("p_brand", F.lit(" "), "p_name")
    return part(spark, sf_dir).select(
        "p_partkey",
        text.prefix_by_type(kind, value, PREFIXES, onboarded="Brand#5").alias("description"),
    )


@query(
    "append_suffix",
    """
    SELECT p_partkey, p_name || '$[Stage]' AS name,
           CASE WHEN contains(p_type, 'PROMO') THEN p_type ELSE p_type || 'PROMO' END AS kind
    FROM part
    """,
)
def append_suffix(spark, sf_dir):
    once = text.append_suffix(F.col("p_name"))
    return part(spark, sf_dir).select(
        "p_partkey",
        text.append_suffix(once).alias("name"),
        text.append_suffix(F.col("p_type"), "PROMO").alias("kind"),
    )


@query(
    "json_merge",
    """
    SELECT event_id, '{"k":' || CASE WHEN event_type = 'error' THEN CAST(user_id AS VARCHAR)
           ELSE json_extract_string(props, '$.k') END || ',"kind":"' || event_type || '"}' AS merged
    FROM events
    """,
)
def json_merge(spark, sf_dir):
    override = F.when(
        F.col("event_type") == "error", F.concat(F.lit(',"k":'), F.col("user_id"))
    ).otherwise("")
    update = F.concat(F.lit('{"kind":"'), "event_type", F.lit('"'), override, F.lit("}"))
    return table(spark, sf_dir, "events").select(
        "event_id", nested.json_merge(F.col("props"), update).alias("merged")
    )


@query(
    "array_add_unique",
    """
    SELECT p_partkey, array_to_string(CASE WHEN p_type IN ('SMALL', 'PROMO') THEN ['SMALL', 'PROMO', 'SMALL']
                      ELSE ['SMALL', 'PROMO', 'SMALL', p_type] END, ',') AS items
    FROM part
    """,
)
def array_add_unique(spark, sf_dir):
    items = F.array(F.lit("SMALL"), F.lit("PROMO"), F.lit("SMALL"))
    return part(spark, sf_dir).select(
        "p_partkey",
        F.array_join(nested.array_add_unique(items, F.col("p_type")), ",").alias("items"),
    )


def order_documents(spark, sf_dir):
    """Orders as nested documents; the owner is absent from some."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.struct(
            F.struct(
                F.col("o_orderstatus").alias("group"),
                F.when(F.col("o_orderkey") % 3 != 0, F.lit("someone")).alias("owner"),
                F.struct(F.col("o_orderpriority").alias("type")).alias("schedule"),
            ).alias("definition"),
            F.col("o_custkey").alias("id"),
        ).alias("doc"),
    )


@query(
    "drop_field",
    """
    SELECT o_orderkey, '{"definition":{"group":"' || o_orderstatus || '"' ||
           CASE WHEN o_orderkey % 3 <> 0 THEN ',"owner":"someone"' ELSE '' END || '},"id":' || o_custkey || '}' AS doc
    FROM orders
    """,
)
def drop_field(spark, sf_dir):
    docs = order_documents(spark, sf_dir)
    dropped = nested.drop_field(F.col("doc"), docs.schema["doc"].dataType, "definition.schedule")
    return docs.select("o_orderkey", F.to_json(dropped).alias("doc"))


@query(
    "set_field",
    """
    SELECT o_orderkey, '{"definition":{"group":"' || o_orderstatus || '"' ||
           CASE WHEN o_orderkey % 3 <> 0 THEN ',"owner":"$[Owner]"' ELSE '' END ||
           ',"schedule":{"type":"' || o_orderpriority || '"}},"id":' || o_custkey || '}' AS doc
    FROM orders
    """,
)
def set_field(spark, sf_dir):
    docs = order_documents(spark, sf_dir)
    dtype = docs.schema["doc"].dataType
    changed = nested.set_field(F.col("doc"), dtype, "definition.owner", F.lit("$[Owner]"))
    return docs.select("o_orderkey", F.to_json(changed).alias("doc"))


@query(
    "line_key_value",
    """
    SELECT o_orderkey, 'copy_' || o_custkey AS table_name, CAST(o_orderkey AS VARCHAR) AS version
    FROM orders
    """,
)
def line_key_value(spark, sf_dir):
    log = F.concat(
        F.lit("starting\nTableName: first\nTableName: copy_"),
        F.col("o_custkey"),
        F.lit(" :done\n VersionNumber: indented\nVersionNumber:  "),
        F.col("o_orderkey"),
        F.lit(" \nended"),
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.line_value(log, "TableName").alias("table_name"),
        text.line_value(log, "VersionNumber").alias("version"),
    )


@query(
    "split_list",
    """
    SELECT o_orderkey, 2 AS n, o_orderkey AS first_id, o_custkey AS second_id,
           o_orderstatus || '|' || o_orderpriority AS names
    FROM orders
    """,
)
def split_list(spark, sf_dir):
    ids = text.split_list(F.concat(F.col("o_orderkey"), F.lit(" , "), F.col("o_custkey")), "bigint")
    names = text.split_list(F.concat("o_orderstatus", F.lit(",  "), "o_orderpriority", F.lit(" ")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.size(ids).alias("n"),
        ids[0].alias("first_id"),
        ids[1].alias("second_id"),
        F.array_join(names, "|").alias("names"),
    )


def definitions(spark, sf_dir):
    """Parts as definition documents: even ones jobs, odd ones profiles.

    A job's schedule runs daily, at 24, 12 or 5 times a day, weekly, or is
    absent; every third job has an owner.
    """
    parts = part(spark, sf_dir)
    job = F.col("p_partkey") % 2 == 0
    slot = F.col("p_partkey") % 12
    times = F.when(slot == 2, 24).when(slot == 4, 12).when(slot == 6, 5)
    kind = F.when(slot == 0, "DAILY").when(times.isNotNull(), "INTRADAY").when(slot == 8, "WEEKLY")
    plan = F.struct(
        kind.alias("type"),
        F.when(
            times.isNotNull(),
            F.transform(F.sequence(F.lit(1), times), lambda n: n.cast("string")),
        ).alias("time"),
        F.when(
            slot == 0, F.transform(F.sequence(F.lit(1), F.lit(7)), lambda n: n.cast("string"))
        ).alias("dayPreferences"),
    )
    definition = F.struct(
        F.when(job, F.concat(F.lit("GROUP-"), "p_type")).alias("group"),
        F.when(job, F.concat(F.lit("user_"), F.col("p_size"))).alias("dbUser"),
        F.when(job & (F.col("p_partkey") % 3 == 0), F.lit("someone")).alias("owner"),
        F.when(job & kind.isNotNull(), plan).alias("schedule"),
        F.when(~job, F.concat("p_name", F.lit(" - old text"))).alias("description"),
        F.when(
            ~job,
            F.struct(F.when(F.col("p_size") % 2 == 0, "").otherwise("APPEND").alias("mergeOption")),
        ).alias("loadOption"),
    )
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    inputs = F.array(
        F.struct(F.lit("TABLE").alias("type"), F.col("p_brand").alias("value")),
        F.struct(F.lit("FILE").alias("type"), F.concat(name, F.lit(".txt")).alias("value")),
    )
    outputs = F.array(F.struct(F.concat("p_type", F.lit("."), name).alias("value")))
    return parts.select(
        F.concat(
            F.lit("/corpus/"),
            F.when(job, "jobs/").otherwise("profiles/"),
            F.col("p_partkey"),
            F.lit(".json"),
        ).alias("path"),
        F.when(job, "job").otherwise("profile").alias("kind"),
        F.struct(
            F.col("p_partkey").alias("id"),
            definition.alias("definition"),
            F.when(~job, inputs).alias("inputs"),
            F.when(~job, outputs).alias("outputs"),
        ).alias("doc"),
    )


@query(
    "definition_scan",
    """
    SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'job' ELSE 'profile' END AS kind,
           CASE WHEN p_partkey % 2 = 0 THEN 'GROUP-' || p_type END AS job_group,
           CASE WHEN p_partkey % 2 <> 0 THEN p_name || ' - old text' END AS description
    FROM part
    """,
)
def definition_scan(spark, sf_dir):
    path = new_path(spark, "definitions")
    write_definitions(definitions(spark, sf_dir), path)
    schema = definitions(spark, sf_dir).schema["doc"].dataType
    docs = read_definitions(spark, path, schema, one_per_file=False)
    return docs.select(
        "doc.id",
        "kind",
        F.col("doc.definition.group").alias("job_group"),
        F.col("doc.definition.description").alias("description"),
    )


POLICY = Policy(
    owner_token="$[Keeper]",
    provider_token="$[Source]",
    mapped=(
        ("definition.group", (Rule("ECON", "$[TeamA]", whole=True), Rule("PROMO", "$[TeamB]", whole=True))),
        ("definition.dbUser", (Rule("user_1", "$[LoadUser]", whole=True),)),
        ("definition.database", (Rule("db", "$[Db]"),)),
    ),
    output_rules=(Rule("ECONOMY", "$[SourceA]"), Rule("PROMO", "$[SourceB]")),
    suffix_types=("TABLE",),
    insert_types=("FILE",),
)

JOBS_SQL = """
SELECT p_partkey AS id,
       CASE WHEN contains(p_type, 'ECON') THEN '$[TeamA]' WHEN contains(p_type, 'PROMO') THEN '$[TeamB]'
            ELSE 'GROUP-' || p_type END AS job_group,
       CASE WHEN contains('user_' || p_size, 'user_1') THEN '$[LoadUser]' ELSE 'user_' || p_size END AS db_user,
       CASE WHEN p_partkey % 3 = 0 THEN 'someone' ELSE '$[Keeper]' END AS owner,
       CASE p_partkey % 12 WHEN 0 THEN '$[ScheduledDaily]' WHEN 2 THEN '$[ScheduledHourly]'
            WHEN 4 THEN '$[Scheduled2Hourly]' WHEN 8 THEN '$[NotScheduled]' END AS schedule,
       CASE WHEN p_partkey % 12 = 6 THEN 'INTRADAY' END AS old_schedule
FROM part WHERE p_partkey % 2 = 0
"""


@query("standardise_jobs", JOBS_SQL)
def jobs(spark, sf_dir):
    docs = definitions(spark, sf_dir).filter(F.col("kind") == "job")
    return standardise_jobs(docs, POLICY).select(
        "doc.id",
        F.col("doc.definition.group").alias("job_group"),
        F.col("doc.definition.dbUser").alias("db_user"),
        "doc.definition.owner",
        "doc.schedule",
        F.col("doc.definition.schedule.type").alias("old_schedule"),
    )


def documents_with_more(spark, sf_dir):
    """The jobs as text, with fields that their schema lacks: before the others, inside, numbers of several forms."""
    docs = definitions(spark, sf_dir).filter(F.col("kind") == "job")
    whole = F.to_json("doc", {"ignoreNullFields": "true"})
    inside = F.replace(whole, F.lit('"definition":{'), F.lit('"definition":{"ratio":1.50,"steps":[1e3,{"k":"1"}],'))
    first = F.concat(F.lit('{"zone":{"b":2.0,"a":null},"size":'), "doc.id", F.lit(".10,"), F.substr(inside, F.lit(2)))
    return docs.select("path", "kind", first.alias("text"), "doc")


# The documents as they should read: a schedule that becomes a token is appended and its old field goes.
ROUND_TRIP_SQL = """
    SELECT id, '{"zone":{"b":2.0,"a":null},"size":' || id || '.10,"id":' || id ||
           ',"definition":{"ratio":1.50,"steps":[1e3,{"k":"1"}],"group":"' || job_group || '","dbUser":"' || db_user || '"' ||
           CASE WHEN id % 3 = 0 THEN ',"owner":"someone"' ELSE '' END ||
           CASE WHEN id % 12 = 6 THEN ',"schedule":{"type":"INTRADAY","time":["1","2","3","4","5"]}' ELSE '' END ||
           CASE WHEN id % 3 <> 0 THEN ',"owner":"$[Keeper]"' ELSE '' END || '}' ||
           coalesce(',"schedule":"' || schedule || '"', '') || '}' AS text
    FROM ({jobs})
"""


@query("definition_round_trip", ROUND_TRIP_SQL.replace("{jobs}", JOBS_SQL))
def definition_round_trip(spark, sf_dir):
    """Written, read, standardised and written again as text, and read: fields that no schema names are still there."""
    folder, rewritten = new_path(spark, "documents"), new_path(spark, "documents")
    given = documents_with_more(spark, sf_dir)
    given.select("text").write.text(folder)
    texts = spark.read.text(folder).select(
        F.lit("job").alias("kind"),
        F.col("value").alias("text"),
        F.from_json("value", given.schema["doc"].dataType).alias("doc"),
    )
    patched_documents(standardise_jobs(texts, POLICY)).select("text").write.text(rewritten)
    return spark.read.text(rewritten).select(
        F.get_json_object("value", "$.id").cast("bigint").alias("id"), F.col("value").alias("text")
    )


@query(
    "named_files",
    """
    SELECT 'region/' || s_nationkey || '/supplier-' || s_suppkey || '.json' AS path,
           CAST(s_suppkey AS BIGINT) AS id, s_name AS name, '{' || chr(10) || '  "id": ' || s_suppkey || ',' || chr(10) ||
           '  "name": "' || s_name || '",' || chr(10) || '  "limits": [' || chr(10) || '    1.50,' || chr(10) ||
           '    {}' || chr(10) || '  ]' || chr(10) || '}' AS text
    FROM supplier
    """,
)
def named_files(spark, sf_dir):
    """Suppliers as indented files of their own names, read back by path."""
    name = F.concat(F.lit("region/"), "s_nationkey", F.lit("/supplier-"), "s_suppkey", F.lit(".json"))
    text_of = F.concat(F.lit('{"id":'), "s_suppkey", F.lit(',"name":"'), "s_name", F.lit('","limits":[1.50,{}]}'))
    folder = new_path(spark, "named")
    suppliers = table(spark, sf_dir, "supplier").select(name.alias("path"), text_of.alias("text"))
    write_named(suppliers, folder, indent=2)
    docs = read_documents(spark, folder, T.StructType().add("id", "long").add("name", "string"))
    return docs.select(
        F.regexp_extract("path", "region/.*", 0).alias("path"), "doc.id", "doc.name", "text"
    )


PROFILES_SQL = """
SELECT p_partkey AS id, p_name || ' - ' || p_partkey || '$[Stage]' AS description,
       CASE WHEN p_size % 2 = 0 THEN 'UPSERT' ELSE 'APPEND' END AS merge_option,
       p_brand || '$[Stage]' AS table_input, replace(p_name, ' ', '_') || '$[Stage].txt' AS file_input,
       CASE p_type WHEN 'ECONOMY' THEN '$[SourceA]' WHEN 'PROMO' THEN '$[SourceB]'
                   ELSE '$[Source]' END || '.' || replace(p_name, ' ', '_') || '$[Stage]' AS output
FROM part WHERE p_partkey % 2 <> 0
"""


@query("standardise_profiles", PROFILES_SQL)
def profiles(spark, sf_dir):
    """Standardised, as JSON text and back."""
    docs = definitions(spark, sf_dir).filter(F.col("kind") == "profile")
    done = standardise_profiles(docs, POLICY)
    back = F.from_json(F.to_json("doc"), done.schema["doc"].dataType)
    return done.select(back.alias("doc")).select(
        "doc.id",
        F.regexp_replace("doc.definition.description", "  +", " ").alias("description"),
        F.col("doc.definition.loadOption.mergeOption").alias("merge_option"),
        F.col("doc.inputs")[0]["value"].alias("table_input"),
        F.col("doc.inputs")[1]["value"].alias("file_input"),
        F.col("doc.outputs")[0]["value"].alias("output"),
    )


# Every fourth part is a profile of each type; those of Brand#1 lie in a folder that names files.
TYPES = ("table", "load", "transform", "script")
SPECIAL = "/special/"

TYPED_SQL = f"""
SELECT p_partkey AS id, {list(TYPES)}[1 + p_partkey % 4] AS type, p_brand = 'Brand#1' AS special,
       replace(p_name, ' ', '_') AS name, p_type, p_brand, p_name, p_size
FROM part
"""


def typed_definitions(spark, sf_dir):
    """Profiles of four types in one corpus, and jobs of the last."""
    parts = part(spark, sf_dir)
    kind = F.element_at(F.array(*map(F.lit, TYPES)), (F.col("p_partkey") % 4 + 1).cast("int"))
    script = F.col("type") == "script"
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    value = F.concat(F.col("p_type"), F.lit("."), name, F.lit("{x}"))
    output = F.struct(
        F.when(~script, value).alias("value"),
        F.when(script, F.concat("p_type", F.lit(".x"))).alias("source"),
        F.when(script, name).alias("target"),
        F.when(script, F.col("p_size").cast("int")).alias("release"),
    )
    inputs = F.array(
        F.struct(F.lit("TABLE").alias("type"), F.col("p_brand").alias("value")),
        F.struct(F.lit("FILE").alias("type"), F.concat(name, F.lit("{d}.txt")).alias("value")),
    )
    folder = F.when(F.col("p_brand") == "Brand#1", "special/").otherwise("plain/")
    return parts.withColumn("type", kind).select(
        F.concat(F.lit("/corpus/"), folder, F.col("p_partkey"), F.lit(".json")).alias("path"),
        "type",
        F.struct(
            F.col("p_partkey").alias("id"),
            F.struct(
                F.concat("p_name", F.lit(" - old text")).alias("description"),
                F.when(script, F.concat("p_name", F.lit(" run"))).alias("title"),
                F.when(script & (F.col("p_size") % 2 == 0), "own").alias("account"),
                F.struct(
                    F.when(F.col("type") == "table", "DAY").alias("scheme"),
                    F.when(F.col("type") == "table", F.col("p_size").cast("int")).alias("release"),
                ).alias("data"),
                F.struct(
                    F.struct(
                        F.when(script, F.col("p_size").cast("int")).alias("size"),
                        F.when(script & (F.col("p_size") % 3 == 0), "big").alias("pool"),
                    ).alias("variables")
                ).alias("parameters"),
            ).alias("definition"),
            F.when(~script, inputs).alias("inputs"),
            F.array(output).alias("outputs"),
        ).alias("doc"),
    )


def typed_policy():
    special = F.col("path").contains(SPECIAL)
    return Policy(
        owner_token="$[Keeper]",
        provider_token="$[Source]",
        output_rules=(
            Rule("ECONOMY", "$[Special]", where=special),
            Rule("ECONOMY", "$[SourceA]"),
            Rule("PROMO", "$[SourceB]"),
        ),
        suffix_types=("TABLE",),
        insert_types=("FILE",),
        inserts=(Insert("{", "$[FileStage]_", special), Insert(".")),
    )


def typed_forms():
    """A form for each type; jobs and profiles of scripts are told apart by their fields."""
    policy = typed_policy()
    kind = F.col("type")
    variables = "definition.parameters.variables."
    script = [
        *script_profile_edits(
            policy,
            provider="outputs[].source",
            name="outputs[].target",
            version="outputs[].release",
            version_token="$[OutputRelease]",
            account="definition.account",
            account_token="$[Account]",
            title="definition.title",
        ),
        *script_job_edits({variables + "size": "$[Size]", variables + "pool": "$[Pool]"}),
    ]
    return [
        Form(kind == "table", table_profile_edits(policy)),
        Form(kind == "load", load_profile_edits(policy)),
        Form(kind == "transform", transform_profile_edits(policy)),
        Form(kind == "script", script),
    ]


MAPPED_SQL = """
CASE WHEN p_type = 'ECONOMY' AND special THEN '$[Special]' WHEN p_type = 'ECONOMY' THEN '$[SourceA]'
     WHEN p_type = 'PROMO' THEN '$[SourceB]' ELSE '$[Source]' END || '.'"""
FILE_SQL = "CASE WHEN special THEN name || '$[FileStage]_{d}.txt' ELSE name || '{d}$[Stage].txt' END"


def typed_profiles(spark, sf_dir, kind):
    done = standardise(typed_definitions(spark, sf_dir), typed_forms()).filter(F.col("type") == kind)
    return done.select(
        "doc.id",
        F.regexp_replace("doc.definition.description", "  +", " ").alias("description"),
        F.col("doc.inputs")[0]["value"].alias("table_input"),
        F.col("doc.inputs")[1]["value"].alias("file_input"),
        F.col("doc.outputs")[0]["value"].alias("output"),
    )


@query(
    "standardise_table",
    f"""
    SELECT id, p_name || ' - ' || id || '$[Stage]' AS description, p_brand || '$[Stage]' AS table_input,
           {FILE_SQL} AS file_input, {MAPPED_SQL} || name || '{{x}}$[Stage]' AS output
    FROM ({TYPED_SQL}) WHERE type = 'table'
    """,
)
def table_profiles(spark, sf_dir):
    return typed_profiles(spark, sf_dir, "table")


@query(
    "standardise_load",
    f"""
    SELECT id, p_name || ' - ' || id || '$[Stage]' AS description, p_brand || '$[Stage]' AS table_input,
           {FILE_SQL} AS file_input, {MAPPED_SQL} || name || '{{x}}' AS output
    FROM ({TYPED_SQL}) WHERE type = 'load'
    """,
)
def load_profiles(spark, sf_dir):
    return typed_profiles(spark, sf_dir, "load")


@query(
    "standardise_transform",
    f"""
    SELECT id, p_name || ' - ' || id || '$[Stage]' AS description, p_brand AS table_input,
           name || '{{d}}.txt' AS file_input,
           CASE WHEN special THEN p_type || '.' || name || '$[FileStage]_{{x}}'
                ELSE p_type || '$[Stage].' || name || '{{x}}' END AS output
    FROM ({TYPED_SQL}) WHERE type = 'transform'
    """,
)
def transform_profiles(spark, sf_dir):
    return typed_profiles(spark, sf_dir, "transform")


@query(
    "standardise_script",
    f"""
    SELECT id, {MAPPED_SQL} || 'x' AS source, name || '$[Stage]' AS target, '$[OutputRelease]' AS release,
           p_name || ' run$[Stage]' AS title, CASE WHEN p_size % 2 = 0 THEN '$[Account]' END AS account,
           '$[Size]' AS size, CASE WHEN p_size % 3 = 0 THEN '$[Pool]' END AS pool
    FROM ({TYPED_SQL}) WHERE type = 'script'
    """,
)
def script_profiles(spark, sf_dir):
    done = standardise(typed_definitions(spark, sf_dir), typed_forms()).filter(F.col("type") == "script")
    output, variables = F.col("doc.outputs")[0], F.col("doc.definition.parameters.variables")
    return done.select(
        "doc.id",
        output["source"].alias("source"),
        output["target"].alias("target"),
        output["release"].alias("release"),
        F.col("doc.definition.title").alias("title"),
        F.col("doc.definition.account").alias("account"),
        variables["size"].alias("size"),
        variables["pool"].alias("pool"),
    )


@query(
    "profile_config",
    f"""
    WITH t AS ({TYPED_SQL}), names AS (SELECT id, p_type || '.' || name || '{{x}}' AS name FROM t WHERE type = 'table'),
    one AS (SELECT DISTINCT name, substring(array_to_string(list_transform(regexp_split_to_array(name, '[._]'),
                   lambda x: substring(x, 1, 1)), ''), 2) AS base FROM names),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY md5(name), name) AS r FROM one),
    text AS (SELECT name, CASE WHEN r = 1 THEN base ELSE base || right(name, 3) END AS text FROM ranked),
    tied AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY md5(name), name) AS k FROM text),
    short AS (SELECT name, CASE WHEN k = 1 THEN text ELSE text || (k - 1) END AS short FROM tied)
    SELECT id, '$[' || short || 'Scheme]' AS scheme, '$[' || short || 'Release]' AS release,
           stage, short || ending AS config_key, '"' || value || '"' AS config_value
    FROM (SELECT id, short, stage, ending,
                 CASE ending WHEN 'PartitionScheme' THEN 'S' || (id % 3) ELSE CAST(id + (stage = 'prod')::INT AS VARCHAR) END AS value
          FROM names JOIN short USING (name), (VALUES ('beta'), ('prod')) AS s(stage),
               (VALUES ('PartitionScheme'), ('VersionNumber')) AS e(ending))
    """,
)
def profile_config(spark, sf_dir):
    """Abbreviations of outputs as placeholders in the documents and as keys of the configuration."""
    docs = typed_definitions(spark, sf_dir).filter(F.col("type") == "table")
    docs = docs.withColumn("name", F.col("doc.outputs")[0]["value"])
    short = naming.abbreviate(docs.select("name")).drop("base")
    paths = {"definition.data.scheme": "Scheme", "definition.data.release": "Release"}
    named = standardise(docs.join(short, "name"), [Form(F.lit(True), abbreviation_edits(paths))])
    number = F.col("doc.id")
    lookup = named.select(
        number.alias("id"),
        F.col("doc.definition.data.scheme").alias("scheme"),
        F.col("doc.definition.data.release").alias("release"),
        "abbreviation",
        F.concat(F.lit("S"), number % 3).alias("beta_scheme"),
        number.alias("beta_version"),
        F.concat(F.lit("S"), number % 3).alias("prod_scheme"),
        (number + 1).alias("prod_version"),
    )
    return versions.config_long(lookup).drop("abbreviation")


@query(
    "definition_changes",
    f"""
    WITH j AS ({JOBS_SQL})
    SELECT '/corpus/jobs/' || id || '.json' AS path, field, old, new FROM (
        SELECT id, 'definition.group' AS field, 'GROUP-' || p_type AS old, job_group AS new FROM j JOIN part ON id = p_partkey
        UNION ALL
        SELECT id, 'definition.dbUser', 'user_' || p_size, db_user FROM j JOIN part ON id = p_partkey
        UNION ALL
        SELECT id, 'definition.owner', CASE WHEN p_partkey % 3 = 0 THEN 'someone' END, owner FROM j JOIN part ON id = p_partkey
        UNION ALL SELECT id, 'schedule', NULL, schedule FROM j)
    WHERE old IS DISTINCT FROM new
    """,
)
def definition_changes(spark, sf_dir):
    docs = definitions(spark, sf_dir).filter(F.col("kind") == "job")
    fields = ("definition.group", "definition.dbUser", "definition.owner", "schedule")
    return changes(standardise_jobs(docs, POLICY), fields)


@query(
    "profile_changes",
    f"""
    SELECT path, field, old, new FROM (
        SELECT '/corpus/' || CASE WHEN special THEN 'special/' ELSE 'plain/' END || id || '.json' AS path, 'definition.title' AS field,
               p_name || ' run' AS old, p_name || ' run$[Stage]' AS new FROM ({TYPED_SQL}) WHERE type = 'script'
        UNION ALL
        SELECT '/corpus/' || CASE WHEN special THEN 'special/' ELSE 'plain/' END || id || '.json', 'definition.account',
               'own', '$[Account]' FROM ({TYPED_SQL}) WHERE type = 'script' AND p_size % 2 = 0)
    """,
)
def profile_changes(spark, sf_dir):
    """Of all types in one pass, applied a second time to what the first gave, which adds nothing."""
    once = standardise(typed_definitions(spark, sf_dir), typed_forms())
    first = once.select("path", "type", "before", "doc")
    twice = standardise(first.select("path", "type", "doc"), typed_forms())
    fields = ("definition.title", "definition.account")
    again = changes(twice, (*fields, "outputs", "inputs", "definition.description"))
    return changes(first, fields).unionByName(again)
