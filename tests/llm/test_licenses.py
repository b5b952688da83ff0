import re

from pyspark.sql import functions as F

from twinledger.llm import licenses

SCHEMA = "doc_id long, text string"
UPPER = {c: c + 32 for c in range(65, 91)}


def naive_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels)


TEXTS = [
    None, "", "...", "MIT License mit license MIT-LICENSE", "GNU General\nPublic   License and CC-BY-4.0, cc by",
    "the Apache License, Version 2.0 (the License)", "ÉMIT license", "mit licenseé", "cc cc by by", "K mit license",
    "word " * 50_000 + "mit license", "x" * 300_000, "apache license " * 400,
]


def detect(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).withColumn("rule", F.lit(1)).withColumn("spaced", F.lit("s"))
    return {r.doc_id: r for r in licenses.detect(df).collect()}


def test_base_phrases(spark):
    got = detect(spark, TEXTS)
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == naive_base(text)
        assert set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1


def test_base_phrases_of_the_documents(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = licenses.detect(docs).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == {
        i: naive_base(t) for i, t in texts.items()
    }
    assert sum(r.n_base for r in got) > 5


def naive_rules(text):
    """All rules on all words, every pair of detections compared."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(UPPER))
    spaced = "".join(f" {w} " for w in words)
    found = []
    for number, label, keyword, priority, confidence, expression in licenses.rules():
        if f" {keyword} " in spaced:
            for m in re.finditer(expression, spaced):
                start = spaced[: m.start()].count(" ") // 2
                found.append((start, start + m[0].count(" ") // 2, priority, -number, label, confidence))
    kept = [
        d
        for d in found
        if not any(
            o[0] <= d[0] and o[1] >= d[1] and o[2] >= d[2] and (o[1] - o[0] > d[1] - d[0] or o[2] > d[2] or o[3] > d[3])
            for o in found
        )
    ]
    return {d[4] for d in kept}, max([d[5] for d in kept], default=0.0)


RULED = [
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "SPDX-License-Identifier: MIT",
    "SPDX-License-Identifier: GPL-3.0-or-later", "Released under CC BY-NC-SA 4.0.", "see the GNU Lesser General Public License v2.1",
    "GNU General Public License, version 2 and GNU General Public License v3", "This is free of any mention", "BSD 3-Clause License",
    "distributed under the terms of the Mozilla Public License 2.0; mit license", "in the public domain. All rights reserved.",
    "licensed under CC0 1.0 Universal", "the unlicense",
]


def test_rules_and_suppression(spark):
    got = detect(spark, RULED)
    for i, text in enumerate(RULED):
        labels, score = naive_rules(text)
        assert set(got[i].labels) == labels | set(naive_base(text)[4])
        assert got[i].score == max(score, 0.7 if naive_base(text)[4] else 0.0)
    assert got[0].labels == ["apache", "apache-2.0"] and got[1].labels == ["mit"] and got[6].score == 0
    assert "gpl" not in got[4].labels and got[4].labels == ["lgpl-2.1"]


def test_the_table_of_rules():
    table = licenses.rules()
    assert len(table) >= 200 and len({r[5] for r in table}) >= 200
    for _, _, keyword, _, _, expression in table:
        re.compile(expression)
    hint = re.compile(licenses.HINTS)
    for _, _, name in licenses.FAMILIES:
        assert hint.search(name.replace("[cs]", "c"))


def test_repeats_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(1, "mit license"), (1, "mit license"), (None, "cc by 4.0"), (1, "none")], SCHEMA)
    rows = licenses.detect(df).collect()
    assert sorted((str(r.doc_id), r.labels) for r in rows) == [("1", []), ("1", ["mit"]), ("1", ["mit"]), ("None", ["cc-by", "cc-by-4.0"])]
    assert licenses.detect(df.filter("doc_id > 3")).collect() == []


def test_nothing_leaves_the_engine(spark, middle):
    plan = licenses.detect(spark.read.parquet(f"{middle}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def names(parsed):
    """All texts of a finite expression; the first of a range of characters stands for it."""
    found = [""]
    for kind, value in parsed:
        match str(kind):
            case "LITERAL":
                more = [chr(value)]
            case "IN":
                more = [chr(v if str(k) == "LITERAL" else v[0]) for k, v in value]
            case "BRANCH":
                more = [t for branch in value[1] for t in names(branch)]
            case "SUBPATTERN":
                more = names(value[3])
            case "MAX_REPEAT":
                assert value[:2] == (0, 1)
                more = ["", *names(value[2])]
        found = [a + b for a in found for b in more]
    return found


def test_every_name_passes_its_gate():
    for label, keyword, name in licenses.FAMILIES:
        for text in names(re._parser.parse(name)):
            assert keyword in text.split() and re.search(licenses.HINTS, text), (label, text)


def test_names_that_the_gates_held_back(spark):
    texts = ["This is 0BSD.", "common development and distribution license 1.1", "x_CC-BY-SA 4.0", "zero-clause BSD"]
    got = detect(spark, texts)
    assert [got[i].labels for i in range(4)] == [["0bsd"], ["cddl-1.1"], ["cc-by", "cc-by-sa-4.0"], ["0bsd"]]
