import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from twinledger.llm import contents

SCHEMA = "doc_id long, text string, source string"


def naive(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), i is None, i or 0))
    out = []
    for content, members in groups.items():
        digest, best = hashlib.sha256(content.encode()).hexdigest(), min(members)
        stays = {members.index(best)}
        for n, (_, none, i) in enumerate(members):
            out.append((None if none else i, None if best[1] else best[2], len(members), n in stays, digest))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    return sorted(map(tuple, contents.exact_dedup(df, **kw).collect()), key=str)


TEXTS = [
    None, "", "  ", "\t\n\x0b\x0c\r", "a b", "ab", "a b", "a\x1cb", "ab\x00", "ab\x00\x00", "A b", "é", "é", "é",
    " ", "😀 x", "😀x", "x" * 200_000, "x" * 199_999 + " x", "x" * 199_999 + "y",
]


def test_odd_texts_and_ties(spark):
    rows = [(n, t) for n, t in enumerate(TEXTS)] + [(100 - n, t) for n, t in enumerate(TEXTS)]
    assert run(spark, rows) == naive(rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b"), (3, "ab"), (3, "ab"), (None, "c"), (None, "c"), (7, "d"), (7, "d "), (1, "d")]
    assert run(spark, rows) == naive(rows)


@pytest.mark.parametrize("ranges, samples", [(1, 1), (8, 16), (64, 4)])
def test_a_third_of_all_rows_are_copies(spark, ranges, samples):
    draw = random.Random(ranges)
    word = lambda: "".join(draw.choice("ab ") for _ in range(draw.randrange(1, 6)))
    rows = [(i, "the same text" + " " * draw.randrange(3)) for i in range(700)]
    rows += [(i, word()) for i in range(700, 1700)] + [(i, "the same text again " + word()) for i in range(1700, 2100)]
    draw.shuffle(rows)
    assert run(spark, rows, settings=contents.Settings(ranges=ranges, samples=samples)) == naive(rows)


@pytest.mark.parametrize("broadcast_rows", [0, 100_000])
def test_copies_are_cut_and_put_together(spark, broadcast_rows):
    rows = [(i, "one text") for i in range(3000)]
    settings = contents.Settings(broadcast_rows=broadcast_rows)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    assert len(contents._splitters(df, "doc_id", "text", settings)) > 30
    assert run(spark, rows, settings=settings) == naive(rows)


def test_texts_of_one_hash_and_start_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(contents, "_hashed", lambda *columns: F.lpad(F.hex(F.pmod(F.xxhash64(*columns), F.lit(2))), 16, "0"))
    monkeypatch.setattr(contents, "START", 1)
    rows = [(i, f"x{i % 7}") for i in range(600)] + [(i, f"y{i}") for i in range(600, 650)]
    assert run(spark, rows) == naive(rows)


def test_empty_tables_and_other_columns(spark):
    df = spark.createDataFrame([(1, "a", "s")], SCHEMA)
    named = df.withColumns({c: F.lit(5) for c in ("id", "content", "range", "run", "first", "keep", "kept", "tie")})
    assert [tuple(r)[:4] for r in contents.exact_dedup(named).collect()] == [(1, 1, 1, True)]
    assert contents.exact_dedup(df.filter("doc_id > 1")).collect() == []


def test_no_python_and_one_shuffle_of_texts(spark, middle):
    plan = contents.exact_dedup(spark.read.parquet(f"{middle}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
