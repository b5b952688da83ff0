import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from twinledger.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"
ASCII = {c: c + 32 for c in range(65, 91)}


def naive(rows, settings):
    count, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in ((t or "", k or "", s or "") for _, t, k, s in rows):
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(ASCII))
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
        langs[lang].add(source)
    found = []
    for lang, sources in langs.items():
        kept = [t for t, n in docs[lang].items() if n >= settings.documents]
        whole = sum((count[lang, s] for s in sources), Counter())

        def share(counted):
            total = sum(counted[t] for t in kept)
            return {t: 1 + (10**9 * (counted[t] + 5)) // (total + 5 * len(kept)) for t in kept}

        q, p = share(whole), {s: share(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[: settings.terms])):
                found += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(items, 1)]
    return sorted(found)


def run(spark, rows, settings, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(map(tuple, divergence.audit(df, settings=settings).collect()))


def drawn(seed, n):
    draw = random.Random(seed)
    words = ["the", "The", "of", "Été", "été", "straße", "a1b", "x_y", "naïve", "日本", "😀", "K", "İ", "z\x00y", "~"] + [f"w{c}" for c in "abcdefgh"]
    langs, sources = ["en", "de", None, "", "fr"], ["s1", "s2", None, "", "é", "z"]
    rows = []
    for i in range(n):
        text = " ".join(draw.choices(words, k=draw.randrange(12)))
        rows.append((i, draw.choice([text, text, text, None, "", "12 34"]), draw.choice(langs), draw.choice(sources)))
    return rows + [(n, "words of one document only", "xx", "s1"), (n + 1, None, "xx", "s2"), (n + 2, "alone", "yy", None)]


@pytest.mark.parametrize("changed", [{}, {"held": 3}, {"cells": 4, "sources": 2}, {"broadcast_rows": 0, "terms": 3}, {"documents": 1}])
def test_drawn_documents(spark, changed):
    settings = divergence.Settings(**({"documents": 4, "terms": 5} | changed))
    rows = drawn(len(changed), 400)
    assert run(spark, rows, settings) == naive(rows, settings)


def test_many_sources_and_a_hot_one(spark):
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choices("abcdefghij", k=9)), "en", f"s{draw.randrange(40)}" if i % 3 else "hot") for i in range(900)]
    settings = divergence.Settings(documents=30, cells=100, sources=16)
    assert run(spark, rows, settings, 7) == naive(rows, settings)


def test_a_very_long_text_and_repeated_rows(spark):
    rows = [(1, "big word " * 100_000, "en", "a"), (2, "x" * 200_000 + " big", "en", "b")] * 2 + [(3, "word", "en", "c")] * 3
    settings = divergence.Settings(documents=2)
    assert run(spark, rows, settings) == naive(rows, settings)


def test_counts_beyond_a_bigint_product(spark):
    row = spark.range(1).select(divergence._share(F.lit(10**13), F.lit(3 * 10**13 + 7), F.lit(10**6)).alias("p")).first()
    assert row.p == 1 + (10**9 * (10**13 + 5)) // (3 * 10**13 + 7 + 5 * 10**6)


def test_empty_tables_and_other_columns(spark):
    df = spark.createDataFrame([(1, "a b", "en", "s"), (2, "a", "en", "t")], SCHEMA)
    named = df.withColumns({c: F.lit("x") for c in ("term", "count", "docs", "place", "p", "shard")})
    got = sorted(map(tuple, divergence.audit(named, settings=divergence.Settings(documents=1)).collect()))
    assert got == naive([tuple(r) for r in df.collect()], divergence.Settings(documents=1))
    assert divergence.audit(df.filter("doc_id > 5")).collect() == []
    assert divergence.audit(df.limit(1)).collect() == []
