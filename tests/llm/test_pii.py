import math
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from twinledger.llm import pii

SCHEMA = "doc_id long, text string"

# the kinds as the contract states them
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def naive(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return found


TEXTS = [
    None, "", "a@b.c%x@y.zz", "é a.b@c-d.ef, x@y, q@@r.s, a@b.cd@e.fg @h.i", "1.2.3.4.5 256.1.1.1 001.02.3.255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 2", "+1 (555) 010-9999. +12 +123456789012345678 +1+2",
    "😀 mail me@x.org 😀 10.0.0.1 +44 20 7946 0958", "9" * 5000 + " " + "1.1.1." * 50, "a" * 50_000 + "@", "0000000000000",
    "%+-@a.b", "x@a-.-b.c.", "x@a..b", "+" * 2000 + "1(2)3", "1 2 3 4 5 6 7 8 9 0 1 2 8",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_of_odd_texts(text):
    assert pii.entities(text or "") == naive(text)


def test_base_spans_of_the_documents(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.kind != "term"] for r in pii.detect(docs).collect()}
    assert got == {i: [(pii.KINDS[k], s, e) for k, s, e in naive(t)] for i, t in texts.items()}
    assert sum(map(len, got.values())) > 20


def brute_force(rows, window=8, texts=3, share=0.8):
    """Disclosing terms by counting documents one by one."""
    spans, near, holds = {}, {}, {}
    for n, text in enumerate(rows):
        text = text or ""
        base = sorted(naive(text), key=lambda s: s[1])
        words = [m for m in re.finditer(r"\w+", text) if not any(s < m.end() and e > m.start() for _, s, e in base)]
        holds[n] = {m[0].lower() for m in re.finditer(r"\w+", text)}
        near[n] = set()
        for kind, start, end in base:
            value = text[start:end]
            value = (kind, value.lower() if kind == 0 else value if kind == 1 else re.sub("[^0-9]", "", value))
            before = [m for m in words if m.start() < end][-window:]
            after = [m for m in words if m.start() >= end][:window]
            near[n] |= {(value, m[0].lower(), m.start(), m.end()) for m in before + after}
        spans[n] = base
    entity, both, different = Counter(), Counter(), defaultdict(set)
    for n, found in near.items():
        for e in {e for e, *_ in found}:
            entity[e] += 1
        for pair in {(e, t) for e, t, *_ in found}:
            both[pair] += 1
            different[pair].add(rows[n])
    term = Counter(t for held in holds.values() for t in held)
    flagged = {}
    for (e, t), c in both.items():
        told = math.log2(len(rows) * c / (term[t] * entity[e])) / math.log2(len(rows) / entity[e])
        if len(different[e, t]) >= texts and told >= share - 1e-12:
            flagged[e, t] = told
    return {n: sorted({(s, e) for v, t, s, e in found if (v, t) in flagged}) for n, found in near.items()}


def corpus():
    rows = [f"Report {i}: the Falcon{i % 2} desk of ann@corp.org in Zurich said nothing" for i in range(6)]
    rows += [f"the desk said {i} and Zurich" for i in range(30)]
    rows += [f"call +44 20 7946 095{i} about the desk" for i in range(5)]
    return rows + [None, "", "plain words only"]


def test_terms_that_disclose(spark):
    rows = corpus()
    df = spark.createDataFrame(list(enumerate(rows)), SCHEMA)
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "term"] for r in pii.detect(df).collect()}
    expected = brute_force(rows)
    assert got == expected
    words = {rows[i][s:e] for i, spans in expected.items() for s, e in spans}
    assert {"Falcon0", "Falcon1", "in"} <= words and not {"the", "desk", "Zurich", "said"} & words


def test_sanitised_texts(spark):
    rows = corpus() + ["bob@x.org, 10.0.0.1"]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(rows)], SCHEMA + ", _spans int").withColumn("_id", F.lit("k"))
    out = pii.sanitise(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert len(got) == len(rows) and got[41] is None and got[42] == "" and got[43] == rows[43]
    assert got[44] == "[EMAIL], [IP]"
    assert "ann@corp.org" not in got[0] and "Falcon0" not in got[0] and "Zurich" in got[0]
    assert got[10] == rows[10]


def test_repeated_rows_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a@b.cd"), (1, "a@b.cd"), (None, "x 1.1.1.1"), (2, None)], SCHEMA)
    assert pii.detect(df).count() == 4
    assert sorted((r.text or "" for r in pii.sanitise(df).collect())) == ["", "[EMAIL]", "[EMAIL]", "x [IP]"]
    empty = df.filter("doc_id > 5")
    assert pii.detect(empty).collect() == [] and pii.sanitise(empty).collect() == []


def test_actions():
    text = "Al of x42 and abc"
    spans = [("term", 0, 2, "generalise"), ("term", 6, 9, "generalise"), ("term", 14, 17, "remove"), ("email", 7, 8, "mask")]
    assert pii.masked(text, spans) == "[NAME] of [NUMBER] and "


def test_terms_of_rare_entities_are_found(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    terms = [(r.doc_id, s) for r in pii.detect(docs).collect() for s in r.spans if s.kind == "term"]
    holds = Counter(w for t in texts.values() for w in {m[0].lower() for m in re.finditer(r"\w+", t or "")})
    assert len(terms) > 50 and all(naive(texts[i]) for i, _ in terms)
    assert all(holds[texts[i][s.start : s.end].lower()] < 10 for i, s in terms)


def disclosing(rows, share=0.8):
    """The terms of whole texts, counted document by document and smoothed by one document."""
    held, words, entities = [], [], []
    for text in rows:
        text = text or ""
        base = naive(text)
        held.append({m[0].lower() for m in re.finditer(r"\w+", text)})
        words.append([m for m in re.finditer(r"\w+", text) if not any(s < m.end() and e > m.start() for _, s, e in base)])
        entities.append({(k, text[s:e].lower() if k < 2 else re.sub("[^0-9]", "", text[s:e])) for k, s, e in base})
    in_term, in_entity = Counter(t for h in held for t in h), Counter(e for found in entities for e in found)
    both = Counter((e, t) for found, w in zip(entities, words) for e in found for t in {m[0].lower() for m in w})
    flagged = set()
    for (e, t), n in both.items():
        p = in_entity[e] / len(rows)
        if p < 1 and math.log2((n + p) / (in_term[t] + 1) / p) / -math.log2(p) >= share - 1e-12:
            flagged.add((e, t))
    return [sorted(m.span() for m in w if any((e, m[0].lower()) in flagged for e in found)) for found, w in zip(entities, words)]


def test_terms_of_the_whole_text_disclose(spark):
    filler = " ".join(["the desk said nothing"] * 40)
    rows = corpus() + [f"Memo of Ospina{i}\n{filler} Ospina{i}, İzmir{i}\n{filler}\nwrite to p{i}@x.org or 10.0.0.{i}" for i in range(3)]
    rows += ["the desk said nothing of it"] * 60
    df = spark.createDataFrame(list(enumerate(rows)), SCHEMA)
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "term"] for r in pii.detect(df).collect()}
    assert got == dict(enumerate(disclosing(rows)))
    at = len(corpus())
    assert [rows[at][s:e] for s, e in got[at]] == ["Ospina0", "Ospina0", "İzmir0"]


def test_terms_of_the_documents(spark, middle):
    rows = spark.read.parquet(f"{middle}/documents.parquet").collect()
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "term"] for r in pii.detect(spark.createDataFrame(rows)).collect()}
    assert got == {r.doc_id: spans for r, spans in zip(rows, disclosing([r.text for r in rows]))}


def test_time_in_proportion_to_a_text_of_many_entities(spark):
    def seconds(n):
        rows = [(1, " ".join(f"word{i} me{i}@x.org" for i in range(n)))] + [(i, "plain words of a text") for i in range(2, 40)]
        df = spark.createDataFrame(rows, SCHEMA)
        start = time.perf_counter()
        spans = next(r.spans for r in pii.detect(df).collect() if r.doc_id == 1)
        assert sum(s.kind == "email" for s in spans) == sum(s.kind == "term" for s in spans) == n
        return time.perf_counter() - start

    seconds(100)
    assert seconds(40_000) < 2.6 * max(seconds(20_000), 1.5)


def test_classes_of_entities(spark):
    rows = [(1, 10), (1, 11), (1, 12), (2, 12), (2, 13), (3, 13), (1, 10)]
    got = pii._classes(spark.createDataFrame(rows, "row long, entity long")).collect()
    assert sorted(r.row for r in got) == [1, 1, 2, 2, 3] and len({r.entity for r in got}) == 3
