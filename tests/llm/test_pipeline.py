"""Each stage against brute force on what the stage before kept."""

import hashlib
import uuid
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_pii import naive as personal
from test_shingles import grams

import corpus_pipeline
from twinledger.llm import bpe, mixing, pii, quality
from twinledger.llm.queries import RANKS


@pytest.fixture(scope="module")
def kept(spark, middle, tmp_path_factory):
    """The documents before and after each stage."""
    found = [spark.read.parquet(f"{middle}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / uuid.uuid4().hex)
        stage(spark, found[-1], middle).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def test_stages_and_columns(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "personal data", "source mix", "byte-level BPE"
    ]
    for df in kept[:5]:
        assert tuple(df.columns) == corpus_pipeline.COLUMNS


def test_rejected_documents_go_and_clean_ones_stay(spark, kept, middle):
    labels = spark.read.parquet(f"{middle}/labels.parquet")
    scores = {r.doc_id: r.score for r in quality.quality_scores(kept[0], labels).collect()}
    left = {r.doc_id for r in kept[1].select("doc_id").collect()}
    assert left == {i for i, s in scores.items() if s >= corpus_pipeline.QUALITY}
    clean = [r.doc_id for r in labels.filter("quality = 1").collect() if r.doc_id in scores]
    assert sum(i in left for i in clean) >= 0.98 * len(clean)


def test_one_document_of_each_group_stays(kept):
    rows = kept[1].select("doc_id", "text").collect()
    sets = {r.doc_id: grams(r.text) for r in rows}
    holders = {}
    for i, held in sets.items():
        for gram in held:
            holders.setdefault(gram, []).append(i)
    both = Counter((a, b) for ids in holders.values() if len(ids) < 200 for a in ids for b in ids if a < b)
    label = {i: i for i in sets}
    links = [(a, b) for (a, b), n in both.items() if n / (len(sets[a]) + len(sets[b]) - n) >= 0.8]
    for _ in range(len(links)):
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    assert len(links) > 20
    assert {r.doc_id for r in kept[2].select("doc_id").collect()} == {i for i, low in label.items() if i == low}


def test_personal_data_goes_and_other_texts_stay(kept):
    before = {r.doc_id: r.text for r in kept[2].collect()}
    after = {r.doc_id: (r.text, r.n_chars) for r in kept[3].collect()}
    spans = {r.doc_id: r.spans for r in pii.detect(kept[2]).collect()}
    assert set(before) == set(after) and sum(text != after[i][0] for i, text in before.items()) > 5
    for i, text in before.items():
        found = [(s.kind, s.start, s.end, s.action) for s in spans[i]]
        assert after[i] == (pii.masked(text, found), len(pii.masked(text, found)))
        assert not personal(after[i][0])
        if not found:
            assert after[i][0] == text


def test_sources_come_near_their_targets(kept):
    repeats = Counter(r.doc_id for r in kept[4].select("doc_id").collect())
    mixed = mixing.mix(kept[3]).collect()
    assert repeats == Counter({r.doc_id: r.copies for r in mixed if r.copies})
    taken, target, longest = Counter(), {}, Counter()
    for r in mixed:
        taken[r.source] += r.taken
        target[r.source] = r.target
        longest[r.source] = max(longest[r.source], r["size"])
    for source, want in target.items():
        assert abs(taken[source] - want) <= max(0.02 * want, longest[source])


def test_token_ids(kept):
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(RANKS)), special_tokens={})
    texts = {r.doc_id: r.text for r in kept[4].collect()}
    rows = kept[5].collect()
    assert len(rows) == kept[4].count()
    packed = {i: b"".join(n.to_bytes(4, "little") for n in own.encode_ordinary(text)) for i, text in texts.items()}
    for r in rows:
        assert bytes(r.ids) == packed[r.doc_id] and r.n_tokens == len(r.ids) // 4
        assert r.ids_sha256 == hashlib.sha256(packed[r.doc_id]).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_gives_what_the_stages_give(spark, middle, kept):
    got = corpus_pipeline.run(spark, middle)
    assert sorted(map(str, got.collect())) == sorted(map(str, kept[5].drop("ids").collect()))


def test_other_columns_nulls_and_no_rows(spark, kept, middle):
    odd = spark.createDataFrame(
        [(10**6 + i, text, "en", source, 5, "x", 1) for i, (text, source) in enumerate([(None, "a"), ("", None), ("plain words of a text here", "a")])],
        "doc_id long, text string, lang string, source string, n_chars long, _score string, _copies int",
    )
    docs = kept[0].withColumn("_score", F.lit("s")).withColumn("_copies", F.lit(0)).limit(60).unionByName(odd)
    for _, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, middle)
        assert stage(spark, docs.limit(0), middle).count() == 0
        assert done.count() >= 0
        docs = done if "text" in done.columns else docs
    assert set(docs.columns) >= {"_score", "_copies"}


def test_rows_that_repeat_an_id(spark, middle):
    long, other = (" ".join(f"{w}{i}" for i in range(60)) for w in ("a", "b"))
    rows = [(1, long), (1, long), (1, other), (2, other + " more"), (3, long), (4, "x y"), (4, "x y"), (5, None), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("r"))
    got = corpus_pipeline.near_duplicates(spark, docs, middle)
    assert got.columns == docs.columns
    left = sorted((r.doc_id, r.text or "") for r in got.collect())
    assert left == [(1, long), (1, other), (4, "x y"), (5, ""), (5, "")]


def test_the_mix_counts_rows_that_repeat_an_id(spark, middle):
    rows = [(1, "a " * n, "x") for n in range(1, 30)] + [(2, "b " * 400, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("_row", F.lit(0))
    got = Counter(r.text for r in corpus_pipeline.target_mix(spark, docs, middle).collect())
    numbered = docs.drop("_row").withColumn("row", F.monotonically_increasing_id())
    texts = {r.row: r.text for r in numbered.collect()}
    assert got == Counter({texts[r.row]: r.copies for r in mixing.mix(numbered, row_col="row").collect() if r.copies})


def test_digest_of_the_token_ids(spark, middle):
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(RANKS)), special_tokens={})
    texts = {1: "Some words, 12 numbers and é", 2: ""}
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts.items()], "doc_id long, text string, source string")
    got = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.token_ids(spark, docs, middle).drop("ids").collect()}
    packed = {i: b"".join(n.to_bytes(4, "little") for n in own.encode_ordinary(t)) for i, t in texts.items()}
    assert got == {i: hashlib.sha256(b).hexdigest() for i, b in packed.items()}
