"""Personal data in texts, and the terms around it that give it away.

Values of a fixed form (addresses, numbers) are found by pattern and are the
protected entities. A term of a text that holds an entity discloses it as far as the corpus
says so: with c the number of documents that hold something, the term tells
log2(N c(term, entity) / (c(term) c(entity))) of the entity's information
log2(N / c(entity)). Few documents are weak evidence, so c(term, entity) / c(term) is
smoothed by documents that hold the entity as often as the corpus does. Terms that tell
more than a share of the information are generalised, those that tell nearly all of it removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from twinledger.functions.columns import named
from twinledger.llm.shared import bounded_batches, checkpointed, unused

KINDS = ("email", "ip", "card", "phone", "term")


class Settings(NamedTuple):
    """``prior``: documents of the corpus' own mix by which a term's are smoothed. ``generalise``,
    ``remove``: shares of an entity's information from which a term is replaced."""

    prior: float = 1.0
    generalise: float = 0.8
    remove: float = 0.95


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a match can start at the start of a run of digits only
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\w+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = at + 1
        at = text.find("@", free)


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def entities(text: str) -> list[tuple[int, int, int]]:
    """(kind's place in ``KINDS``, start, end) of each base span, by kind and start."""
    spans = [(0, *span) for span in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = (part.lstrip("0") for part in m[0].split("."))
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            spans.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = "".join(_DIGIT.findall(m[0]))
            if 13 <= len(digits) <= 19 and _luhn(digits):
                spans.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                spans.append((3, m.start(), m.end()))
    return spans


def _hash(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass")) - (1 << 63)


def _entity(text: str, span: tuple[int, int, int]) -> int:
    kind, start, end = span
    value = text[start:end]
    return _hash(f"{kind}:{value.lower() if kind == 0 else value if kind == 1 else ''.join(_DIGIT.findall(value))}")


def _words(text: str, spans: Iterable[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """(word in lower case, start, end) of the words that no span overlaps."""
    covered, last = sorted(spans), 0
    for m in _WORD.finditer(text):
        while last < len(covered) and covered[last][1] <= m.start():
            last += 1
        if last == len(covered) or covered[last][0] >= m.end():
            yield m[0].lower(), m.start(), m.end()


def _detected(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = ("kind", "start", "end")
    for batch in batches:
        rows = []
        for text in batch:
            spans = entities(text) if text else []
            rows.append(([dict(zip(names, s)) for s in spans], sorted({_entity(text, s) for s in spans})))
        yield pd.DataFrame(rows, columns=["spans", "entities"])


def _located(texts: pd.Series, spans: pd.Series, terms: pd.Series) -> pd.Series:
    """Every place of the terms in the texts."""
    found = []
    for text, base, actions in zip(texts, spans, terms):
        wanted, hashed = {t["term"]: t["action"] for t in actions}, {}
        places = []
        for word, start, end in _words(text, ((s["start"], s["end"]) for s in base)):
            if word not in hashed:
                hashed[word] = wanted.get(_hash(word))
            if hashed[word]:
                places.append({"kind": KINDS.index("term"), "start": start, "end": end, "action": hashed[word]})
        found.append(places)
    return pd.Series(found, dtype=object)


def _terms(held: DataFrame, most: int) -> DataFrame:
    """``row, term`` of the distinct words of each text, without those in more than ``most`` texts of a batch."""

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for row, text, spans in zip(batch["row"], batch["held"], batch["spans"]):
                for word in {word for word, _, _ in _words(text, ((s["start"], s["end"]) for s in spans))}:
                    seen.setdefault(word, []).append(row)
            rare = {word: rows for word, rows in seen.items() if len(rows) <= most}
            terms = np.array([_hash(word) for word in rare], dtype=np.int64)
            rows = np.array([row for rows in rare.values() for row in rows], dtype=np.int64)
            yield pd.DataFrame({"row": rows, "term": np.repeat(terms, [len(rows) for rows in rare.values()])})

    return held.mapInPandas(distinct, "row long, term long")


def _document_frequency(texts: DataFrame) -> DataFrame:
    """``term`` and the number of texts that hold it, added up before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, int] = {}
            for text in batch["text"]:
                for word in {word.lower() for word in set(_WORD.findall(text))}:
                    seen[word] = seen.get(word, 0) + 1
            yield pd.DataFrame({"term": pd.Series([_hash(w) for w in seen], dtype="int64"), "n": pd.Series(seen.values(), dtype="int64")})

    return texts.mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("in_term"))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Every row's personal data: ``id_col``, ``text_hash``, ``spans``.

    ``spans`` holds ``kind`` (of ``KINDS``), ``start``, ``end`` (code points, end
    exclusive) and ``action`` (``mask`` for entities, ``generalise`` or ``remove`` for
    terms), by kind as listed and start. NULL and empty texts have none. A term
    is a span wherever it stands in documents that hold the entity it discloses. Copies of a text count as documents.
    """
    bounded_batches(docs.sparkSession)
    detected = F.pandas_udf(_detected, "spans array<struct<kind int, start int, end int>>, entities array<long>")
    located = F.pandas_udf(_located, "array<struct<kind int, start int, end int, action string>>")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = checkpointed(
        source.select("id", "text", F.xxhash64("text").alias("text_hash"), detected("text").alias("found"))
        .select("id", "text_hash", "found.*", F.when(F.size("found.entities") > 0, F.col("text")).alias("held"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    held = found.filter("held IS NOT NULL").select("row", "held", "spans")
    terms = held.join(_disclosing(source, found, settings), "row").select("row", located("held", "spans", "actions").alias("terms"))
    base = F.transform(
        "spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit("mask").alias("action"))
    )
    return found.select("id", "text_hash", "spans", "row").join(terms, "row", "left").select(
        F.col("id").alias(id_col),
        "text_hash",
        F.transform(
            F.when(F.col("terms").isNull(), base).otherwise(F.concat(base, "terms")),
            lambda s: F.struct(
                F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                s["action"].alias("action"),
            ),
        ).alias("spans"),
    )


def _classes(entity: DataFrame) -> DataFrame:
    """``row`` and ``entity``, distinct, with a number of the class of entities in place of the entity.

    A class's entities stand in the same rows: as many, with equal sums of the rows' hashes.
    """
    mark = lambda seed: F.xxhash64(F.lit(seed), "row")
    halves = [half for seed in (1, 2) for half in (mark(seed).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(mark(seed), 32))]
    rows = entity.distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n"), *(F.sum(half).alias(f"d{i}") for i, half in enumerate(halves)))
    of = rows.select("entity", F.xxhash64("n", *(f"d{i}" for i in range(4))).alias("class"))
    return entity.join(of, "entity").select("row", F.col("class").alias("entity")).distinct()


def _disclosing(source: DataFrame, found: DataFrame, settings: Settings) -> DataFrame:
    """``row`` and ``actions`` (``term``, ``action``) of the terms that tell too much of an entity of the row.

    A term in more texts than ``reach`` can't tell enough of an entity, were it in all texts with it.
    Entities of the same rows have the same counts with every term, so they are one class: a text with any
    number of addresses of its own makes one row a term, not one for each address.
    """
    whole = max(1, found.count())
    entity = checkpointed(_classes(found.select("row", F.explode("entities").alias("entity"))))
    in_entity = entity.groupBy("entity").agg(F.count(F.lit(1)).alias("in_entity"))
    expected = F.col("in_entity") / F.lit(float(whole))
    smoothed = lambda both: both + settings.prior * expected
    reach = smoothed(F.col("in_entity")) * F.pow(expected, F.lit(settings.generalise - 1)) - settings.prior + 1e-6
    in_entity = in_entity.filter(F.col("in_entity") < whole).withColumn("reach", reach)
    most = int(in_entity.agg(F.max("reach")).first()[0] or 0)
    in_term = _document_frequency(source.select("text").filter("text IS NOT NULL")).filter(F.col("in_term") <= most)
    rare = _terms(found.filter("held IS NOT NULL").select("row", "held", "spans"), most).join(in_term, "term")
    pairs = checkpointed(
        rare.join(entity.join(in_entity, "entity"), "row")
        .filter(F.col("in_term") <= F.col("reach"))
        .select("row", "entity", "term", "in_term", "in_entity")
    )
    together = pairs.groupBy("entity", "term").agg(
        F.count(F.lit(1)).alias("both"), F.first("in_term").alias("in_term"), F.first("in_entity").alias("in_entity")
    )
    share = F.log2(smoothed(F.col("both")) / (F.col("in_term") + settings.prior) / expected) / -F.log2(expected)
    flagged = (
        together.withColumn("told", share)
        .filter(F.col("told") >= settings.generalise)
        .select("entity", "term", F.when(F.col("told") >= settings.remove, "remove").otherwise("generalise").alias("action"))
    )
    return (
        pairs.select("row", "entity", "term")
        .join(flagged, ["entity", "term"])
        .groupBy("row", "term")
        .agg(F.max("action").alias("action"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("term", "action")).alias("actions"))
    )


def _general(term: str) -> str:
    return "[NUMBER]" if any(c.isdigit() for c in term) else "[NAME]" if term[:1].isupper() else "[TERM]"


def masked(text: str, spans: list[tuple[str, int, int, str]]) -> str:
    """The text with its spans replaced; overlapping spans become one."""
    parts, at = [], 0
    for kind, start, end, action in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts.append(text[at:start])
            if action != "remove":
                parts.append(f"[{kind.upper()}]" if action == "mask" else _general(text[start:end]))
        at = max(at, end)
    parts.append(text[at:])
    return "".join(parts)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with the personal data of ``text_col`` masked and disclosing terms replaced.

    Columns, rows and NULL texts stay. Only rows with spans meet their text
    again, by id and the text's hash.
    """
    found_id, found_hash, own_hash, found = (unused(docs, n) for n in ("_id", "_hash", "_own_hash", "_spans"))
    spans = (
        detect(docs, id_col, text_col, settings)
        .filter(F.size("spans") > 0)
        .select(named(id_col).alias(found_id), F.col("text_hash").alias(found_hash), F.col("spans").alias(found))
        .dropDuplicates([found_id, found_hash])
    )

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series(
            [
                text if text is None or spans is None else masked(text, [(s["kind"], s["start"], s["end"], s["action"]) for s in spans])
                for text, spans in zip(texts, found)
            ],
            dtype=object,
        )

    joined = docs.withColumn(own_hash, F.xxhash64(named(text_col))).join(
        spans, named(id_col).eqNullSafe(F.col(found_id)) & (F.col(own_hash) == F.col(found_hash)), "left"
    )
    text = F.when(F.col(found).isNull(), named(text_col)).otherwise(replaced(named(text_col), found))
    return joined.select(*(text.alias(c) if c == text_col else named(c) for c in docs.columns))
