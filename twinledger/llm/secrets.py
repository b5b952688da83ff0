"""Secrets in texts, and credentials that come in parts.

Patterns that are enough alone are reported as they are. A weaker candidate (a
user name, a short password, a bare token, the address of a service) says
little alone; it is reported only if complementary parts stand within a scope
around it: a secret with an identifier or an endpoint, an identifier with a
secret, an endpoint with both. Positions are code points, ends exclusive.

Only column functions and joins are used. A match's position is the sum of
the lengths of the pieces that ``split`` leaves and of the matches before it, added up in a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from twinledger.llm.shared import checkpointed

# The patterns, without look-around, alike in Java and RE2.
_TO = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)" + _TO + r"([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
WEAK_ID = r"(?i:access_?key_?id|client_?id|account_?id|user_?name|user_?id|user|login)" + _TO + r"[A-Za-z0-9@._-]{3,}"
WEAK_SECRET = (
    r"(?i:pwd|passphrase|pass|auth|private_?key|client_?key|access_?key|credentials?)" + _TO + r"[A-Za-z0-9+/_=-]{8,}"
)
BARE = r"[A-Za-z0-9+/]{32,}"
ENDPOINT = r"(?i:https?|s?ftp|s3|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp|ssh)://[^\x00-\x20\"'<>]+"
#: Shortest value of an assignment, and how far apart the parts of a credential may stand.
SHORTEST, SCOPE = 6, 200

#: Kinds in the order in which spans of one start are listed; the first three need no other part.
KINDS = ("assign", "access", "hex", "id", "secret", "endpoint", "bare")
ROLE = {"assign": "secret", "hex": "secret", "access": "id", "id": "id", "secret": "secret", "endpoint": "endpoint", "bare": "secret"}
_SPAN = "struct<start:int,rank:int,end:int>"
_MARK = "struct<rank:int,before:int,long:int,counts:boolean>"


def _marks(text: Column, kind: str, pattern: str, gate: Column | None = None, counts=lambda found: F.lit(True)) -> Column:
    """For every match in order: the characters before it and after the last one, its own, and whether it ``counts``."""
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    there = F.rlike(text, F.lit(pattern))
    marks = F.zip_with(
        F.slice(pieces, 1, F.size(found)),
        found,
        lambda piece, one: F.struct(
            F.lit(KINDS.index(kind)).alias("rank"),
            F.char_length(piece).alias("before"),
            F.char_length(one).alias("long"),
            counts(one).alias("counts"),
        ),
    )
    return F.when(there if gate is None else gate & there, marks).otherwise(F.array().cast(f"array<{_MARK}>"))


def marks(text: Column) -> Column:
    """The marks of all patterns, those that are enough alone first; no pattern matches an empty text."""
    assigns = F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))
    long_enough = lambda found: F.char_length(F.regexp_extract(found, ASSIGN, 1)) >= SHORTEST
    mixed = lambda found: F.rlike(found, F.lit("[0-9]")) & F.rlike(found, F.lit("[a-z]")) & F.rlike(found, F.lit("[A-Z]"))
    return F.concat(
        _marks(text, "assign", ASSIGN, assigns, long_enough),
        _marks(text, "access", ACCESS, F.contains(text, F.lit("AKIA"))),
        _marks(text, "hex", HEX),
        _marks(text, "id", WEAK_ID, assigns),
        _marks(text, "secret", WEAK_SECRET, assigns),
        _marks(text, "bare", BARE, counts=mixed),
        _marks(text, "endpoint", ENDPOINT, F.contains(text, F.lit("://"))),
    )


def spans(hashed: DataFrame) -> DataFrame:
    """``id, hash, start, rank, end`` of all matches that count, each once for rows that repeat an id and text.

    Marks become rows and their lengths are added up in order, so any number of matches in
    a text takes time in proportion to it. All that follows is grouped by id and hash, on one exchange.
    """
    every = (
        hashed.select("id", "hash", F.posexplode_outer(marks(F.col("text"))).alias("pos", "mark"))
        # not on the array, which would evaluate the patterns again
        .filter("mark IS NOT NULL")
        .repartition("id", "hash")
        .groupBy("id", "hash", "pos")
        .agg(F.first("mark").alias("mark"))
        .select("id", "hash", "pos", "mark.*")
    )
    upto = Window.partitionBy("id", "hash", "rank").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = every.withColumn("end", F.sum(F.col("before") + F.col("long")).over(upto).cast("int"))
    return placed.filter("counts").select("id", "hash", (F.col("end") - F.col("long")).alias("start"), "rank", "end")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Every row's secrets: ``id_col``, ``n_assign``, ``n_access``, ``n_hex``, ``base``, ``linked``.

    ``base`` and ``linked`` are arrays of ``struct(start, rank, end)``, ``rank`` of
    ``KINDS``: the patterns that are enough alone, and the weak parts that
    complementary parts within ``scope`` code points confirm; both by start, rank,
    end. NULL and empty texts have none. Rows that repeat an id and text have the
    same spans each. Time and rows are in proportion to the matches, also of one text.
    """
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hashed = source.withColumn("hash", F.xxhash64("text"))
    found = checkpointed(spans(hashed))
    alone = found.filter(F.col("rank") < KINDS.index("id"))
    listed_spans = (
        alone.unionByName(_linked(found, scope))
        .groupBy(F.col("id").alias("s_id"), F.col("hash").alias("s_hash"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end"))).alias("spans"))
    )
    empty = F.array().cast(f"array<{_SPAN}>")
    every = F.coalesce("spans", empty)
    base = F.filter(every, lambda s: s["rank"] < KINDS.index("id"))
    kinds = KINDS[: KINDS.index("id")]
    count = lambda rank: F.size(F.filter(every, lambda s: s["rank"] == rank)).cast("long")
    return hashed.select("id", "hash").join(
        listed_spans, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("hash") == F.col("s_hash")), "left"
    ).select(
        F.col("id").alias(id_col),
        *(count(n).alias(f"n_{kind}") for n, kind in enumerate(kinds)),
        base.alias("base"),
        F.filter(every, lambda s: s["rank"] >= KINDS.index("id")).alias("linked"),
    )


def _linked(found: DataFrame, scope: int) -> DataFrame:
    """Confirmed weak spans: ``id, hash, start, rank, end``.

    An interval join in bins as wide as the scope. What a bin holds of a role is its
    first start and last end, which is all that a window reaching into the bin asks
    for, so a text with any number of parts gives rows in proportion to them.
    """
    with_parts = _clear(found)
    roles = F.element_at(F.array(*(F.lit(ROLE[kind]) for kind in KINDS)), F.col("rank") + 1)
    parts = with_parts.withColumn("role", roles)
    bin_of = lambda at: F.floor(at / F.lit(scope))
    held = (
        parts.withColumn("bin", F.explode(F.sequence(bin_of(F.col("start")), bin_of(F.col("end") - 1))))
        .groupBy("id", "hash", "bin", F.col("role").alias("other"))
        .agg(F.min("start").alias("first"), F.max("end").alias("last"))
        .select(F.col("id").alias("h_id"), F.col("hash").alias("h_hash"), F.col("bin").alias("h_bin"), "other", "first", "last")
    )
    weak = parts.filter(F.col("rank") >= KINDS.index("id")).withColumn(
        "bin",
        F.explode(F.sequence(bin_of(F.greatest(F.col("start") - scope, F.lit(0))), bin_of(F.col("end") + scope - 1))),
    )
    near = (
        weak.join(
            held,
            F.col("id").eqNullSafe(F.col("h_id"))
            & (F.col("hash") == F.col("h_hash"))
            & (F.col("bin") == F.col("h_bin"))
            & (F.col("role") != F.col("other"))
            & (F.col("first") < F.col("end") + scope)
            & (F.col("last") > F.col("start") - scope),
        )
        .groupBy("id", "hash", "start", "rank", "end", "role")
        .agg(*(F.max(F.col("other") == role).alias(f"with_{role}") for role in ("id", "secret", "endpoint")))
    )
    complete = (
        F.when(F.col("role") == "secret", F.col("with_id") | F.col("with_endpoint"))
        .when(F.col("role") == "id", F.col("with_secret"))
        .otherwise(F.col("with_id") & F.col("with_secret"))
    )
    return near.filter(complete).select("id", "hash", "start", "rank", "end")


def _clear(spans: DataFrame) -> DataFrame:
    """The spans without weak ones that overlap a span of a kind listed earlier in weight: base, named, bare."""
    whole = Window.partitionBy("id", "hash").orderBy("start")
    before = whole.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # a frame that ends with the last row would be read anew for every row
    after = Window.partitionBy("id", "hash").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tier = F.when(F.col("rank") < KINDS.index("id"), 0).when(F.col("rank") < KINDS.index("bare"), 1).otherwise(2)
    tiered = spans.withColumn("tier", tier)
    for limit in (1, 2):
        stronger = F.col("tier") < limit
        tiered = tiered.withColumn(f"end_{limit}", F.max(F.when(stronger, F.col("end"))).over(before)).withColumn(
            f"next_{limit}", F.min(F.when(stronger, F.col("start"))).over(after)
        )
    hit = F.lit(False)
    for limit in (1, 2):
        overlap = (F.col(f"end_{limit}") > F.col("start")) | (F.col(f"next_{limit}") < F.col("end"))
        hit = hit | ((F.col("tier") == limit) & F.coalesce(overlap, F.lit(False)))
    return tiered.filter(~hit).select("id", "hash", "start", "rank", "end")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ","
    )
