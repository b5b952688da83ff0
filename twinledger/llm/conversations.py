"""The structure of conversations, repaired by weighted interval parsing.

A sound conversation is empty, or an optional system turn and pairs of a user's and an assistant's
turn. Its grammar in Chomsky normal form has a nonterminal for every two junctures (before
all turns, after a system's, a user's, an assistant's turn); it derives the turns between them, from the left
juncture to any other and from there to the right one. Keeping, re-roling and deleting a turn are
its terminal rules, closed under insertions on both sides.

A span's cell holds for each nonterminal the least (cost, audit) of making the span's turns into what it
derives, where the audit is the edits' initials. Cells are combined bottom-up by span length.
The grammar is regular, so a span may be cut anywhere: spans of 1, 2, 4, 8... turns are enough. Two
audits of one cost and one span are never one the beginning of the other, as an audit fixes its cost; so
least audits combine to least audits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from twinledger.functions.columns import named
from twinledger.llm.shared import bounded_batches, checkpointed

# What edits cost.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# Sound neighbours, by the initials of their roles.
SOUND = ("su", "ua", "au")
# White space, and the ends of a sentence.
BLANK = " \t\n\x0b\x0c\r"
ENDS = ".!?"

START, SYSTEM, USER, ASSISTANT = "start", "system", "user", "assistant"
#: What a single turn may lead over: the initial of its role for each two junctures.
TURNS = {(START, SYSTEM): "s", (START, USER): "u", (SYSTEM, USER): "u", (ASSISTANT, USER): "u", (USER, ASSISTANT): "a"}
#: Junctures after which a conversation may end.
FINAL = (START, ASSISTANT)
TURNS_TO = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {"u": USER, "a": ASSISTANT}

#: Texts of a conversation that a task holds at most; a longer one is put together turn by turn.
HELD_BYTES = 16 << 20
#: Conversations up to this number are broadcast.
BROADCAST_ROWS = 100_000


def _nonterminals() -> list[tuple[str, str]]:
    found = {(j, j) for j in (START, SYSTEM, USER, ASSISTANT)} | set(TURNS)
    while more := {(p, q) for p, r in found for s, q in found if r == s} - found:
        found |= more
    return sorted(found)


NONTERMINALS = _nonterminals()
_AT = {pair: i for i, pair in enumerate(NONTERMINALS)}
#: For each nonterminal the two that it may be made of.
RULES = [
    [(_AT[p, r], _AT[r, q]) for r in (START, SYSTEM, USER, ASSISTANT) if (p, r) in _AT and (r, q) in _AT]
    for p, q in NONTERMINALS
]

Cell = list[tuple[int, str] | None]


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans."""
    cell: Cell = []
    for rules in RULES:
        best = None
        for i, j in rules:
            x, y = left[i], right[j]
            if x is not None and y is not None:
                found = (x[0] + y[0], x[1] + y[1])
                if best is None or found < best:
                    best = found
        cell.append(best)
    return cell


def _cell(entries: dict[tuple[str, str], tuple[int, str]]) -> Cell:
    return [entries.get(pair) for pair in NONTERMINALS]


def _nothing() -> Cell:
    """The cell of an empty span: insertions, until more of them give nothing new."""
    entries = {pair: (INSERT, "I") for pair, initial in TURNS.items() if initial in ROLES}
    cell = _cell(entries | {(j, j): (0, "") for j in (START, SYSTEM, USER, ASSISTANT)})
    while (more := combined(cell, cell)) != cell:
        cell = more
    return cell


NOTHING = _nothing()


def turn_cell(initial: str, dropped: bool, truncated: bool) -> Cell:
    """The cell of one turn, closed under insertions."""
    entries = {pair: (DELETE, "D") for pair in NONTERMINALS if pair[0] == pair[1]}
    if not dropped:
        extra = TRUNCATED * truncated
        for pair, wanted in TURNS.items():
            edits = [(KEEP + extra, "K")] * (wanted == initial) + [(REROLE + extra, "R")] * (wanted in ROLES)
            if edits:
                entries[pair] = min(edits)
    return combined(combined(NOTHING, _cell(entries)), NOTHING)


#: Every turn's cell, by initial (empty for unknown roles), whether it must go, whether it is truncated.
TURN_CELLS = {
    (initial, dropped, truncated): turn_cell(initial, dropped, truncated)
    for initial in ("", "s", "u", "a")
    for dropped in (False, True)
    for truncated in (False, True)
}


class Spans:
    """Adjacent spans, combined as soon as two are of one length."""

    def __init__(self) -> None:
        self.stack: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        length = 1
        while self.stack and self.stack[-1][0] == length:
            cell, length = combined(self.stack.pop()[1], cell), 2 * length
        self.stack.append((length, cell))

    def whole(self) -> Cell:
        cells = [cell for _, cell in reversed(self.stack)]
        return reduce(lambda right, left: combined(left, right), cells) if cells else NOTHING


def best(cell: Cell) -> tuple[int, str]:
    """The cheapest repair of a whole conversation."""
    return min(found for j in FINAL if (found := cell[_AT[START, j]]) is not None)


def edited(audit: str, begin: str, end: str) -> Iterator[tuple[int, int, str | None]]:
    """What edits leave between two junctures: place of the edit, the turn it is of (-1: new), a new role if it has one.

    Turns take turns, so their roles follow from the junctures. The first is a system's if that alone
    makes their number lead to the end.
    """
    count = len(audit) - audit.count("D")
    system = begin == START and end in {1: (SYSTEM, ASSISTANT), 0: (USER,)}[count % 2] and (end == SYSTEM or count > 1)
    juncture, at = begin, -1
    for line, edit in enumerate(audit):
        at += edit != "I"
        if edit == "D":
            continue
        if system:
            initial, system = "s", False
        else:
            initial = "a" if juncture == USER else "u"
        juncture = TURNS_TO[initial]
        yield line, -1 if edit == "I" else at, None if edit == "K" else ROLES[initial]


def _turns(audit: str, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a repaired conversation."""
    end = ASSISTANT if audit.strip("D") else START
    for _, at, role in edited(audit, START, end):
        yield (roles[at] if role is None else role), (texts[at] if at >= 0 else "")


class _Part:
    """The turns of a conversation that a task has met."""

    def __init__(self, conv: str, start: int, edge: bool):
        self.conv, self.start, self.edge = conv, start, edge
        self.blank = self.duplicate = self.truncated = self.illegal = self.held = 0
        self.spans, self.roles, self.texts = Spans(), [], []
        self.first = self.last = ("", "")  # role and text

    def add(self, role: str, text: str, again: bool, at: int) -> None:
        stripped = text.strip(BLANK)
        blank = not stripped
        duplicate = not blank and (again or at > self.start and self.last == (role, text))
        truncated = not blank and not duplicate and stripped[-1] not in ENDS
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        if at > self.start:
            self.illegal += self.last[0][:1] + role[:1] not in SOUND
        else:
            self.first = (role, "")
        self.last = (role, text)
        initial = role[:1] if role[:1] in "sua" else ""
        self.spans.add(TURN_CELLS[initial, blank or duplicate, truncated])
        if not self.edge:
            self.held += len(role) + len(text)
            self.roles.append(role)
            self.texts.append(text)
            if self.held > HELD_BYTES:
                self.close_texts()

    def close_texts(self) -> None:
        self.edge, self.roles, self.texts = True, [], []

    def counts(self) -> tuple:
        return (self.conv, self.start, self.blank, self.duplicate, self.truncated, self.illegal)

    def row(self) -> tuple:
        if not self.edge:
            cost, audit = best(self.spans.whole())
            lines = "\n".join(f"{role}:{text}" for role, text in _turns(audit, self.roles, self.texts))
            digest = hashlib.sha256(lines.encode("utf-8", "surrogatepass")).hexdigest()
            return (*self.counts(), cost, audit, digest, None, None, None, None)
        cell = self.spans.whole()
        costs = [-1 if found is None else found[0] for found in cell]
        audits = ["" if found is None else found[1] for found in cell]
        return (*self.counts(), None, None, None, self.first[0][:1], self.last[0][:1], costs, audits)

    def lines(self) -> Iterator[tuple]:
        if not self.edge:
            _, audit = best(self.spans.whole())
            for n, (role, text) in enumerate(_turns(audit, self.roles, self.texts)):
                yield self.conv, self.start, n, role, text


def _parts(batches: Iterable[pd.DataFrame]) -> Iterator[_Part]:
    """The conversations of a task in order; its first and last may go on in other tasks."""
    here = None
    for batch in batches:
        for conv, at, role, text, again in zip(*(batch[c] for c in ("conv", "at", "role", "text", "again"))):
            if here is None or here.conv != conv:
                if here is not None:
                    yield here
                here = _Part(conv, at, edge=here is None)
            here.add(role, text, again, at)
    if here is not None:
        here.close_texts()
        yield here


COUNTS = "conv string, start long, blank long, duplicate long, truncated long, illegal long"
PARTS = (
    f"{COUNTS}, cost long, audit string, repaired_sha256 string, "
    "first string, last string, costs array<long>, audits array<string>"
)
LINES = "conv string, start long, line long, role string, text string"
_NAMES = lambda schema: [field.split()[0] for field in schema.split(", ")]
BATCH = 2000


def _frames(rows: Iterable[tuple], schema: str) -> Iterator[pd.DataFrame]:
    waiting, held = [], 0
    for row in rows:
        waiting.append(row)
        held += sum(len(value) for value in row if isinstance(value, str))
        if len(waiting) >= BATCH or held > HELD_BYTES:
            yield pd.DataFrame(waiting, columns=_NAMES(schema), dtype=object)
            waiting, held = [], 0
    if waiting:
        yield pd.DataFrame(waiting, columns=_NAMES(schema), dtype=object)


class Repaired(NamedTuple):
    """``report``: a row per conversation; ``turns``: the repaired conversations, a row per turn."""

    report: DataFrame
    turns: DataFrame


def repair(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Repaired:
    """The cheapest repair of every conversation, ties to the ASCII-least audit.

    A conversation's rows are taken by turn (NULL first), then role, then text. A row's first fault
    counts: blank, duplicate (role and text were seen earlier), truncated. NULL roles and texts are one
    space, so such a text is blank and such a role no known one; rows with a NULL conversation are one
    conversation. ``gaps`` counts the turns missing between the least and the greatest; 0 if all are NULL.

    ``report`` has ``conv_col``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``,
    ``repaired_sha256`` (of ``role:text`` lines); ``turns`` has ``conv_col``, ``line``, ``role``, ``text``. Empty
    tables give empty results; other columns are ignored.

    Rows are ranged by conversation and turn, so a conversation of any length is parsed by many tasks
    and its parts' cells are combined. Only the digest of such a conversation is made by one task, which
    streams its turns. Equal first rows of a conversation are found by a grouping that combines.
    """
    bounded_batches(conversations.sparkSession)
    rows = _rows(conversations, conv_col, turn_col, role_col, text_col)
    turns = rows.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("n")).groupBy("conv")
    turns = turns.agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0).cast("long")).alias("gaps")
    )
    ordered = checkpointed(_ordered(rows))
    columns = ordered.select("conv", "at", "role", "text", "again")
    parts = checkpointed(
        columns.mapInPandas(lambda batches: _frames((p.row() for p in _parts(batches)), PARTS), PARTS)
    )
    done = parts.filter("audit IS NOT NULL").select(*_NAMES(COUNTS), "cost", "audit", "repaired_sha256")
    cut = checkpointed(parts.filter("audit IS NULL").groupBy("conv").applyInPandas(_joined, JOINED))
    lines = checkpointed(_cut_lines(columns, cut))
    digests = (
        lines.select("conv", "start", "line", F.concat("role", F.lit(":"), "text").alias("text"))
        .repartition("conv")
        .sortWithinPartitions("conv", "start", "line")
        .mapInPandas(_digests, "conv string, found string")
    )
    wholes = (
        cut.filter("cost IS NOT NULL")
        .join(digests, "conv", "left")
        .select(*_NAMES(COUNTS), "cost", "audit", F.coalesce("found", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
    )
    plain = F.when(F.col("conv") != "-", F.substr("conv", F.lit(2))).cast(conversations.schema[conv_col].dataType)
    report = done.unionByName(wholes).drop("start").join(turns, "conv")
    short = columns.mapInPandas(lambda batches: _frames((x for p in _parts(batches) for x in p.lines()), LINES), LINES)
    return Repaired(
        report.select(
            plain.alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
        ),
        short.unionByName(lines).select(
            plain.alias(conv_col), (F.col("start") + F.col("line")).alias("line"), "role", "text"
        ),
    )


def _rows(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    conv = named(conv_col).cast("string")
    return df.select(
        F.when(conv.isNull(), "-").otherwise(F.concat(F.lit("+"), conv)).alias("conv"),
        named(turn_col).cast("long").alias("turn"),
        F.coalesce(named(role_col), F.lit(" ")).alias("role"),
        F.coalesce(named(text_col), F.lit(" ")).alias("text"),
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows in the order of their conversations: ``at`` counts them, ``again`` marks those seen in an earlier turn."""
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    placed = rows.withColumn("place", place).withColumn("digest", F.md5("text"))
    repeated = (
        placed.groupBy("conv", "role", "digest")
        .agg(F.min("place").alias("earliest"), F.max("place").alias("latest"))
        .filter("earliest < latest")
        .drop("latest")
    )
    return (
        placed.join(repeated, ["conv", "role", "digest"], "left")
        .withColumn("again", F.coalesce(F.col("place") > F.col("earliest"), F.lit(False)))
        .select("conv", "turn", "role", "text", "again", F.substring("text", 1, 64).alias("start"))
        .repartitionByRange("conv", "turn", "role", "start")
        .sortWithinPartitions("conv", "turn", "role", "text")
        .withColumn("at", F.monotonically_increasing_id())
    )


JOINED = f"{COUNTS}, cost long, audit string, piece string, begin string, end string"


def _joined(parts: pd.DataFrame) -> pd.DataFrame:
    """A conversation's parts: what of the best repair falls to each, and on the first the totals."""
    parts = parts.sort_values("start", ignore_index=True)
    cells = [
        [None if cost < 0 else (int(cost), audit) for cost, audit in zip(costs, audits)]
        for costs, audits in zip(parts["costs"], parts["audits"])
    ]
    reached: dict[str, tuple[int, tuple[str, ...], tuple[str, ...]]] = {START: (0, (), (START,))}
    for cell in cells:
        after: dict[str, tuple[int, tuple[str, ...], tuple[str, ...]]] = {}
        for (p, q), found in zip(NONTERMINALS, cell):
            if found is not None and p in reached:
                cost, pieces, way = reached[p]
                option = (cost + found[0], (*pieces, found[1]), (*way, q))
                if q not in after or _whole(option) < _whole(after[q]):
                    after[q] = option
        reached = after
    cost, pieces, way = min((reached[j] for j in FINAL if j in reached), key=_whole)
    first, last = list(parts["first"]), list(parts["last"])
    between = sum(a + b not in SOUND for a, b in zip(last, first[1:]))
    counts = {name: parts[name].sum() for name in ("blank", "duplicate", "truncated")}
    rows = pd.DataFrame({"conv": parts["conv"], "start": parts["start"]})
    for name, value in (counts | {"illegal": parts["illegal"].sum() + between, "cost": cost}).items():
        rows[name] = pd.array([int(value)] + [None] * (len(rows) - 1), dtype="Int64")
    rows["audit"] = ["".join(pieces)] + [None] * (len(rows) - 1)
    return rows.assign(piece=list(pieces), begin=list(way[:-1]), end=list(way[1:]))[_NAMES(JOINED)]


def _whole(option: tuple[int, tuple[str, ...], tuple[str, ...]]) -> tuple[int, str]:
    return option[0], "".join(option[1])


EDITS = "conv string, start long, line long, role string, at long"


def _edits(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for conv, start, piece, begin, end in zip(*(batch[c] for c in ("conv", "start", "piece", "begin", "end"))):
                for line, at, role in edited(piece, begin, end):
                    yield conv, start, line, role, None if at < 0 else start + at

    return _frames(rows(), EDITS)


def _cut_lines(columns: DataFrame, cut: DataFrame) -> DataFrame:
    """The repaired turns of conversations that may be in several tasks."""
    wanted = cut.select("conv").distinct()
    if cut.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    mine = columns.join(wanted, "conv", "left_semi").select("at", F.col("role").alias("own"), "text")
    edits = cut.select("conv", "start", "piece", "begin", "end").mapInPandas(_edits, EDITS)
    role, text = F.coalesce("role", "own").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    return edits.join(mine, "at", "left").select("conv", "start", "line", role, text)


def _digests(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the lines of each conversation, as they come."""
    here, digest, done = None, None, []
    for batch in batches:
        for conv, text in zip(batch["conv"], batch["text"]):
            if conv != here:
                if here is not None:
                    done.append((here, digest.hexdigest()))
                here, digest = conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(text.encode("utf-8", "surrogatepass"))
        yield pd.DataFrame(done, columns=["conv", "found"], dtype=object)
        done = []
    if here is not None:
        yield pd.DataFrame([(here, digest.hexdigest())], columns=["conv", "found"])


def damaged(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The rows with planted faults, by a checksum of conversation and turn; NULLs in it count as one space."""
    part = lambda name: F.coalesce(named(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part(conv_col), F.lit(":"), part(turn_col)).cast("binary")) % 20
    role, text = (F.coalesce(named(name), F.lit(" ")) for name in (role_col, text_col))
    return (
        conversations.select(
            named(conv_col).alias(conv_col), named(turn_col).alias(turn_col), role.alias(role_col), text.alias(text_col),
            fault.alias("_fault"),
        )
        .filter("_fault <> 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("_fault") == 3, 2).otherwise(1))))
        .select(
            named(conv_col).alias(conv_col),
            named(turn_col).alias(turn_col),
            F.when(F.col("_fault") == 4, "user").otherwise(named(role_col)).alias(role_col),
            F.when(F.col("_fault") == 1, "")
            .when(F.col("_fault") == 2, F.translate(named(text_col), ENDS, ""))
            .otherwise(named(text_col))
            .alias(text_col),
        )
    )
