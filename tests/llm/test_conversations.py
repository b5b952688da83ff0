import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from twinledger.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"
SOUND = re.compile(r"(s?(ua)+)?")
BLANK = " \t\n\x0b\x0c\r"


def faults(rows):
    """The first fault of each row: b, d, t or nothing."""
    seen, found = set(), []
    for _, role, text in rows:
        kind = "b" if not text.strip(BLANK) else "d" if (role, text) in seen else "t" if text.strip(BLANK)[-1] not in ".!?" else ""
        seen.add((role, text))
        found.append(kind)
    return found


def cheapest(rows, kinds):
    """The best (cost, audit, turns) by walking the rows with the state of the pattern."""
    reached = {"": (0, "", ())}  # by the last two initials that count: '', s, u, a
    can = {"": "su", "s": "u", "u": "a", "a": "u"}

    def insert(states):
        for _ in range(3):
            for last, (cost, audit, turns) in list(states.items()):
                for to in can[last].replace("s", ""):
                    new = (cost + 5, audit + "I", (*turns, ({"u": "user", "a": "assistant"}[to], "")))
                    if to not in states or new[:2] < states[to][:2]:
                        states[to] = new
        return states

    for (_, role, text), kind in zip(rows, kinds):
        after = {}
        for last, (cost, audit, turns) in insert(reached).items():
            options = [(last, (cost + 2, audit + "D", turns))]
            extra = 5 * (kind == "t")
            if kind not in ("b", "d"):
                if role[:1] and role[0] in can[last]:
                    options.append((role[0], (cost + extra, audit + "K", (*turns, (role, text)))))
                for to, name in (("u", "user"), ("a", "assistant")):
                    if to in can[last]:
                        options.append((to, (cost + 1 + extra, audit + "R", (*turns, (name, text)))))
            for to, new in options:
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        reached = after
    return min((v for k, v in insert(reached).items() if k in ("", "a")), key=lambda v: v[:2])


def by_trying_all(rows, kinds):
    """The same for few rows by trying every sequence of edits."""
    found = []
    for edits in itertools.product("DKua", repeat=len(rows)):
        for gaps in itertools.product(("", "u", "a", "ua", "au"), repeat=len(rows) + 1):
            cost, audit, initials = 0, "", ""
            for i, gap in enumerate(gaps):
                cost, audit, initials = cost + 5 * len(gap), audit + "I" * len(gap), initials + gap
                if i < len(rows):
                    edit, (_, role, _), kind = edits[i], rows[i], kinds[i]
                    if edit == "D":
                        cost, audit = cost + 2, audit + "D"
                    elif kind in ("b", "d"):
                        break
                    else:
                        cost += 5 * (kind == "t") + (edit != "K")
                        audit += "K" if edit == "K" else "R"
                        initials += role[:1] or "?" if edit == "K" else edit
            else:
                if SOUND.fullmatch(initials):
                    found.append((cost, audit))
    return min(found)


def naive(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    report, turns = [], []
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        kinds = faults(mine)
        cost, audit, kept = cheapest(mine, kinds)
        if len(mine) <= 2:
            assert (cost, audit) == by_trying_all(mine, kinds)
        known = {t for t, _, _ in mine if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:])]
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        report.append((conv, gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit, digest))
        turns += [(conv, *turn) for turn in kept]
    return sorted(report, key=str), turns


def run(spark, rows):
    done = conversations.repair(spark.createDataFrame(rows, SCHEMA))
    turns = [(r.conv_id, r.role, r.text) for r in done.turns.orderBy("conv_id", "line").collect()]
    return sorted(map(tuple, done.report.collect()), key=str), turns


def drawn(seed, convs, most):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "ubik"]
    texts = ["Yes.", "No!", "Why?", "so", "And", "", " \n", None, "é.", "x. \t", "\x0b"] + [f"Line {n}." for n in range(40)]
    rows = []
    for conv in range(convs):
        for turn in range(draw.randrange(1, most)):
            sound = ["user", "assistant"][turn % 2]
            role = sound if draw.random() < 0.6 else draw.choice(roles)
            at = None if draw.random() < 0.05 else turn + draw.randrange(2)
            rows.append((conv, at, role, draw.choice(texts)))
            if draw.random() < 0.1:
                rows.append(rows[-1])
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, convs, most", [(1, 300, 4), (2, 80, 12), (3, 3, 90)])
def test_drawn_conversations(spark, seed, convs, most):
    rows = drawn(seed, convs, most)
    report, turns = naive(rows)
    got, got_turns = run(spark, rows)
    assert got == report
    assert got_turns == sorted(turns, key=lambda r: r[0])


def test_a_conversation_over_all_tasks(spark, monkeypatch):
    rows = [(5, t, ["user", "assistant"][(t + t // 7) % 2], f"Turn {t % 300}{'.' * (t % 11 > 0)}") for t in range(600)]
    report, turns = naive(rows)
    assert run(spark, rows) == (report, turns)
    monkeypatch.setattr(conversations, "HELD_BYTES", 50)
    monkeypatch.setattr(conversations, "BROADCAST_ROWS", 0)
    rows = drawn(4, 20, 30)
    report, turns = naive(rows)
    assert run(spark, rows) == (report, sorted(turns, key=lambda r: r[0]))


def test_long_conversations_take_little_time():
    spans = conversations.Spans()
    for n in range(20_000):
        spans.add(conversations.TURN_CELLS["ua"[n % 3 == 0], False, n % 5 == 0])
    cost, audit = conversations.best(spans.whole())
    assert len(audit.replace("I", "")) == 20_000 and cost > 0


def test_equal_turns_nulls_and_very_long_texts(spark):
    rows = [(1, 0, "user", "Same.")] * 3 + [(1, 1, "assistant", "x" * 300_000 + ".")]
    rows += [(None, None, None, None), (None, 4, "user", "Hi."), (2, None, "system", "Be good."), (2, None, "user", "Same.")]
    report, turns = naive(rows)
    got, _ = run(spark, rows)
    assert got == report


def test_empty_tables_and_other_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho.")], SCHEMA)
    named = df.withColumns({c: F.lit(1) for c in ("conv", "at", "again", "start", "line", "cost", "_fault", "digest")})
    done = conversations.repair(conversations.damaged(named).unionByName(conversations.damaged(df)).distinct())
    assert done.report.count() == 1
    done = conversations.repair(df.filter("turn > 5"))
    assert done.report.collect() == done.turns.collect() == []


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in (None, *range(5))] + [(None, 1, None, None)]
    expected = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        expected += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    got = conversations.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
