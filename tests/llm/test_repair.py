import hashlib
import random
import re
import zlib
from functools import cache
from itertools import product

import numpy as np
import pytest

import shelfrank.llm.repair as repair
from shelfrank.llm.queries import QUERIES
from shelfrank.llm.repair import AT_END, DUE, KEPT, START, SYMBOLS, costs_to_go, repair_conversations, tables, trace, turns_digest

FOLDER = "/root/testdata/sf0.001"
INITIALS = {0: "", 1: "s", 2: "u", 3: "a"}


def plain(symbols):
    """(cost, least audit) by a plain search over all edits."""

    @cache
    def best(i, state, inserted=0):
        if i == len(symbols):
            if AT_END[state] == 0:
                return 0, ""
            cost, audit = best(i, DUE[state])
            return cost + 3, "I" + audit
        symbol, out = symbols[i], []
        more = 3 if symbol.isupper() else 0
        steps = [("D", 4, i + 1, state, 0)]
        if symbol != "d":
            steps.append(("R", 3 + more, i + 1, DUE[state], 0))
            steps += [("K", more, i + 1, k, 0) for s, k in KEPT[symbol.lower()].items() if s == state]
        if inserted < 3:
            steps.append(("I", 3, i, DUE[state], inserted + 1))
        for letter, price, to, onward, count in steps:
            cost, audit = best(to, onward, count)
            out.append((cost + price, letter + audit))
        return min(out)

    return best(0, START)


def by_blocks(symbols):
    codes = np.array([SYMBOLS.index(s) for s in symbols], dtype=np.int64)
    borders, total = costs_to_go(codes, 0)
    audit, state = trace(symbols, codes, borders, START)
    return total + tables().vectors[borders[0]][START], audit + "I" * (AT_END[state] // 3)


def test_every_short_conversation():
    for n in range(4):
        for symbols in map("".join, product(SYMBOLS, repeat=n)):
            assert by_blocks(symbols) == plain(symbols)


@pytest.mark.parametrize("n", [4, 5, 7, 8, 9, 13, 40])
def test_longer_conversations(n):
    draw = random.Random(n)
    for _ in range(60):
        symbols = "".join(draw.choices(SYMBOLS, k=n))
        assert by_blocks(symbols) == plain(symbols)


def told(rows):
    """Everything the query returns about one conversation, from its rows (turn, role, text) in any order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        said = text.strip(repair.BLANK)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [r[1][:1] if r[1][:1] in ("s", "u", "a") else "o" for r in rows]
    symbols = "".join("d" if f in ("blank", "duplicate") else i.upper() if f else i for f, i in zip(faults, initials, strict=True))
    cost, audit = plain(symbols)
    out, state, at = [], START, 0
    for edit in audit:
        if edit != "I":
            at += 1
        if edit == "D":
            continue
        if edit == "K":
            state = KEPT[symbols[at - 1].lower()][state]
            out.append(f"{rows[at - 1][1]}:{rows[at - 1][2]}")
        else:
            state = DUE[state]
            out.append(("user:" if state == 2 else "assistant:") + ("" if edit == "I" else rows[at - 1][2]))
    assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in out))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def answers(messages):
    repaired = repair_conversations(messages)
    digests = {r["conv_id"]: r["sha256"] for r in turns_digest(repaired.turns).collect()}
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv_id"]: (*(r[c] for c in columns), digests.get(r["conv_id"], empty)) for r in repaired.conversations.collect()}


def grouped(rows):
    out = {}
    for key, *rest in rows:
        out.setdefault(key, []).append(tuple(rest))
    return out


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hi."),
    (2, 0, "user", "Cut off"), (2, 0, "user", "Cut off"), (2, 3, "user", "a."), (2, None, "assistant", " \n"),
    (None, 1, "user", "no id."), (None, 2, "tool", "x."), (None, 2, "", "y.\t"), (None, 9, "assistant", "…"),
    (4, None, "system", "a."), (4, None, "system", "b."), (5, 1, "assistant", ""), (6, 7, "user", "long text " * 5000),
]


def test_small_cases(spark):
    schema = "conv_id long, turn long, role string, text string"
    messages = spark.createDataFrame(ROWS, schema).selectExpr("*", "1 AS place", "'x' AS symbol", "2 AS `first`")
    assert answers(messages) == {k: told(v) for k, v in grouped(ROWS).items()}
    assert answers(spark.createDataFrame([], schema)) == {}


def test_nulls_count_as_empty(spark):
    messages = spark.createDataFrame([(1, 0, None, None), (1, 1, None, "a.")], "conv_id long, turn long, role string, text string")
    assert answers(messages) == {1: told([(0, "", ""), (1, "", "a.")])}


def test_long_conversations_are_cut_into_runs(spark, monkeypatch):
    monkeypatch.setattr(repair, "RUN_BITS", 3)
    draw = random.Random(3)
    rows = [(k, t, draw.choice(["system", "user", "assistant", "tool"]), draw.choice(["a.", "b", "", f"text {t}.", f"cut {t}"])) for k in (1, 2, 3) for t in range(100)]
    rows += [(None, t, "user" if t % 2 else "assistant", f"text {t}.") for t in range(50)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert answers(messages) == {k: told(v) for k, v in grouped(rows).items()}


def damaged(rows):
    for key, turn, role, text in rows:
        dice = zlib.crc32(f"{key}:{turn}".encode()) % 20
        if dice == 0:
            continue
        text = "" if dice == 1 else re.sub("[.!?]", "", text) if dice == 2 else text
        for _ in range(2 if dice == 3 else 1):
            yield key, turn, "user" if dice == 4 else role, text


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {k: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for k in {r[0] for r in rows}}
    expected |= {k: told(v) for k, v in grouped(damaged(rows)).items()}
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    found = QUERIES["op11_repair"](spark, FOLDER).collect()
    assert {r["conv_id"]: tuple(r[n] for n in names) for r in found} == expected and len(found) == len(expected)


def test_damage_of_nulls(spark):
    rows = [(None, None, None, None), (1, None, None, None), (None, 2, "user", "a.")]
    found = repair.damage_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    told_rows = []
    for key, turn, role, text in rows:
        dice = zlib.crc32(f"{' ' if key is None else key}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: "a" if text else " "}.get(dice, text or " ")
        told_rows += [(key, turn, "user" if dice == 4 else role or " ", text)] * {0: 0, 3: 2}.get(dice, 1)
    assert sorted(map(tuple, found), key=str) == sorted(told_rows, key=str)
