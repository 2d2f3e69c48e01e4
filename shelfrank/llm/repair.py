"""Repairing the structure of conversations by cheapest edits, with block tables (the method of the Four Russians).

The roles of a sound conversation are nothing, or perhaps a system turn and then pairs of user and assistant.  Turns
are kept, given another role or deleted, and empty ones inserted.  Read from the end, the cheapest costs to go form a
vector over four states.  Less its smallest entry, such a vector is one of a few dozen, so what a block of
``BLOCK`` turns does to each of them is looked up in a table made once; the cheapest edits are read off
afterwards by expanding the blocks.

A conversation of any length is cut into runs of bounded size.  A run is a matrix of costs between states, runs
are chained by their matrices, and only then is each run traced by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.session import write_table

RUN_BITS = 16
BLOCK = 4
BLANK = " \t\n\x0b\x0c\r"
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: What a turn is to the repair: its role's initial (o: any other), capital if truncated; d must be deleted.
SYMBOLS = "suaoSUAOd"
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a user or assistant turn leads to, whichever is due.
DUE = (USER, USER, ASSISTANT, USER)
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}, "d": {}}
ROLES = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 20
#: Costs of ending in each state: a system turn lacks a pair, a user turn its answer.
AT_END = (0, 2 * INSERT, INSERT, 0)


# Block tables


def _after(vector: tuple[int, ...], symbol: str) -> tuple[int, ...]:
    """Costs to go before a turn from those after it, insertions before the turn included."""
    more = TRUNCATED if symbol.isupper() else 0
    plain = []
    for state, due in enumerate(DUE):
        choices = [DELETE + vector[state]]
        if symbol != "d":
            choices.append(REROLE + more + vector[due])
            if state in (kept := KEPT[symbol.lower()]):
                choices.append(more + vector[kept[state]])
        plain.append(min(choices))
    once = [min(c, INSERT + plain[due]) for c, due in zip(plain, DUE, strict=True)]
    return tuple(min(NEVER, c, INSERT + once[due]) for c, due in zip(once, DUE, strict=True))


def _normal(vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(vector)
    return tuple(c if c >= NEVER else c - least for c in vector), least


@dataclass(frozen=True)
class BlockTables:
    """``step`` and ``added`` for one symbol, ``block`` and ``block_added`` for every word of ``BLOCK`` symbols."""

    vectors: list[tuple[int, ...]]
    number: dict[tuple[int, ...], int]
    step: np.ndarray
    added: np.ndarray
    block: np.ndarray
    block_added: np.ndarray


@cache
def tables() -> BlockTables:
    """All vectors that can come up, found from the costs at the end and from single states, and their transitions."""
    single = [tuple(0 if i == j else NEVER for i in range(4)) for j in range(4)]
    vectors = [_normal(AT_END)[0], *single]
    number = {v: i for i, v in enumerate(vectors)}
    step, added = [], []
    for vector in vectors:  # grows on the way
        found = [_normal(_after(vector, s)) for s in SYMBOLS]
        for v, _ in found:
            if v not in number:
                number[v] = len(vectors)
                vectors.append(v)
        step.append([number[v] for v, _ in found])
        added.append([least for _, least in found])
    step, added = np.array(step), np.array(added)
    # A word's last symbol is read first; the word of one symbol is grown at its front.
    block, block_added = step, added
    for _ in range(BLOCK - 1):
        grown = np.stack([step[block, s] for s in range(len(SYMBOLS))], axis=1)
        costs = np.stack([block_added + added[block, s] for s in range(len(SYMBOLS))], axis=1)
        block, block_added = grown.reshape(len(vectors), -1), costs.reshape(len(vectors), -1)
    return BlockTables(vectors, number, step, added, block, block_added)


def _codes(symbols: str) -> np.ndarray:
    return np.array([SYMBOLS.index(s) for s in symbols], dtype=np.int64)


def costs_to_go(codes: np.ndarray, end: int) -> tuple[list[int], int]:
    """The vectors' numbers at the block borders, first border first, and what was taken off the first in all.

    Blocks are counted from the end; turns before the first whole block form a shorter one.
    """
    t = tables()
    head = len(codes) % BLOCK
    words = codes[head:].reshape(-1, BLOCK) @ (len(SYMBOLS) ** np.arange(BLOCK - 1, -1, -1))
    borders, total, vector = [end], 0, end
    for word in words[::-1].tolist():
        total += int(t.block_added[vector, word])
        vector = int(t.block[vector, word])
        borders.append(vector)
    for code in codes[:head][::-1].tolist():
        total += int(t.added[vector, code])
        vector = int(t.step[vector, code])
    if head:
        borders.append(vector)
    return borders[::-1], total


def trace(symbols: str, codes: np.ndarray, borders: list[int], state: int) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits from a state, and the state they end in.

    Each block is expanded backward from its border to the vectors at its turns; going forward, of the edits that
    cost what the vector says the least letter is taken, so ties never depend on the blocks.
    """
    t = tables()
    out, head = [], len(codes) % BLOCK
    cuts = [0, *([head] if head else []), *range(head + BLOCK, len(codes) + 1, BLOCK)] if len(codes) else [0]
    for low, high, border in zip(cuts[:-1], cuts[1:], borders[1:], strict=True):
        inner, added = [border], []
        for code in codes[low:high][::-1].tolist():
            added.append(int(t.added[inner[-1], code]))
            inner.append(int(t.step[inner[-1], code]))
        inner, added = inner[::-1], added[::-1]
        for i in range(high - low):
            symbol = symbols[low + i]
            here, after, taken = t.vectors[inner[i]], t.vectors[inner[i + 1]], added[i]
            more, kept = TRUNCATED if symbol.isupper() else 0, KEPT[symbol.lower()]
            while True:
                wanted, due = here[state] + taken, DUE[state]
                if wanted == DELETE + after[state]:
                    out.append("D")
                elif here[state] == INSERT + here[due]:
                    out.append("I")
                    state = due
                    continue
                elif state in kept and wanted == more + after[kept[state]]:
                    out.append("K")
                    state = kept[state]
                else:
                    out.append("R")
                    state = due
                break
    return "".join(out), state


# Faults


def damage_turns(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in, decided by the CRC of ``conv_id:turn``: see the query's contract.

    Null roles and texts become one space, as null ids and turns do in what is hashed.  Other columns are left out.
    """
    of = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    dice = F.crc32(F.concat(of[0], F.lit(":"), of[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = messages.select(
        "conv_id",
        "turn",
        F.when(dice == 4, "user").otherwise(role).alias("role"),
        F.when(dice == 1, "").when(dice == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(dice == 0, F.lit(None)).when(dice == 3, F.lit(2)).otherwise(F.lit(1)))).alias("copy"),
    )
    return rows.drop("copy")


def order_turns(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, place), written: ``place`` grows with conversation, turn, role and text.

    Ranges of that order are dealt out, so a long conversation lies on many tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = messages.select("conv_id", F.col("turn").cast("long"), role, text)
    order = ["conv_id", "turn", "role", "text"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return write_table(ordered.withColumn("place", F.monotonically_increasing_id()), "turns")


def mark_faults(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, place, initial, symbol, fault) of ordered turns; ``fault`` is the first of a turn's faults or null."""
    text = F.md5(F.col("text").cast("binary"))
    seen = turns.groupBy("conv_id", "role", text.alias("name")).agg(F.min("place").alias("first_place"))
    # Places are unique on both sides, so a text said very often is no hot key here.
    joined = turns.join(seen.select("first_place"), F.col("place") == F.col("first_place"), "left")
    said = F.rtrim("text", F.lit(BLANK))
    initial = F.left("role", F.lit(1))
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    fault = (
        F.when(said == "", "blank").when(F.col("first_place").isNull(), "duplicate").when(~F.right(said, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    symbol = F.when(fault.isin("blank", "duplicate"), "d").when(fault.isNotNull(), F.upper(initial)).otherwise(initial)
    return joined.select("conv_id", "turn", "place", initial.alias("initial"), symbol.alias("symbol"), fault.alias("fault"))


# Runs


def _runs(marked: DataFrame) -> DataFrame:
    """(conv_id, first, symbols, initials): a conversation's turns in runs of at most 2^RUN_BITS, a letter each."""
    each = F.sort_array(F.collect_list(F.struct("place", "symbol", "initial")))
    runs = marked.groupBy("conv_id", F.shiftright("place", RUN_BITS).alias("stretch")).agg(each.alias("each"))
    # A field of an array of structs is the array of its values.
    letters = [F.array_join(F.col("each")[c], "").alias(f"{c}s") for c in ("symbol", "initial")]
    return runs.select("conv_id", F.col("each")[0]["place"].alias("first"), *letters)


_LEGAL = {"su", "ua", "au"}


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run the costs from each state to each state, row by row, and its pairs of roles that may not follow each other."""
    t = tables()
    single = [t.number[tuple(0 if i == j else NEVER for i in range(4))] for j in range(4)]
    for batch in batches:
        matrix, illegal = [], []
        for symbols, initials in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            codes = _codes(symbols)
            columns = []
            for end in single:
                borders, total = costs_to_go(codes, end)
                columns.append([c if c >= NEVER else c + total for c in t.vectors[borders[0]]])
            matrix.append([columns[j][i] for i in range(4) for j in range(4)])
            illegal.append(sum(a + b not in _LEGAL for a, b in zip(initials[:-1], initials[1:], strict=True)))
        more = [pa.array(matrix, pa.list_(pa.int64())), pa.array(illegal, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=["conv_id", "first", "symbols", "initials", "matrix", "illegal"])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a conversation's runs in order: per run the costs to go at its end, whether it is last, cost and illegal pairs."""
    names = ["first", "to_go", "opens", "closes", "cost", "illegal"]
    for batch in batches:
        rows = []
        for runs in batch.column(0).to_pylist():
            to_go = list(AT_END)
            for i in range(len(runs) - 1, -1, -1):
                run, m = runs[i], runs[i]["matrix"]
                before = [min(m[4 * s + j] + to_go[j] for j in range(4)) for s in range(4)]
                border = i > 0 and runs[i - 1]["tail"] + run["head"] not in _LEGAL
                cost = before[START] if i == 0 else 0
                rows.append((run["first"], to_go, i == 0, i == len(runs) - 1, cost, run["illegal"] + border))
                to_go = before
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _trace_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run and start state (of a first run only the start) the state it ends in and its edits."""
    t = tables()
    kind = pa.list_(pa.struct([("state", pa.int32()), ("audit", pa.string())]))
    for batch in batches:
        traced = []
        for symbols, to_go, opens, closes in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4, 5)), strict=True):
            codes = _codes(symbols)
            borders, _ = costs_to_go(codes, t.number[_normal(tuple(to_go))[0]])
            ends = []
            for start in range(1 if opens else 4):
                audit, state = trace(symbols, codes, borders, start)
                if closes:
                    audit += "I" * (AT_END[state] // INSERT)
                ends.append({"state": state, "audit": audit})
            traced.append(ends)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(traced, kind)], names=["conv_id", "first", "ends"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a conversation's traced runs in order: per run its start state and edits."""
    for batch in batches:
        rows = []
        for runs in batch.column(0).to_pylist():
            state = START
            for run in runs:
                end = run["ends"][state]
                rows.append((run["first"], state, end["audit"]))
                state = end["state"]
        kinds = [pa.int64(), pa.int32(), pa.string()]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["first", "start", "audit"])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per edit that leaves a turn: its number in the run, the place of the turn kept, the role given."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["first", "number", "turn_place", "edit", "given"]
    for batch in batches:
        for run in range(batch.num_rows):
            first, state, audit, symbols = (batch.column(c)[run].as_py() for c in range(4))
            rows, at = [], 0
            for number, edit in enumerate(audit):
                place = None if edit == "I" else first + at
                at += edit != "I"
                if edit == "D":
                    continue
                state = KEPT[symbols[at - 1].lower()][state] if edit == "K" else DUE[state]
                rows.append((first, number, place, edit, None if edit == "K" else ROLES[state]))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


@dataclass(frozen=True)
class Repair:
    """``conversations``: conv_id, the counts of faults, cost and audit; ``turns``: conv_id, run, number, edit, role, text."""

    conversations: DataFrame
    turns: DataFrame


def repair_conversations(messages: DataFrame) -> Repair:
    """Repair conversations of rows (conv_id, turn, role, text).

    Turns stand in the order of turn, null first; equal turns by role, then text.  Null roles and texts count as
    empty; a null conv_id is a conversation.  A text of white space is blank; a role and text
    said before in the conversation is a duplicate; a text that ends in none of ``.!?`` is truncated.  Blank and
    duplicate turns are deleted.  An empty table gives no rows; other columns are ignored.

    ``gaps`` counts the turn numbers missing between the first and the last.  ``run`` and ``number`` order the repaired turns of a conversation.
    """
    turns = order_turns(messages)
    marked = write_table(mark_faults(turns), "marked-turns")
    counts = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    kind = marked.schema["conv_id"].dataType.simpleString()
    runs = _runs(marked).mapInArrow(
        _matrices, f"conv_id {kind}, first long, symbols string, initials string, matrix array<long>, illegal long"
    )
    runs = write_table(runs, "turn-runs")
    ends = F.struct("first", "matrix", "illegal", F.left("initials", F.lit(1)).alias("head"), F.right("initials", F.lit(1)).alias("tail"))
    chained = runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(ends)).alias("runs")).select("runs")
    chained = chained.mapInArrow(_chain, "first long, to_go array<long>, opens boolean, closes boolean, cost long, illegal long")
    chained = write_table(chained, "chained-runs")
    asked = runs.select("conv_id", "first", "symbols").join(chained.select("first", "to_go", "opens", "closes"), "first")
    asked = asked.select("conv_id", "first", "symbols", "to_go", "opens", "closes")
    traced = asked.mapInArrow(_trace_runs, f"conv_id {kind}, first long, ends array<struct<state:int,audit:string>>")
    walked = traced.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("first", "ends"))).alias("runs")).select("runs")
    walked = write_table(walked.mapInArrow(_walk, "first long, start int, audit string"), "walked-runs")

    known = runs.select("conv_id", "first", "symbols")
    figures = known.drop("symbols").join(chained.select("first", "cost", "illegal"), "first").join(walked.select("first", "audit"), "first")
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("first", "audit"))), lambda x: x["audit"]), "")
    figures = figures.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"), audit.alias("audit"))
    found = counts.join(figures.withColumnRenamed("conv_id", "of_conv"), F.col("conv_id").eqNullSafe(F.col("of_conv")))

    edits = walked.join(known, "first").select("first", "start", "audit", "symbols")
    edits = edits.mapInArrow(_apply, "first long, number long, turn_place long, edit string, given string")
    said = turns.select(F.col("place").alias("turn_place"), "role", "text")
    left = edits.join(known.select("first", "conv_id"), "first").join(said, "turn_place", "left")
    repaired = left.select(
        "conv_id", F.col("first").alias("run"), "number", "edit", F.coalesce("given", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return Repair(found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), repaired)


def turns_digest(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of repaired turns: ``role:text`` of each, joined by line feeds, as lowercase hex.

    A digest has to see a conversation from end to end, so one task reads it, turn by turn, and holds one batch of it.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        under_way, started, digest = None, False, None
        for batch in batches:
            done_ids, done = [], []
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if started and key == under_way:
                    digest.update(b"\n")
                else:
                    if started:
                        done_ids.append(under_way)
                        done.append(digest.hexdigest())
                    under_way, started, digest = key, True, hashlib.sha256()
                digest.update(line.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done_ids, batch.column(0).type), pa.array(done, pa.string())], names=["conv_id", "sha256"])
            ids = batch.column(0).type
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([under_way], ids), pa.array([digest.hexdigest()])], names=["conv_id", "sha256"])

    line = F.concat("role", F.lit(":"), "text").alias("line")
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "run", "number").select("conv_id", line)
    return ordered.mapInArrow(digest, f"conv_id {kind}, sha256 string")
