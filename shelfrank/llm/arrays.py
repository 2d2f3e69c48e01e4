"""Column expressions over long arrays and texts whose work grows with the length, not with its square.

Spark evaluates an expression inside a lambda again for every element, copies an array that grows by one
element, and finds a place in a text by walking from its beginning.  ``bind``, ``running`` and ``cut``
avoid one of these each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that are appended one by one before a full group is put aside.
GROUP = 256
#: Code points in a block of a text.
BLOCK = 512


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often and in whatever lambda the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def grouped(items: Column) -> Column:
    """Runs of up to ``GROUP`` elements, in order; one empty run of an empty array."""

    def cut_up(array):
        last = F.greatest(F.floor((F.size(array) - 1) / GROUP), F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(array, i * GROUP + 1, GROUP))

    return bind(items, cut_up)


def running(items: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """What ``step`` emits for each element, as an array of SQL type ``kind``.

    ``step`` takes the state and an element and returns the next state and the emitted value.
    """
    none = F.expr(f"cast(array() as array<{kind}>)")
    no_groups = F.expr(f"cast(array() as array<array<{kind}>>)")

    def add(acc, x):
        after, value = step(acc["state"], x)
        return F.struct(after.alias("state"), F.concat(acc["out"], F.array(value)).alias("out"))

    def add_group(acc, group):
        done = F.aggregate(group, F.struct(acc["state"].alias("state"), none.alias("out")), add)
        return bind(done, lambda d: F.struct(d["state"].alias("state"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

    start = F.struct(state.alias("state"), no_groups.alias("out"))
    return F.flatten(F.aggregate(grouped(items), start, add_group)["out"])


def blocks(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` code points, the last one shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}+"), F.lit(0))


def cut(parts: Column, start: Column, length: Column) -> Column:
    """The substring of a text given in blocks, ``start`` counted from 0; work grows with ``length`` and a block."""
    first = F.floor(start / BLOCK).cast("int")
    count = F.floor((start + length) / BLOCK).cast("int") - first + 1
    near = F.array_join(F.slice(parts, first + 1, count), "")
    return F.substring(near, start - first * BLOCK + 1, length)
