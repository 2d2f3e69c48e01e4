"""Expressions over long arrays and texts against plain Python, and that their work does not grow with the square."""

import re
import time

import pytest
from pyspark.sql import functions as F

from shelfrank.llm.arrays import BLOCK, GROUP, bind, blocks, cut, grouped, running
from shelfrank.llm.chat import format_chats, loss_text, text_part
from shelfrank.llm.pii import find_pii, mask_pii


def test_groups_and_running_sums(spark):
    sizes = [0, 1, GROUP - 1, GROUP, GROUP + 1, 3 * GROUP + 7]
    rows = spark.createDataFrame([(n, list(range(n))) for n in sizes], "n int, a array<int>")
    sums = running(F.col("a"), F.lit(0), lambda s, x: (s + x, s + x), "int")
    for r in rows.select("n", "a", grouped(F.col("a")).alias("g"), sums.alias("s")).collect():
        assert [x for g in r["g"] for x in g] == r["a"] and all(len(g) <= GROUP for g in r["g"])
        assert r["s"] == [sum(range(i + 1)) for i in range(r["n"])]


def test_cuts_equal_slices(spark):
    texts = ["", "é", "日𝄞a" * BLOCK, "x\n" * (2 * BLOCK), "y" * BLOCK]
    spans = [(0, 0), (0, 1), (1, 5), (BLOCK - 1, 2), (BLOCK, BLOCK), (5, 3 * BLOCK), (2 * BLOCK + 3, 9 * BLOCK)]
    rows = spark.createDataFrame([(t, s, n) for t in texts for s, n in spans], "t string, s int, n int")
    found = rows.select("t", "s", "n", bind(blocks(F.col("t")), lambda p: cut(p, F.col("s"), F.col("n"))).alias("c"))
    for r in found.collect():
        assert r["c"] == r["t"][r["s"] : r["s"] + r["n"]]


def _seconds(df):
    start = time.monotonic()
    df.write.format("noop").mode("overwrite").save()
    return time.monotonic() - start


@pytest.mark.parametrize("what", ["pii", "chat"])
def test_long_rows_take_time_in_proportion(spark, what):
    def job(n):
        if what == "pii":
            text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("mail é"), i, F.lit("@b.cd 555-123-4567"))))
            return mask_pii(spark.range(1).select("id", text.alias("text")))
        turns = spark.range(n).select(
            F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), text_part(F.lit("é, some words")).alias("parts")
        )
        return format_chats(turns).select(loss_text(F.col("formatted"), F.col("mask")).alias("loss"))

    _seconds(job(500))
    small, large = _seconds(job(10_000)), _seconds(job(40_000))
    # Four times the length; the square would take sixteen times.
    assert large < 8 * small + 2


def test_added_spans_beside_base_spans(spark):
    texts = [
        "call +1 (017) 555-713-4567 or tel 555-123-4567 now", "tel 555-123-4567 " * 600, "IBAN GB82 WEST 1234 5698 7654 32 " * 300,
        "phone 4111 1111 1111 1111 555-123-4567 card", "call 555-123-4567@x.yz",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in find_pii(docs).collect():
        base = [s for s in r["pii"] if s["base"]]
        for s in r["pii"]:
            assert s["base"] or not any(b["start"] < s["end"] and s["start"] < b["end"] for b in base)
        if r["i"] == 1:
            assert [s["start"] for s in r["pii"]] == [m.start() for m in re.finditer("555", texts[1])]
        if r["i"] == 2:
            assert len(r["pii"]) == 300


def test_masks_of_many_spans(spark):
    texts = ["tel 555-123-4567 " * 600, "日本𝄞 a@b.cd, é " * 700, "x" * 5000 + " 10.0.0.1 " + "y" * 5000 + " a@b.cd"]
    masked = ["tel <PHONE> " * 600, "日本𝄞 <EMAIL>, é " * 700, "x" * 5000 + " <IP> " + "y" * 5000 + " <EMAIL>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    assert [r["text"] for r in mask_pii(docs).orderBy("i").collect()] == masked
