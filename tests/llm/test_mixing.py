import pytest
from pyspark.sql import functions as F

from shelfrank.llm.mixing import apply_mix, mix_sources, source_targets

SCHEMA = "doc_id long, text string, source string, of_source string, n_chars long"


def water_levels(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """Targets by rounds: share the rest by weight among the open sources, stop the full ones, again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out, open_ = sum(sizes.values()) * share, {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > epochs * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = epochs * sizes[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 1000, "c": 50, "d": 7, None: 300},
        {"a": 500},
        {"a": 0, "b": 0},
        {"a": 0, "b": 40},
        {"é": 9, "z": 100, "Z": 5000, "": 44},
        {f"s{i}": 100 + i for i in range(20)},
    ],
)
def test_targets_are_the_water_levels(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in source_targets(rows).collect()}
    assert found == pytest.approx(water_levels(sizes))
    assert sum(found.values()) == pytest.approx(1.5 * sum(sizes.values()))


def docs(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 17)), ["a", "b", None][i % 3] if i % 5 else "hot", "x", 0) for i in range(300)]
    rows += [(None, None, "a", "x", 0), (7, "", "b", "x", 0), (None, "one two", None, "x", 0), (8, "twin text", "a", "x", 0), (8, "twin text", "a", "x", 0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_budgets_are_met(spark):
    found = mix_sources(docs(spark)).join(docs(spark).select("doc_id", "source").distinct(), "doc_id", "left")
    rows = mix_sources(docs(spark)).collect()
    assert len(rows) == 305
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    groups = {}
    for r in rows:
        groups.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    for (_, target), taken in groups.items():
        assert target - 2 <= sum(taken) <= target
    assert found.count() >= 305
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mix_sources(docs(spark).repartition(7)).collect()), key=str)


def test_mix_repeats_and_cuts_texts(spark):
    mixed = apply_mix(docs(spark))
    assert mixed.columns == docs(spark).columns
    size = F.size(F.filter(F.split("text", r"[ \t\n]+"), lambda w: w != ""))
    taken = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.sum(size).alias("n")).collect()}
    wanted = {}
    for r in mix_sources(docs(spark)).collect():
        wanted[r["doc_id"]] = wanted.get(r["doc_id"], 0) + r["taken"]
    assert taken == {k: v for k, v in wanted.items() if v}
    assert mixed.where("n_chars <> length(text)").count() == 0


def test_empty_table(spark):
    assert mix_sources(docs(spark).limit(0)).count() == 0
    assert apply_mix(docs(spark).limit(0)).count() == 0
