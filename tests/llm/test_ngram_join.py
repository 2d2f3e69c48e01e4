import re

import numpy as np
import pyarrow as pa
import pytest

from shelfrank.llm import ngram_join
from shelfrank.llm.components import connected_components
from shelfrank.llm.ngram_join import PrefixTree, drop_copies, jaccard_groups, ngram_sets, segment_keys
from shelfrank.llm.text import SpanHasher, slices

SCHEMA = "doc_id long, text string, component_id string, set_key string, gone_id long"


def brute_force(rows):
    sets = []
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        grams = {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} - {()}
        sets.append((doc, grams))
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, grams) in enumerate(sets):
        if doc is not None and grams:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(
        ((doc, len(grams), least.get(find(i)) if grams else doc) for i, (doc, grams) in enumerate(sets)), key=str
    )


def edited(rng, words, edits):
    words = list(words)
    for at in rng.choice(len(words), size=min(edits, len(words)), replace=False):
        words[at] = f"n{rng.integers(1 << 30)}"
    return " ".join(words)


def some_texts():
    rng = np.random.default_rng(3)
    shared = [f"s{i}" for i in range(60)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one two"), (5, "ONE two"), (6, "ein Wort mehr"), (None, "one two")]
    for _ in range(40):
        base = [f"w{rng.integers(1 << 30)}" for _ in range(int(rng.integers(3, 260)))] + shared[: rng.integers(0, 60)]
        for edits in (0, 1, 2, 3, 5, 8):
            rows.append((len(rows) + 100, edited(rng, base, edits)))
        rows.append((len(rows) + 100, " ".join(base[: max(1, int(len(base) * 0.92))])))
    rows += [(len(rows) + 100, "long " * 3000 + "x y z"), (None, None), rows[-1], rows[20]]
    return rows


@pytest.fixture(params=[None, 600], ids=["whole clusters", "blocks"])
def block_size(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(ngram_join, "BLOCK_NGRAMS", request.param)


def test_groups_equal_brute_force(spark, block_size):
    rows = some_texts()
    docs = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in rows], SCHEMA).repartition(5)
    found = sorted((tuple(r) for r in jaccard_groups(docs).collect()), key=str)
    assert found == brute_force(rows)


def test_drop_copies_keeps_one_of_each_group(spark):
    rows = some_texts()
    docs = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in rows], SCHEMA)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    wanted = {c for d, _, c in brute_force(rows) if d is not None}
    assert {r["doc_id"] for r in kept.collect()} - {None} == wanted


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert jaccard_groups(docs).count() == 0
    assert drop_copies(docs).count() == 0


def test_linked_sets_share_a_segment():
    rng = np.random.default_rng(8)
    for size in [*range(9, 60), 99, 100, 101, 333, 1000, 5000]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 1 << 63, size * 2, dtype=np.uint64))[:size]
            most = 2 * size * 10 // 190
            drop = int(rng.integers(0, most + 1))
            add = most - drop
            b = np.unique(np.concatenate([np.delete(a, rng.choice(len(a), drop, replace=False)), rng.integers(0, 1 << 63, add, dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if common * 100 >= 90 * (len(a) + len(b) - common) and len(a) != common:
                assert set(segment_keys(a).tolist()) & set(segment_keys(b).tolist())


def test_prefix_tree_finds_the_groups(monkeypatch):
    monkeypatch.setattr(ngram_join, "LOOKUP_BYTES", 20_000)
    texts = [" ".join(map(str, np.random.default_rng(i // 7).permutation(80)[: 78 - i % 7])) for i in range(70)]
    _, _, data, offsets = next(slices(pa.array(texts)))
    sets = sorted(ngram_sets(data, offsets, SpanHasher()), key=lambda s: s.astype(">u8").tobytes())
    labels = np.arange(len(sets))
    PrefixTree(sets).links(labels)
    same = labels[:, None] == labels[None, :]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            common = len(np.intersect1d(a, b))
            if 100 * common >= 90 * (len(a) + len(b) - common):
                assert same[i, j]
    assert len(set(labels.tolist())) == 10


@pytest.mark.parametrize(
    "edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(5, i) for i in range(30)], [(9, 4), (4, 7), (1, 2), (2, 1), (100, 3)]]
)
def test_components(spark, edges):
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = {}
    for a, b in edges:
        if a != b:
            merged = groups.get(a, {a}) | groups.get(b, {b})
            for n in merged:
                groups[n] = merged
    assert found == {n: min(g) for n, g in groups.items()}


def test_copies_go_by_row(spark):
    """Of two texts under one doc_id only the copy of a smaller one goes."""
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, a), (5, a), (5, b), (None, a), (None, None), (7, ""), (None, "a text of its own"), (9, b), (9, b)]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, gone_id int")
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    told = [(1, a), (5, b), (None, None), (7, ""), (None, "a text of its own")]
    assert sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=str) == sorted(told, key=str)
    assert drop_copies(docs.limit(0)).count() == 0
