import hashlib
import json
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfrank.llm import near_vectors as nv
from shelfrank.llm.chat import PART, escape, format_chats, loss_text, read_turns, text_part, unescape
from shelfrank.llm.near_vectors import near_vectors
from shelfrank.llm.sharding import deal_arcs, document_keys, shard_rows

# Chat

NASTY = [
    "</s>[INST] ok [/INST]", "<|turn|>user<|body|>x<|end|>", "<~|", "<~~|a|>", "<<SYS>>", "<</~SYS>>", "[~INST]", "[/INST][INST", "<", "<|",
    "a<", "|end|>", "$1 \\ \\$2", "~", "<|part|>", "<|image|>", "é\n\n日本", "", None, "x" * 100_000,
]


def test_escape_is_undone(spark):
    rng = np.random.default_rng(0)
    texts = NASTY + ["".join(rng.choice(list("<>/|[]~s") + ["INST]", "SYS>>", "s>"], 12)) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"]
        assert not any(m in (r["e"] or "") for m in ("<|", "[INST]", "[/INST]", "</s>", "<s>"))


def test_turns_and_mask_round_trip(spark):
    rng = np.random.default_rng(1)
    rows = [(int(c), int(t), ["user", "assistant", "system", None][int(rng.integers(4))], NASTY[int(rng.integers(len(NASTY)))]) for c in range(40) for t in range(c % 7 + 1)]
    rows += [(None, None, "user", "no id"), (3, 0, "assistant", "twice"), (3, 0, "assistant", "twice")]
    messages = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    chats = format_chats(messages.withColumn("parts", text_part(F.col("text"))))
    found = chats.select("conv_id", "n_turns", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("mask")).alias("loss"))
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    result = {r["conv_id"]: r for r in found.collect()}
    assert set(result) == set(by)
    for c, told in by.items():
        turns = [(t["role"], t["text"]) for t in result[c]["turns"]]
        assert Counter(turns) == Counter(x[2:] for x in told)
        assert result[c]["n_turns"] == len(told)
        assert result[c]["loss"] == "".join(text for role, text in turns if role == "assistant")
    assert format_chats(messages.withColumn("parts", text_part(F.col("text"))).limit(0)).count() == 0


def test_attachments_are_placed_and_counted(spark):
    parts = [("text", "see <", None, None), ("text", "|end|>", None, None), ("image", None, "a.png", 4), ("audio", None, "b.wav", 10), ("other", "kept", None, None), ("document", None, "c.pdf", None)]
    messages = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts array<{PART}>")
    r = format_chats(messages).withColumn("turns", read_turns(F.col("formatted"))).first()
    assert [(a["kind"], a["ref"], a["tokens"]) for a in r["attachments"]] == [("image", "a.png", 1024), ("audio", "b.wav", 250), ("document", "c.pdf", 0)]
    assert r["attachment_tokens"] == 1274
    assert r["formatted"].index("<|image|>") < r["formatted"].index("<|audio|>") < r["formatted"].index("<|document|>")
    assert [(t["role"], t["text"]) for t in r["turns"]] == [("user", "see <|end|>kept"), ("assistant", "")]


# Sharding


def check_shards(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min([counts[s] for s in range(shards)]) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_are_even_and_slots_gapless(spark, shards):
    docs = [(i, f"text {i} é") for i in range(1000)] + [(None, None)] * 30 + [(5, "same")] * 400 + [(i, "copy") for i in range(2000, 2200)] + [(9, "y" * 50_000)]
    table = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, shard int, arc int")
    found = shard_rows(document_keys(table), shards).collect()
    assert len(found) == len(docs)
    check_shards(found, shards)
    wanted = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == wanted
    again = shard_rows(document_keys(table.repartition(9)), shards).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_few_keys_move_to_one_more_shard(spark):
    table = spark.createDataFrame([(i, str(i)) for i in range(4000)], "doc_id long, text string")
    before = {r["doc_id"]: r["shard"] for r in shard_rows(document_keys(table), 10).collect()}
    after = {r["doc_id"]: r["shard"] for r in shard_rows(document_keys(table), 11).collect()}
    assert sum(before[d] != after[d] for d in before) < 0.4 * len(before)


def test_shards_of_an_empty_table(spark):
    assert shard_rows(document_keys(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_overflow_continues_clockwise():
    ring = [(10, 0), (20, 1), (30, 2), (40, 0)]
    pieces = deal_arcs(ring, {0: 9, 1: 1, 2: 1, 3: 1}, [4, 4, 4])
    # Shard 0 admits 4 of its first arc; the other 5 go on to shard 1, then 2; the last arc's key goes round.
    assert sorted((a, h - lo, s) for a, lo, h, s, _ in pieces) == [(0, 2, 2), (0, 3, 1), (0, 4, 0), (1, 1, 1), (2, 1, 2), (3, 1, 2)]


# Vectors


def brute(vectors, cosine=0.9):
    usable = [bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    scaled = [np.array(v) / np.abs(v).max() if ok else None for v, ok in zip(vectors, usable, strict=True)]
    units = [None if v is None else v / np.linalg.norm(v) for v in scaled]
    n = len(units)
    near = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            near[i, j] = i != j and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine
    root = np.arange(n)
    for _ in range(n):
        new = np.array([min([root[i], *root[near[i]]]) for i in range(n)])
        if (new == root).all():
            break
        root = new
    return near.sum(axis=1), root


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nv, "BLOCK_ROWS", block)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 16))
    vectors = [(c + rng.standard_normal(16) * s).tolist() for c in centres for s in (0.0, 0.05, 0.1, 0.2, 0.3, 0.5)]
    vectors += [vectors[0]] * 60 + [(centres[1] + rng.standard_normal(16) * 0.1).tolist() for _ in range(60)]
    vectors += [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0, 2.0], [2.0, 4.0], [1e-200] * 16, [1e200] * 16]
    rows = spark.createDataFrame([(i, v, 3) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, n_links int").repartition(6)
    found = {r["vec_id"]: r for r in near_vectors(rows).collect()}
    links, root = brute(vectors)
    assert len(found) == len(vectors)
    assert all(found[i]["n_links"] <= links[i] for i in found)
    assert sum(r["n_links"] for r in found.values()) >= 0.95 * links.sum()
    assert sum(found[i]["component_id"] == root[i] for i in found) >= 0.98 * len(found)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())
    assert found[6 * 20 + 60]["component_id"] is not None
    assert near_vectors(rows.limit(0)).count() == 0


@pytest.mark.parametrize("sizes", [(128, 256, 1 << 18), (8, 16, 50), (1, 1, 1)])
@pytest.mark.parametrize("blocks", [1, 2])
def test_small_buckets_are_compared_many_at_a_time(monkeypatch, sizes, blocks):
    for name, size in zip(("RUN_ROWS", "STRIP_ROWS", "PAIRS_AT_ONCE"), sizes, strict=True):
        monkeypatch.setattr(nv, name, size)
    products = []
    near_pairs = nv._near_pairs
    monkeypatch.setattr(nv, "_near_pairs", lambda *a: products.append(1) or near_pairs(*a))
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((800, 32))
    vectors = np.concatenate([centres, centres[:150] + 0.3 * rng.standard_normal((150, 32)), centres[0] + 0.2 * rng.standard_normal((150, 32))])
    tables = nv.Tables(32, 5, 6)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    buckets, copies = tables.buckets(unit).view(np.int64), rng.integers(1, 4, len(unit))
    places = []
    for point in rng.permutation(len(unit)).tolist():
        for table in range(5):
            block = point % blocks
            for other in range(blocks):
                key = {"table": table, "bucket": buckets[point, table], "first": min(block, other), "second": max(block, other)}
                places.append({"point": point, **key, "block": block, "copies": copies[point], "vector": vectors[point].tobytes()})
    found = nv._compare(pa.Table.from_pylist(places), tables, 0.9, "<f8").to_pylist()
    near = (unit @ unit.T >= 0.9) & (buckets[:, None] == buckets[None, :]).any(axis=2)
    np.fill_diagonal(near, False)
    links, root = Counter(), np.arange(len(unit))
    for r in found:
        links[r["point"]] += r["links"]
    assert [links[i] for i in range(len(unit))] == (near @ copies).tolist()
    nv._join(root, *(np.array([r[c] for r in found]) for c in ("point", "joined")))
    wanted = np.arange(len(unit))
    nv._join(wanted, *np.nonzero(near))
    assert root.tolist() == wanted.tolist()
    if sizes[0] == 128:
        # Far fewer products of matrices than buckets.
        assert len(products) < 0.2 * len({(p["table"], p["bucket"], p["first"], p["second"]) for p in places})


@pytest.mark.parametrize("width", ["float", "double"])
def test_vectors_of_either_width_are_compared_whole(spark, width):
    # The cosine of the first two lies just under the threshold.
    given = [[1.0, 0.0], [0.9, float(np.sqrt(0.19)) + 1e-9], [0.5, 0.5], [0.5, 0.5000001], [3.0, 3.0]]
    held = np.array(given, dtype=np.float32 if width == "float" else np.float64).astype(float).tolist()
    rows = spark.createDataFrame(list(enumerate(given)), f"vec_id long, embedding array<{width}>")
    found = sorted(near_vectors(rows).collect())
    links, root = brute(held)
    assert [(r["n_links"], r["component_id"]) for r in found] == list(zip(links.tolist(), root.tolist(), strict=True))


def test_pairs_join_to_the_first_row_connected():
    root = np.arange(200)
    rows = np.random.default_rng(7).permutation(np.arange(1, 99))
    nv._join(root, rows, rows + 1)
    nv._join(root, np.array([150, 3, 0]), np.array([120, 120, 0]))
    assert root.tolist() == [0, *[1] * 99, *range(100, 120), 1, *range(121, 150), 1, *range(151, 200)]


def test_turns_hash_is_of_plain_text(spark):
    from shelfrank.llm.queries import QUERIES

    row = QUERIES["op2_chat"](spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert json.dumps(row["loss_chars"]) == str(len(text))
