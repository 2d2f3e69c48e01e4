import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfrank.llm.perfect_hash import PerfectHash, fingerprints
from shelfrank.llm.queries import QUERIES
from shelfrank.llm.token_files import TokenReader, read_token_files, write_token_files
from shelfrank.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"
ROWS = [
    (5, "Hello, World"), (None, "no key"), (-3, ""), (5, "Hello, World"), (5, None), (2**62, "long words " * 3000), (None, None),
    (-(2**63), "first <|endoftext|>"), (0, "ñ 日本語 😀"), *((i, f"text {i}") for i in range(100, 400)),
]


def expected(rows):
    """(doc_id, start, n_tokens, crc) by the plain tokenizer; rows of one key in any order."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [(k, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for k, t in rows]


def by_order(key):
    return (key is not None, key or 0)


@pytest.mark.parametrize("count", [0, 1, 2, 63, 5000])
def test_numbers_are_minimal_and_perfect(count):
    keys = np.random.default_rng(count).integers(0, 2**63, count).astype(np.uint64)
    assert sorted(PerfectHash.build(keys)(keys).tolist()) == list(range(count))


def test_repeated_keys_are_refused():
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([1, 1], dtype=np.uint64))


def test_strangers_fail_the_fingerprint():
    keys, others = np.arange(10_000, dtype=np.uint64), np.arange(10_000, 60_000, dtype=np.uint64)
    hashed = PerfectHash.build(keys)
    stored = np.zeros(len(keys), np.uint32)
    stored[hashed(keys)] = fingerprints(keys)
    number = hashed(others)
    assert not (stored[number[number >= 0]] == fingerprints(others[number >= 0])).any()


@pytest.mark.parametrize(("shard_ids", "part_keys"), [(1 << 26, 1 << 16), (50, 20)])
def test_round_trip(spark, shard_ids, part_keys):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in ROWS], "doc_id long, text string, shard string, part int").repartition(3)
    path = scratch_path(spark, "token-files")
    write_token_files(docs, TOKENIZER, path, shard_ids, part_keys)
    asked = spark.createDataFrame([(k, 1) for k, _ in ROWS] + [(77, 1), (99_999, 1)], "doc_id long, start int")
    rows = read_token_files(spark, path, asked).collect()
    told = expected(ROWS)
    assert sorted([(r["doc_id"], r["n_tokens"], zlib.crc32(r["ids"])) for r in rows], key=str) == sorted(
        [(k, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, ids in told], key=str
    )
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert keys == sorted(keys, key=by_order)

    reader = TokenReader(path)
    for key in {k for k, _ in ROWS}:
        assert sorted(x.tolist() for x in reader[key]) == sorted(ids for k, ids in told if k == key)
    assert reader[77] == []


def test_a_frequent_key_spans_shards(spark):
    docs = spark.createDataFrame([(7, f"copy {i}") for i in range(6000)] + [(8, "last")], "doc_id long, text string")
    path = scratch_path(spark, "token-files")
    write_token_files(docs, TOKENIZER, path, 200)
    assert spark.read.parquet(f"{path}/shards").count() > 4
    rows = read_token_files(spark, path, docs).collect()
    assert len(rows) == 6001 and sum(r["doc_id"] == 7 for r in rows) == 6000
    assert len(TokenReader(path)[7]) == 6000


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = scratch_path(spark, "token-files")
    write_token_files(docs, TOKENIZER, path)
    assert read_token_files(spark, path, docs).count() == 0
    assert TokenReader(path)[1] == []


def test_query_against_the_plain_tokenizer(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    told, at = {}, 0
    for key, ids in expected(sorted(docs)):
        told[key] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    rows = QUERIES["op13_token_files"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows} == told and len(rows) == len(docs)
