import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import check
import corpus_pipeline
from shelfrank.llm.packing import LENGTH, pack_documents
from shelfrank.llm.queries import ORACLES, QUERIES
from shelfrank.session import write_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " ", "Hello, World", "it's DON'T we'll x'y", "<|endoftext|> <|startoftext|>a<|x|>", "É́ H̱a tis …“q” İSTANBUL ΣΑΣ ñÑ̀", "日本語 テスト 😀x",
    "a\x1cb\x85c d e", "12,3.4%%%$$$ x###", "long words " * 6000, "y" * 5000, *(f"number {i} of some texts" for i in range(60)),
]


def check_pieces(rows, texts):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
        pieces.setdefault(r["doc_id"], []).append(r)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= LENGTH
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], dtype="<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids)
    return len(sequences)


@pytest.mark.parametrize("shard_tokens", [1 << 20, 9000])
def test_pieces_hold_every_id_once(spark, shard_tokens):
    texts = dict(enumerate(TEXTS))
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts.items()], "doc_id long, text string, shard int, ids string").repartition(4)
    rows = pack_documents(docs, TOKENIZER, shard_tokens).collect()
    total = sum(r["length"] for r in rows)
    used = check_pieces(rows, texts)
    if shard_tokens > total:
        assert used == -(-total // LENGTH)


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same"), (None, "none"), (None, None)], "doc_id long, text string")
    rows = pack_documents(docs, TOKENIZER).collect()
    assert sorted((str(r["doc_id"]), r["length"]) for r in rows) == [("1", 2), ("1", 2), ("None", 1), ("None", 2)]
    assert pack_documents(docs.limit(0), TOKENIZER).count() == 0


def test_neighbours_share_a_window(spark):
    """Texts of two vocabularies: windows hold one of them where they can."""
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(f"{'abc'[i % 3]}{k}" for k in rng.integers(0, 40, 120))) for i in range(240)]
    found = pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER).collect()
    kinds = {}
    for r in found:
        kinds.setdefault(r["sequence_id"], set()).add(r["doc_id"] % 3)
    assert sum(len(k) for k in kinds.values()) <= len(kinds) + 6


def test_neighbours_meet_in_many_shards(spark):
    """Texts of 30 topics in some 40 shards, copies far apart in the table: windows hold few topics, copies share a shard."""
    rng = np.random.default_rng(4)
    words = np.array(["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(900)]).reshape(30, 30)
    common = [f"common{k}" for k in range(40)]
    rows = [(i, " ".join([*rng.choice(words[i % 30], 120), *rng.choice(common, 60)])) for i in range(1200)]
    rows += [(i + 1200, t) for i, t in rows[:60]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = pack_documents(docs, TOKENIZER, 20_000).collect()
    check_pieces(found, dict(rows))
    topics, where = {}, {}
    for r in found:
        topics.setdefault(r["sequence_id"], set()).add(r["doc_id"] % 1200 % 30)
        where.setdefault(r["doc_id"], set()).add(r["sequence_id"])
    assert sum(r["length"] for r in found) > 20 * 20_000
    assert sum(len(t) for t in topics.values()) <= 2 * len(topics)
    assert sum(bool(where[i] & where[i + 1200]) for i in range(60)) >= 40


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, write_table(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        ids, kept = ({r["doc_id"] for r in d.select("doc_id").collect()} for d in (before, docs))
        assert kept <= ids
        if name == "language":
            assert len(kept) >= 0.99 * len(ids)
        if name == "near_copies":
            groups = QUERIES["op1_ngram_join"](spark, FOLDER).collect()
            assert kept == {r["component_id"] for r in groups} & ids
        if name == "personal_data":
            assert docs.where("text rlike '[a-z]@[a-z]+[.][a-z]'").isEmpty()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r["doc_id"] for r in packed} == kept


def test_the_language_stage_changes_no_other_column(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("*", "7.0 AS score", "'x' AS lang_pred", "1 AS ambiguous", "2 AS `row`")
    kept = corpus_pipeline.identify_language(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.select("score", "lang_pred", "ambiguous", "row").collect()} == {(7.0, "x", 1, 2)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    assert check.compare(QUERIES[name](spark, FOLDER), con.sql(ORACLES[name])).startswith("ok")
