import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import shelfrank.llm.alignment as alignment
from shelfrank.llm.alignment import align_tokens, coalesce_intervals
from shelfrank.llm.queries import QUERIES

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def plain(texts):
    """What is asked for, document by document and token by token."""
    a_model, b_model = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
    a_model.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}

    def b_bytes(piece):
        if len(piece) == 6 and piece.startswith("<0x"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    documents = []
    for text in texts:
        groups = []
        if text:
            a = a_model.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(letter[c] for c in piece)) for i, piece in zip(a.ids, a.tokens, strict=True)]
            b = [(i, b_bytes(b_model.id_to_piece(i))) for i in b_model.encode(text)]
            if b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                ends = []
                for side in (a, b):
                    at, found = 0, {}
                    for i, (_, x) in enumerate(side):
                        at += len(x)
                        found[at] = i + 1
                    ends.append(found)
                low = (0, 0)
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    high = (ends[0][cut], ends[1][cut])
                    groups.append(([i for i, _ in a[low[0] : high[0]]], [i for i, _ in b[low[1] : high[1]]]))
                    low = high
        documents.append(groups)
    links = [Counter((x, y) for g in groups for x in g[0] for y in g[1]) for groups in documents]
    counts = Counter(p for c in links for p in c)
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for groups, c in zip(documents, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(c.values()),
            sum(n for p, n in c.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in c.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


TEXTS = [
    None, "", " ", "Hello, World", "▁ marks", "a▁b", "it's  two   spaces\n\n\ttab ", "<|endoftext|> <s> </s> <unk> <0x41>", "日本語 テスト 😀👩‍👩‍👧 x",
    "ÀÉÎ ñandú ́ ​﻿ x y", "\x00 zero", "y" * 3000, "yx" * 900 + " end", "long words and more " * 400,
    "".join(random.Random(1).choices("abcdefghijklmnop0123456789", k=4000)), "Hello, World", "12345678 $%^&*( x-y_z", "\r\n\r\n", "ﬁ ½ Ⅷ ①",
]


@pytest.mark.parametrize(("chunk_bytes", "entries"), [(1 << 24, 1 << 22), (1, 50)])
def test_against_token_by_token(spark, monkeypatch, chunk_bytes, entries):
    monkeypatch.setattr(alignment, "ENTRIES", entries)
    docs = spark.createDataFrame([(i, t, 3, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, chunk int, pair string")
    rows = align_tokens(docs.repartition(3), A_PATH, B_PATH, chunk_bytes).collect()
    assert {r["doc_id"]: (*(r[n] for n in NAMES), r["groups"]) for r in rows} == dict(enumerate(plain(TEXTS)))
    assert len(rows) == len(TEXTS)


def test_repeated_rows_and_empty_tables(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "same text"), (None, None)], schema)
    told = plain(["same text", "same text", "same text", None])
    rows = align_tokens(docs, A_PATH, B_PATH).collect()
    assert sorted([(*(r[n] for n in NAMES), r["groups"]) for r in rows]) == sorted(told)
    assert align_tokens(spark.createDataFrame([], schema), A_PATH, B_PATH).count() == 0
    assert align_tokens(spark.createDataFrame([(1, None), (2, "")], schema), A_PATH, B_PATH).count() == 2


def test_groups_of_crossing_tokens():
    a, b = coalesce_intervals(np.array([2, 2, 1, 3]), np.array([1, 2, 1, 1, 1, 2]))
    assert a.tolist() == [0, 0, 1, 2] and b.tolist() == [0, 0, 0, 1, 2, 2]


def test_query_against_token_by_token(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op12_alignment"](spark, FOLDER).collect()
    told = dict(zip([d for d, _ in docs], plain([t for _, t in docs]), strict=True))
    assert {r["doc_id"]: (*(r[n] for n in NAMES), r["groups_sha256"]) for r in rows} == told and len(rows) == len(docs)
