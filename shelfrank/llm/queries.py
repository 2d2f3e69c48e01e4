"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from shelfrank.llm.alignment import align_tokens
from shelfrank.llm.chat import format_chats, loss_text, read_turns, text_part
from shelfrank.llm.html_text import extract_text
from shelfrank.llm.language import identify_languages
from shelfrank.llm.mixing import mix_sources
from shelfrank.llm.near_vectors import near_vectors
from shelfrank.llm.ngram_join import jaccard_groups
from shelfrank.llm.packing import pack_documents
from shelfrank.llm.pii import KINDS, find_pii
from shelfrank.llm.quality import judge_documents
from shelfrank.llm.registry import ORACLES, QUERIES, query, table
from shelfrank.llm.repair import damage_turns, repair_conversations, turns_digest
from shelfrank.llm.sharding import document_keys, shard_rows
from shelfrank.llm.token_files import read_token_files, write_token_files
from shelfrank.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]

OP9_SQL = r"""
WITH d AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           md5('mix-' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
    FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE
           AS weight, source_size * 2.0::DOUBLE AS top FROM s),
r AS (
    SELECT *, top / weight AS full_at, sum(source_size) OVER () * 1.5::DOUBLE AS budget,
           coalesce(sum(top) OVER b, 0) AS spent, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS open
    FROM w WINDOW b AS (ORDER BY top / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max((budget - spent) / open) AS level FROM r WHERE (budget - spent) / open < full_at),
t AS (
    SELECT source, source_size, CAST(coalesce(least(top, level * weight), top) AS DOUBLE) AS target FROM r, l),
p AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
o AS (
    SELECT d.*, p.source_size, p.target, p.whole, CAST(floor(target) AS BIGINT) - whole * p.source_size AS rest,
           sum(size) OVER (PARTITION BY d.source ORDER BY draw, size ROWS UNBOUNDED PRECEDING) - size AS start
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, rest - start)) AS BIGINT) AS taken
FROM o
"""


@query("op9_source_mix", OP9_SQL)
def op9(spark, folder):
    return mix_sources(table(spark, folder, "documents"))


def _listed(spans):
    each = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(each, ",")


@query("op3_pii")
def op3(spark, folder):
    found = find_pii(table(spark, folder, "documents").select("doc_id", "text"))
    found = found.withColumn("base", F.filter("pii", lambda x: x["base"]))

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("pii")).alias("spans"),
    )


CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]

OP2_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
    SELECT *, regexp_replace(text, '(<|</|<<|<</|\[|\[/)(~*)(\||s>|SYS>>|INST\])', '\1~\2\3', 'g') AS safe FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|turn|><|body|><|end|>') + length(role) + length(safe)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op2_chat", OP2_SQL)
def op2(spark, folder):
    told = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    messages = told.unionByName(more)
    chats = format_chats(messages.select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts")))
    chats = chats.withColumns(
        {"turns": read_turns(F.col("formatted")), "loss": loss_text(F.col("formatted"), F.col("mask"))}
    )
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(line, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op7_ring_shards")
def op7(spark, folder):
    dealt = shard_rows(document_keys(table(spark, folder, "documents")))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home_shard",
    )


@query("op6_quality")
def op6(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = judge_documents(docs, table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


@query("op8_language")
def op8(spark, folder):
    return identify_languages(table(spark, folder, "documents"))


@query("op4_html_text")
def op4(spark, folder):
    return extract_text(table(spark, folder, "pages"))


@query("op5_near_vectors")
def op5(spark, folder):
    return near_vectors(table(spark, folder, "embeddings"))


@query("op10_bm25_packing")
def op10(spark, folder):
    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _dearer(letter: str, cost: str, rest: str) -> str:
    """A cost of eight digits with its edits, after one more edit."""
    return f"lpad(CAST(CAST({rest}[1:8] AS BIGINT) + {cost} AS VARCHAR), 8, '0') || '{letter}' || {rest}[9:]"


def _choices(state: int, due: int, kept: dict[str, int]) -> str:
    keep = " ".join(f"WHEN '{i}' THEN {_dearer('K', 'more', f'h{to}')}" for i, to in kept.items())
    return f"""least({_dearer('D', '4', f'h{state}')}, CASE WHEN gone THEN NULL ELSE {_dearer('R', '3 + more', f'h{due}')} END,
                CASE WHEN gone THEN NULL ELSE CASE initial {keep or "WHEN '' THEN NULL"} END END) AS p{state}"""


#: States 0 to 3: nothing yet, after a system, user, assistant turn; the state due next; what an initial kept leads to.
_OP11_DUE = (2, 2, 3, 2)
_OP11_KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
OP11_SQL = rf"""
WITH RECURSIVE bit AS (
    SELECT i, i AS v, 0 AS n FROM range(256) AS r(i) UNION ALL SELECT i, xor(v >> 1, 3988292384 * (v & 1)), n + 1 FROM bit WHERE n < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bit WHERE n = 8),
dice AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
            lambda c: CAST(ascii(c) AS BIGINT))),
        lambda a, b: xor(a >> 8, t[CAST((xor(a, b) & 255) + 1 AS BIGINT)]))) % 20 AS d FROM conversations, crc),
said AS (
    SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
        CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM dice JOIN (VALUES (1), (2)) AS c(copy) ON d <> 0 AND (copy = 1 OR d = 3)),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
        count(*) OVER (PARTITION BY conv_id) AS n FROM said),
marked AS (
    SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial,
        CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
            WHEN regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM placed),
turns AS (
    SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS more,
        lead(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS following FROM marked),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id),
back AS (
    SELECT conv_id, n + 1 AS pos, '00000000' AS h0, '00000006II' AS h1, '00000003I' AS h2, '00000000' AS h3 FROM turns WHERE pos = 1
    UNION ALL
    SELECT conv_id, pos, {", ".join(f"least(p{s}, {_dearer('I', '3', f'o{d}')})" for s, d in enumerate(_OP11_DUE))} FROM (
        SELECT *, {", ".join(f"least(p{s}, {_dearer('I', '3', f'p{d}')}) AS o{s}" for s, d in enumerate(_OP11_DUE))} FROM (
            SELECT t.conv_id, t.pos, {", ".join(_choices(s, d, k) for s, (d, k) in enumerate(zip(_OP11_DUE, _OP11_KEPT, strict=True)))}
            FROM back JOIN turns t ON t.conv_id IS NOT DISTINCT FROM back.conv_id AND t.pos = back.pos - 1))),
best AS (SELECT conv_id, CAST(h0[1:8] AS BIGINT) AS cost, h0[9:] AS audit FROM back WHERE pos = 1),
forth AS (
    SELECT conv_id, audit, 0 AS done, 0 AS pos, 0 AS state, CAST([] AS VARCHAR[]) AS lines FROM best
    UNION ALL
    SELECT conv_id, audit, done, pos, state, CASE edit WHEN 'D' THEN lines
        ELSE list_append(lines, CASE edit WHEN 'K' THEN role WHEN 'I' THEN CASE state WHEN 2 THEN 'user' ELSE 'assistant' END
            ELSE CASE state WHEN 2 THEN 'user' ELSE 'assistant' END END || ':' || CASE edit WHEN 'I' THEN '' ELSE text END) END
    FROM (
        SELECT e.conv_id, e.audit, e.done, e.pos, e.edit, e.lines, t.role, t.text, CASE e.edit WHEN 'D' THEN e.state
            WHEN 'K' THEN CASE t.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE e.state WHEN 2 THEN 3 ELSE 2 END END AS state
        FROM (
            SELECT conv_id, audit, done + 1 AS done, audit[done + 1] AS edit, pos + CASE audit[done + 1] WHEN 'I' THEN 0 ELSE 1 END AS pos, state, lines
            FROM forth WHERE done < length(audit)) AS e
        LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.pos = e.pos)),
repaired AS (SELECT conv_id, cost, audit, sha256(array_to_string(lines, chr(10))) AS sha FROM forth JOIN best USING (conv_id, audit) WHERE done = length(audit))
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@query("op11_repair", OP11_SQL)
def op11(spark, folder):
    told = table(spark, folder, "conversations")
    repaired = repair_conversations(damage_turns(told))
    every = told.select("conv_id").distinct()
    found = repaired.conversations.withColumnRenamed("conv_id", "found_id")
    digests = turns_digest(repaired.turns).withColumnRenamed("conv_id", "digest_id")
    rows = every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    rows = rows.join(digests, F.col("conv_id").eqNullSafe(F.col("digest_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit(""), 256)
    return rows.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256")
    )


@query("op12_alignment")
def op12(spark, folder):
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align_tokens(table(spark, folder, "documents"), *paths).withColumnRenamed("groups", "groups_sha256")


@query("op13_token_files")
def op13(spark, folder):
    docs, path = table(spark, folder, "documents"), scratch_path(spark, "token-files")
    write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), path)
    found = read_token_files(spark, path, docs)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


OP1_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
    SELECT doc_id, CASE WHEN words IS NULL OR len(words) = 0 THEN []
        WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_distinct([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FOR i IN range(1, len(words) - 1)]) END AS grams
    FROM w),
g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
        AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (
    SELECT doc_id AS node, doc_id AS root FROM documents
    UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node)
SELECT s.doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, min(root) AS component_id
FROM s JOIN reach ON reach.node = s.doc_id GROUP BY s.doc_id, len(grams)
"""


@query("op1_ngram_join", OP1_SQL)
def op1(spark, folder):
    return jaccard_groups(table(spark, folder, "documents"))
