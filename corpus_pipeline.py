"""The corpus pipeline: documents in, packed training sequences out.

Each stage reads what the one before it wrote.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from shelfrank.llm.language import UNKNOWN, fit_language_model, held_out, predict_language
from shelfrank.llm.mixing import apply_mix
from shelfrank.llm.ngram_join import drop_copies
from shelfrank.llm.packing import pack_documents
from shelfrank.llm.pii import mask_pii
from shelfrank.session import write_table

TOKENIZER = "word_bpe_49k.json"


def identify_language(spark, docs, sf_dir):
    """Documents whose language is known; those without letters or between two languages go.

    ``lang`` becomes the language found; no other column changes, whatever its name.  Null and empty texts have no
    letters.  Repeated rows are judged alike.  Without a row that has both text and lang nothing can be known and all go.
    """
    model = fit_language_model(docs.where(~held_out(F.col("doc_id"))))
    whole = docs.select(F.struct("*").alias("row"), "text")
    known = predict_language(whole, model).where((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous"))
    return known.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of near copies: the one with the smallest doc_id.

    Null, empty and blank texts stay, as do rows of equal doc_id and text; see ``drop_copies``.
    """
    return drop_copies(docs)


def mask_personal_data(spark, docs, sf_dir):
    """Spans of personal data become the name of their kind; null texts stay null, every row stays."""
    return mask_pii(docs)


def mix(spark, docs, sf_dir):
    """Each document as often as the mix of sources takes it, the last one of a source cut to fit.

    A null source is one of its own; null and blank texts have no words and are not taken.
    """
    return apply_mix(docs)


def pack(spark, docs, sf_dir):
    """Pieces of the documents in training sequences; a repeated document is packed as often."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("mix_sources", mix),
    ("packing", pack),
]

# Learned languages and packing have no SQL; a test compares the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
