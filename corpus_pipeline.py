"""Corpus pipeline: language, near duplicates, repeated passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all documents that the
stage before it kept; all but the last return the columns of ``documents``.
Nulls, empty texts, repeated rows and extra columns are handled as the stages'
operators state; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import jaccard, langid, packing, pii, suffix_dedup
from tessera.llm.common import read_table, written
from tessera.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
OTHERS = tuple(c for c in COLUMNS if c != "text")


def _with_text(df: DataFrame, text: str) -> DataFrame:
    """The columns of documents with a changed text and its length."""
    return df.select("doc_id", F.col(text).alias("text"), "lang", "source",
                     F.length(text).cast("long").alias("n_chars"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told go on; those without a letter are rejected."""
    return langid.identify(docs, keep=COLUMNS).where("lang_pred <> 'und'").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents linked by Jaccard similarity, the one with the smallest id stays."""
    return jaccard.one_per_component(docs, keep=OTHERS).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document holds are cut; a document left empty by that goes."""
    cut = suffix_dedup.repeated_spans(docs, keep=OTHERS, as_text=True)
    return _with_text(cut.where("n_bytes = 0 OR length(kept) > 0"), "kept")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind in brackets."""
    return _with_text(pii.find(docs, keep=OTHERS), "redacted")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 4096."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("personal_data", personal_data), ("pack", pack)]

#: Classifier, tokenizer and byte-level passages are not SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
