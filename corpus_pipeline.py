"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of documents.

1. quality: documents that the quality classifier rejects (score under 0.3) go;
2. line_dedup: lines like an earlier line go, with documents of which nothing is left;
3. near_duplicates: one document of each class of near copies stays;
4. mixing: documents are repeated or left out to meet the sources' target weights;
5. packing: one row per piece with its place in a sequence of at most 1,024 tokens.

Some stages have no SQL form (a trained classifier, a tokenizer), so there is no
``ORACLE_SQL``.  ``tests/llm/test_brute_force.py`` compares every stage with plain
Python on a whole small table (packing: whole, gapless, and no worse than best fit).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from minutebook.llm import op1_ngram_join, op3_packing, op4_quality, op5_mixing, op6_line_dedup
from minutebook.llm.common import read, saved
from minutebook.llm.op2_token_counts import tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_quality.keep_good(spark, docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op6_line_dedup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1_ngram_join.one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op5_mixing.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = op3_packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("mixing", mixing),
          ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
