"""Corpus pipeline: from raw documents to token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet into the shared folder and read again as the next stage's
documents, so a lost executor repeats parts of one stage only.  All stages but
the last keep the columns of ``documents``, extra ones too, whatever their
names; an empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import mixing, near_dedup, quality, tokens, winnowing
from ledgerlake.llm.common import keep, load


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  Null and empty texts are
    scored by their structure; rows that share an id, and null ids, are judged
    one by one.  Without labels every text scores the same."""
    return quality.good_documents(docs, load(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles,
    similarity 0.8) stays: the one with the smallest id, null ids last.  Texts
    without words are in no group and stay; rows that share an id stay or go together."""
    return near_dedup.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go, and with them the
    rows that share their id (null included).  Null texts hold none."""
    return winnowing.clean_documents(docs, load(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.  The null source is
    a source of its own; texts without words have size 0 and are taken like
    the rest of their source."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents in order of their ids (null ids first); one
    row per document, repeated ones too, read from the files.  A null text is the empty one."""
    return tokens.token_output(docs, tokens.default_tokenizer())


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

#: Sketches, the classifier and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
