"""Corpus pipeline: toxicity, quality, near-duplicates, source mixing, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termloom.llm import bpe, dartminhash, mixing, quality, toxicity
from termloom.llm._spark import fresh_dir, remove
from termloom.llm.queries import BYTE_BPE, TARGETS, WORD_BPE, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't predict toxic.

    Rows are judged one by one: repeated rows and null ids stay or go by their text. A null or
    empty text has the score of no words, which is clean. Other columns are kept as they are.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.filter_clean(docs, model)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the highest grade is at least a half.

    Rows are judged one by one: repeated rows and null ids stay or go by their text. A null or
    empty text is judged by the thresholds alone. Other columns are kept as they are.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.filter_kept(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near-duplicates.

    Groups are groups of rows, whatever their ids: rows that repeat an id and its text, and
    copies without an id, leave one row; rows that repeat an id with other texts are documents of
    their own. Null texts and texts without words are in no group and stay.
    """
    return dartminhash.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by calibrated probabilities towards the target weights.

    Null sources and languages are classes of their own; texts without tokens stay. Rows that
    repeat an id are drawn alike, null ids as one.
    """
    return mixing.sample(docs, BYTE_BPE, targets=TARGETS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents' ids and decoded text; a null text is empty."""
    return bpe.encode_documents(docs, WORD_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: No stage but the sampling's last step can be said in SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again.

    A stage's table is removed once the next one is written; the last one, which the result is
    read from, stays in the shared folder.
    """
    docs, last = table(spark, sf_dir, "documents"), None
    base = fresh_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        if last:
            remove(spark, last)
        docs, last = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
