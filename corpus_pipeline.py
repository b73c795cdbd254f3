"""From raw documents to token ids of a mixed training corpus: the stages, in order, each calling one corpus operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import dedup_exact, minhash, mixing, sentencepieces, toxicity
from tablewright.llm.common import table, written
from tablewright.llm.queries import PIECES

#: SQL for the rows of ``run``: none, as a trained classifier and an encoder cannot be said in SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity, learned from ``labels``, is below one half."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id."""
    return dedup_exact.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates, by five-word shingles at a similarity of 0.8, the document with the smallest doc_id."""
    return minhash.without_near(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated and left out so that sources reach their weights, in a new order."""
    return mixing.mix_sources(docs, power=0.5, epochs=1.0).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with what names it."""
    return sentencepieces.encode_texts(docs.select("doc_id", "source", "lang", "text"), PIECES).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mix sources", mix),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
