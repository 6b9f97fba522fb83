"""From raw documents to training sequences: quality, language, near duplicates, packing."""

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shopfloor.llm import langid, neardup, packing, quality
from shopfloor.llm.common import read_table
from shopfloor.storage import remove, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones, does not take for bad."""
    labels = read_table(spark, sf_dir, "labels")
    return quality.accepted(docs, quality.learn(docs, labels))


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language."""
    return langid.accepted(docs, langid.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return neardup.one_of_each(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_filter", quality_filter),
    ("language_filter", language_filter),
    ("near_dedup", near_dedup),
    ("packing", sequences),
]

#: Neither the tokenizer nor the classifiers can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again as the next one's input.

    A stage's table is removed when the next one has been written. The last stage writes its ids
    before it returns, so its input can go too. Rows without an id go through every stage; an empty
    table gives no pieces.
    """
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    done = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if done:
            remove(spark, done)
        done = f"{folder}/{name}"
    pieces = STAGES[-1][1](spark, docs, sf_dir)
    remove(spark, folder)
    return pieces
