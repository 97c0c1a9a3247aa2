"""A training corpus from raw documents, as stages over Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionframe.llm import mixing, pii, sentencepiece, simhash, toxicity
from ionframe.llm.queries import PII_KEY, TOKENIZER
from ionframe.plans.tables import table
from ionframe.session import drop_stored, scratch_path, scratch_tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that a model learned from the labels finds toxic."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of SimHash near-copies."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by pseudonyms."""
    return pii.pseudonymise(docs, PII_KEY)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their target weights."""
    return mixing.emit(mixing.mix(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document's text, and whether decoding them gives the text again."""
    model = sentencepiece.load(TOKENIZER)
    back = sentencepiece.round_trip(docs, model)
    return back.select("doc_id", "source", "ids", (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [("toxicity", clean), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
                                   ("mixed_sources", mixed_sources), ("encoded", encoded)]

#: The stages train a model, search fingerprints and tokenise, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again; of the stored tables only the last stage's stays."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = scratch_path(spark, f"pipeline-{name}")
        with scratch_tables(spark):  # what the stage's operators stored
            stage(spark, docs, sf_dir).write.parquet(out)
        if before:
            drop_stored(spark, before)
        docs, before = spark.read.parquet(out), out
    return docs
