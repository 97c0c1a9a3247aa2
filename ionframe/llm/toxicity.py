"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .ftrl import Model, Settings, score, train

#: Words, bigrams, skip-grams over one and two words, and stems for inflected words. L1 keeps few features, so the weights are small to broadcast.
SETTINGS = Settings(kinds=(("word", ()), ("word", (1,)), ("word", (2,)), ("word", (3,)), ("stem4", ()), ("stem5", ())),
                    presence=True, alpha=2.0, l1=8.0, l2=0.1, epochs=5, sample_rows=6000)
THRESHOLD = 0.5


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> Model:
    """See `ftrl.train`."""
    return train(docs, labels, label, settings, doc_id, text)


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs`` with held_out, score (0 to 1) and predicted (score >= threshold); input
    columns of these names are replaced. Only the text is scored, all of it; null and
    wordless texts get the model's bias. Rows and repeated rows are kept."""
    return (docs.withColumn("held_out", held_out(doc_id))
            .withColumn("score", score(docs.sparkSession, model, text))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with its columns."""
    return docs.where(score(docs.sparkSession, model, text) < threshold)
