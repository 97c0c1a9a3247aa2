"""Quality classifier: hashed word n-gram logistic regression with follow-the-regularised-leader updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .ftrl import Model, Settings, score, train

#: Words to trigrams, and up to trigrams of word forms (kinds of characters, length, repetition).
SETTINGS = Settings(kinds=(("word", ()), ("word", (1,)), ("word", (1, 2)), ("form", ()), ("form", (1,)), ("form", (1, 2))),
                    presence=False, alpha=2.0, l1=0.1, l2=0.1, epochs=6, sample_rows=4000)
THRESHOLD = 0.3


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> Model:
    """See `ftrl.train`."""
    return train(docs, labels, label, settings, doc_id, text)


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs`` with held_out, score (0 to 1, higher: better) and predicted (score >= threshold);
    input columns of these names are replaced. Only the text is scored, all of it; null and
    wordless texts get the model's bias. Rows and repeated rows are kept."""
    return (docs.withColumn("held_out", held_out(doc_id))
            .withColumn("score", score(docs.sparkSession, model, text))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
