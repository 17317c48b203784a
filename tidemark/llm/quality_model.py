"""Quality classifier: subword embeddings trained on the quality labels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.subword import Model, Settings, sample_features, score, train

SETTINGS = Settings(per_class=1500)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null doc_id is held out, as it cannot be told apart."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS) -> Model:
    """A model from rows (doc_id, quality) that are not held out. Null labels and ids are not learned.

    Both classes are sampled up to the same bound; the logits are then shifted by the shares that the
    classes have among all rows that may be learned. If only one class is known, or none, the model
    still scores: with the shares alone.
    """
    learned = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("label"))
    shares = {r["label"]: r["count"] for r in learned.groupBy("label").count().collect()}
    known, rows = sample_features(docs.select("doc_id", "text"), learned, settings)
    rows = [(known[n], ids, share) for n, ids, share in rows]
    both = len(known) == 2
    model = train(rows if both else [], [0, 1], settings)
    taken = np.bincount([r[0] for r in rows], minlength=2) if both else np.zeros(2)
    share = np.array([shares.get(0, 0), shares.get(1, 0)], float)
    model.shift = np.log((share + 1) / (taken + 1)).astype(np.float32)
    return model


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Null and empty texts get the score of the classes' shares. Repeated rows and null ids are scored
    like others, other columns ignored. No rows give no rows.
    """
    value = F.col("_p")[1]
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), value.alias("score"), F.when(value >= 0.5, 1).otherwise(0).alias("predicted")
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return classify(docs, fit(docs, table(spark, sf_dir, "labels")))
