"""Language identification: subword embeddings, a temperature and a rejection threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.subword import Model, Settings, calibrate, learned, score, train

SETTINGS = Settings(per_class=800)
UNKNOWN = "und"
#: Every such row of the sample calibrates the model instead of training it.
CALIBRATE_EVERY = 5


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null doc_id is held out, as it cannot be told apart."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, settings: Settings = SETTINGS) -> Model:
    """A model from the text and lang of documents that are not held out; rows without lang are not learned."""
    own = docs.select("doc_id", "text", F.col("lang").cast("string").alias("label"))
    known = own.where(~held_out(F.col("doc_id")) & F.col("label").isNotNull())

    def trained(labels: list, rows: list) -> Model:
        model = train([r for n, r in enumerate(rows) if n % CALIBRATE_EVERY], labels, settings)
        return calibrate(model, rows[::CALIBRATE_EVERY])

    return learned(own, known, settings, trained)


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (doc_id if none are named) with _lang_pred, _score and _rejected.

    ``und`` with score 0 if the text is null or has no letter, or if no language was learned; these
    are rejected, as are predictions below the calibrated threshold. Ties go to the first language.
    Repeated rows and null ids are scored like others, other columns ignored. No rows give no rows.
    """
    keep = ["doc_id"] if keep is None else keep
    if model.labels:
        p = score(docs, model, keep)
    else:
        p = docs.select(*keep, F.lit(False).alias("_has_letter"), F.array(F.lit(0.0)).alias("_p"))
    best = F.array_max("_p")
    names = F.array(*map(F.lit, model.labels or [UNKNOWN]))
    name = F.when(F.col("_has_letter"), F.get(names, F.array_position("_p", best).cast("int") - 1)).otherwise(UNKNOWN)
    value = F.when(F.col("_has_letter"), best).otherwise(0.0)
    return p.select(
        *keep, name.alias("_lang_pred"), value.alias("_score"), (~F.col("_has_letter") | (value < model.threshold)).alias("_rejected")
    )


def keep_recognised(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with ``lang`` set to the prediction."""
    found = identify(docs, model, docs.columns).where("NOT _rejected")
    return found.withColumn("lang", F.col("_lang_pred")).select(docs.columns) if "lang" in docs.columns else found.select(docs.columns)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"), F.col("_rejected").alias("rejected")
    )
