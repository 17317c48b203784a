"""Corpus pipeline: language ID, SimHash near-dedup, substring dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; ``run`` writes
each result to the shared folder and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, language, mixing, simhash, substring
from tidemark.llm.common import cut, remove, scratch, table

#: The order of hashes, seeds and training steps cannot be stated in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; ``lang`` becomes the prediction.

    Null and empty texts and those without a letter go. Repeated rows and null ids are judged like
    others, other columns pass through; no rows give no rows.
    """
    return language.keep_recognised(docs, language.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least doc_id.

    Of rows that repeat this id one stays; rows without an id stay. Null, empty and very long texts
    are compared like others, other columns pass through; no rows give no rows.
    """
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier document has; a document may be left empty.

    A null id counts as larger than all others; rows of one id never remove each other's words. Null
    texts stay null, other columns pass through; no rows give no rows.
    """
    return substring.remove_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes, in training order.

    Null and empty texts have no words to take; a null source is a source. Null ids and repeated
    rows are mixed like others, other columns pass through; no rows give no rows.
    """
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the digest of the bytes that they decode to.

    A null text is empty. Very long texts are read in slices; repeated rows and null ids are encoded
    like others, other columns are left out; no rows give no rows.
    """
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``.

    What the stages wrote on their way is deleted as soon as the next result is written; only the
    last stage's input stays, as the result is read from it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as written:
            docs = cut(stage(spark, docs, sf_dir), name)
            result = written.pop()
        if before:
            remove(spark, before)
        before = result
    return STAGES[-1][1](spark, docs, sf_dir)
