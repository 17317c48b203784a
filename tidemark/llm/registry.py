"""The queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import op4_byte_bpe
from tidemark.llm.chat import OP2_SQL, op2_chat_format
from tidemark.llm.embeddings import OP5_SQL, op5_embedding_dedup
from tidemark.llm.language import op8_language_id
from tidemark.llm.manifest import OP13_SQL, op13_merkle_manifest
from tidemark.llm.mixing import OP3_SQL, op3_mixing
from tidemark.llm.neighbours import OP11_SQL, op11_nearest_neighbours
from tidemark.llm.phrases import OP12_SQL, op12_collocations
from tidemark.llm.quality_model import op6_quality_classifier
from tidemark.llm.quality_rules import OP9_SQL, op9_quality_rules
from tidemark.llm.simhash import op10_simhash
from tidemark.llm.substring import OP1_SQL, op1_substring_dedup
from tidemark.llm.url_filter import OP7_SQL, op7_url_filter

_QUERIES = (
    op1_substring_dedup,
    op2_chat_format,
    op3_mixing,
    op4_byte_bpe,
    op5_embedding_dedup,
    op6_quality_classifier,
    op7_url_filter,
    op8_language_id,
    op9_quality_rules,
    op10_simhash,
    op11_nearest_neighbours,
    op12_collocations,
    op13_merkle_manifest,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": OP1_SQL,
        "op2_chat_format": OP2_SQL,
        "op3_mixing": OP3_SQL,
        "op5_embedding_dedup": OP5_SQL,
        "op7_url_filter": OP7_SQL,
        "op9_quality_rules": OP9_SQL,
        "op11_nearest_neighbours": OP11_SQL,
        "op12_collocations": OP12_SQL,
        "op13_merkle_manifest": OP13_SQL,
    }
