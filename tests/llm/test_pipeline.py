"""Each stage of the pipeline against a plain version of it, each on its own input."""

from __future__ import annotations

import hashlib
import os

import corpus_pipeline
import public_tokenizers
import tiktoken

from tests.llm.test_dedup import brute_print, brute_substring, reach
from tidemark.llm import bpe
from tidemark.llm.common import cut


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(cut(stage(spark, frames[-1], sf), name))
    raw, recognised, distinct, stripped, mixed, encoded = [f.collect() for f in frames]
    assert all(f.columns == columns for f in frames[:-1])
    assert {r["doc_id"] for r in recognised} <= {r["doc_id"] for r in raw} and len(recognised) >= 0.9 * len(raw)
    assert not any((r["text"] or "").strip() == "" for r in recognised)

    prints = {r["doc_id"]: brute_print(r["text"]) for r in recognised}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert {r["doc_id"] for r in distinct} == {d for d, least in reach(prints, links).items() if d == least}

    want = brute_substring([(r["doc_id"], r["text"]) for r in distinct])
    for r in stripped:
        assert hashlib.sha256(b" ".join((r["text"] or "").encode().split())).hexdigest() == want[r["doc_id"]][2] or not want[r["doc_id"]][1]

    sizes = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in stripped}
    taken: dict = {}
    for r in mixed:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(r["text"].encode().split())
    assert all(n <= 3 * sizes[d] for d, n in taken.items())
    assert abs(sum(taken.values()) - sum(sizes.values())) <= len({r["source"] for r in stripped})

    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    texts = sorted((r["doc_id"], r["text"]) for r in mixed)
    assert sorted((r["doc_id"], library.decode(r["ids"])) for r in encoded) == texts
    assert all(r["n_tokens"] == len(r["ids"]) for r in encoded)


def test_stages_on_awkward_rows(spark, sf):
    """Null ids and texts, empty and repeated rows, an extra column with a clashing name, and no rows at all."""
    own = [(None, "the cat and the dog and the bird", "en", "a", 3, "x"), (1, None, "en", "a", 0, "x"), (1, "", None, None, None, None), (2, "123 !!", "en", "b", 6, "y")]
    own += [(i % 40, f"the cat {i % 40} sat on the mat and the dog {i % 7} ran off", "en", "s" if i % 3 else None, 9, "z") for i in range(120)]
    docs = spark.createDataFrame(own, "doc_id long, text string, lang string, source string, n_chars long, fp string")
    for rows in (docs, docs.limit(0)):
        out = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = cut(stage(spark, out, sf), name)
            assert out.columns == docs.columns, name
        last = cut(corpus_pipeline.STAGES[-1][1](spark, out, sf), "last")
        assert last.count() == out.count() and {"doc_id", "n_tokens"} <= {*last.columns}
        if rows is docs:
            assert 0 < out.count() and out.where("text IS NULL OR text = ''").count() == 0


def test_run_leaves_one_table_behind(spark, sf, tmp_path):
    from tidemark.llm.common import shared_dir

    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    assert corpus_pipeline.run(spark, sf).count() > 100
    assert len(set(os.listdir(shared_dir(spark).removeprefix("file:"))) - before) == 1
