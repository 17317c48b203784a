"""Collocations against brute force, the tokeniser against patterns, the sketch against counts."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import phrases


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(docs, least, top=2000, share=100):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        longer = [b for (g, q), b in found.items() if g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= share * a for b in longer):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -score)
        for lang, rows in out.items()
        for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top])
    )


def some_docs(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "b", "New", "york", "é", "ß\xa0x", "x" * 40, "-", "\x00z", "的"]
    docs = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randrange(40)):
            text += rng.choice([*words, "new york city", "a a a a"]) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", ":"])
        docs.append((rng.choice(["en", "en", "de", None, "und", ""]), text))
    return [*docs, ("en", None), (None, ""), ("fr", " .,; \n"), ("fr", "one two"), ("en", "A b " * 2000), ("en", "A b " * 2000)]


def found(spark, docs, **how):
    df = spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "1 AS n", "'q' AS phrase", "2 AS rank").repartition(5)
    return sorted(tuple(r) for r in phrases.collocations(df, **how).collect())


@pytest.mark.parametrize(("seed", "how"), [(1, {"least": 5}), (2, {"least": 30, "top": 7}), (3, {"least": 5, "share": 60}), (4, {"least": 300})])
def test_collocations_equal_brute_force(spark, seed, how):
    docs = some_docs(seed)
    assert found(spark, docs, **how) == brute(docs, **how)


def test_few_cells_and_many_shards_change_nothing(spark, monkeypatch):
    """With next to no pruning and a shard for each few stretches the result is the same."""
    docs = some_docs(5, 40)
    monkeypatch.setattr(phrases, "MIN_CELLS", 1 << 16)
    monkeypatch.setattr(phrases, "SHARD_BYTES", 400)
    assert found(spark, docs, least=8) == brute(docs, least=8)


def test_portions_and_held_counts(monkeypatch):
    """The maps by themselves: stretches sent early and portions of a few bytes add up to the same counts."""
    docs = [(x or "und", (t or "").encode()) for x, t in some_docs(6, 60)]
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in docs]), pa.array([t for _, t in docs], pa.binary()), pa.array([1] * len(docs))], ["lang", "text", "n"])
    every = np.full((1 << 16) // 8, 255, np.uint8)
    results = []
    for small in (False, True):
        if small:
            for name, size in (("SLICE", 50), ("HELD", 3), ("PORTION", 100)):
                monkeypatch.setattr(phrases, name, size)
        sent = sorted((r for b in phrases._stretches([batch], 16, every, 3) for r in b.to_pylist()), key=lambda r: (r["shard"], r["lang"]))
        found = [r for b in phrases._merged([pa.RecordBatch.from_pylist(sent[:7]), pa.RecordBatch.from_pylist(sent[7:])]) for r in b.to_pylist() if r["text"]]
        assert len({(r["lang"], r["text"]) for r in found}) == len(found)
        shards = [sorted((r for r in found if len(r["text"]) % 3 == i), key=lambda r: r["lang"]) for i in range(3)]
        counts = collections.Counter()
        for shard in shards:
            for out in phrases._scan([pa.RecordBatch.from_pylist(shard)], 16, every, every):
                for r in out.to_pylist():
                    counts[r["lang"], r["text"].decode()] += r["n"]
        results.append(counts)
    expected = collections.Counter()
    for lang, text in docs:
        for words in pieces(text.decode()):
            expected.update((lang, " ".join(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    assert results[0] == results[1] == expected


def test_no_rows(spark):
    assert found(spark, []) == []


def test_a_language_may_hold_nearly_all_words_and_a_text_may_be_very_long(spark):
    docs = [("en", "the quick fox. " * 400_000), ("en", "fox the quick"), ("de", "eins zwei " * 100)]
    got = {(r[0], r[2]): r[3:] for r in found(spark, docs)}
    assert got["en", "the quick fox"][:2] == (400_000, 400_001)
    assert ("en", "the quick") in got and ("en", "quick fox") not in got
    assert got["de", "eins zwei"][0] == 100


def test_arithmetic_beyond_64_bits(spark, monkeypatch):
    big = 4 * 10**12
    rows = [("en", "", 10**13), ("en", "a", big), ("en", "b", big + 1), ("en", "a b", big - 1)]
    monkeypatch.setattr(phrases, "frequencies", lambda docs, least: spark.createDataFrame(rows, "lang string, phrase string, n long"))
    got = phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect()
    assert [r.score for r in got] == [1000 * (big - 1) * 10**13 // (big * (big + 1))]


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_words_of_stretches_are_those_of_the_pieces(monkeypatch, size):
    monkeypatch.setattr(phrases, "SLICE", size)
    docs = some_docs(7, 30)
    texts = [(t or "").encode() for _, t in docs]
    batch = pa.RecordBatch.from_arrays([pa.array([x or "und" for x, _ in docs]), pa.array(texts, pa.binary()), pa.array([1] * len(docs))], ["lang", "text", "n"])
    got, by_hash = [], {}
    for words, _, _ in phrases._slices([batch.slice(0, 11), batch.slice(11), batch.slice(0, 0)]):
        last = None
        for i in range(len(words.start)):
            word = words.phrase(i, 1).decode()
            if words.piece[i] != last:
                got.append([])
            last = words.piece[i]
            got[-1].append(word)
            assert by_hash.setdefault(word, words.hash[i]) == words.hash[i]
    assert got == [p for _, t in docs for p in pieces(t) if p]
    assert len({*by_hash.values()}) == len(by_hash)


def test_a_guarded_text_keeps_words_and_pieces():
    for _, text in some_docs(8, 30):
        clean = phrases.guarded((text or "").encode())
        assert [p.split(" ")[1:-1] for p in clean.split("\n") if p.strip(" ")] == [[w.encode().decode("latin-1") for w in p] for p in pieces(text) if p]


def test_a_sketch_never_counts_too_low(spark):
    docs = some_docs(9)
    texts = spark.createDataFrame([(x or "und", (t or "").encode(), 1) for x, t in docs], "lang string, text binary, n long").repartition(3)
    counts = collections.Counter()
    for batch in [pa.RecordBatch.from_arrays([pa.array([x or "und" for x, _ in docs]), pa.array([(t or "").encode() for _, t in docs], pa.binary()), pa.array([1] * len(docs))], ["lang", "text", "n"])]:
        for words, languages, _ in phrases._slices([batch]):
            counts.update(words.phrases(languages)[1][words.within(2)].tolist())
    sketch = phrases.sketch(texts, 16, 20)
    met = {x: bool(phrases._met(sketch, phrases._cells(np.array([x], np.uint64), 16))[0]) for x in counts}
    assert all(met[x] for x, n in counts.items() if n >= 20)
    assert sum(met.values()) < len(met)


def test_equal_hashes_of_different_stretches_are_told_apart(monkeypatch):
    """If the first hash does not tell stretches apart, each is counted by itself."""
    real = phrases._spans
    monkeypatch.setattr(phrases, "_spans", lambda v, a, b, base=0: real(v, a, b, base) * np.uint64(base))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([b"a b. c. a b"], pa.binary()), pa.array([1])], ["lang", "text", "n"])
    got = {r["text"]: r["n"] for b in phrases._merged(phrases._stretches([batch], 16, np.full((1 << 16) // 8, 255, np.uint8), 1)) for r in b.to_pylist()}
    assert got == {b"": 5, b"a b": 2, b"c": 1}
