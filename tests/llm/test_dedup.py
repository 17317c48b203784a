"""Substring dedup, SimHash and embedding near-dedup against brute force, on awkward inputs."""

from __future__ import annotations

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import embeddings, registry, simhash, substring
from tidemark.llm.common import connected_components

WORDS = [f"w{i}" for i in range(40)]


def reach(nodes, links):
    """The smallest node that each reaches."""
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            if (least[a], least[b]) != (low, low):
                least[a] = least[b] = low
                changed = True
    return least


def brute_substring(docs):
    first = {}
    for doc_id, text in docs:
        words = (text or "").encode().split()
        for i in range(len(words) - 49):
            key = tuple(words[i : i + 50])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = {}
    for doc_id, text in docs:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - 49):
            if first[tuple(words[i : i + 50])] < doc_id:
                gone.update(range(i, i + 50))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc_id] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def passages(seed, n=60):
    """Documents that share passages of 49 to 120 words, also shifted, overlapping and within one document."""
    rng = random.Random(seed)
    shared = [[rng.choice(WORDS) for _ in range(rng.choice([49, 50, 51, 80, 120]))] for _ in range(6)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 30))]
            if rng.random() < 0.7:
                p = rng.choice(shared)
                at = rng.randrange(0, 20)
                parts += p[at:] if rng.random() < 0.5 else p
        docs.append((i * 3 + 1, rng.choice([" ", "\n", "\t "]).join(parts)))
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substring_equals_brute_force(spark, seed):
    docs = [*passages(seed), (900, None), (901, ""), (902, "a " * 300), (903, "a " * 300), (904, "é\xa0x " * 60), (2, "é\xa0x " * 60)]
    found = substring.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    got = {r["doc_id"]: (r["_n_words"], r["_n_removed"], r["_kept_sha256"]) for r in found.collect()}
    assert got == brute_substring(docs)


def test_substring_with_repeated_rows_null_ids_and_clashing_columns(spark):
    text = " ".join(WORDS + WORDS[::-1])
    rows = [(5, text, 1, "x"), (5, text, 1, "y"), (None, text, 2, None), (7, text, 3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key long, at string")
    found = substring.dedup_substrings(docs)
    assert {*docs.columns} <= {*found.columns}
    assert sorted((r["doc_id"] or -1, r["_n_removed"], r["at"] or "") for r in found.collect()) == [(-1, 80, ""), (5, 0, "x"), (5, 0, "y"), (7, 80, "z")]
    assert substring.dedup_substrings(docs.limit(0)).count() == 0
    kept = substring.remove_repeats(docs)
    assert kept.columns == docs.columns and kept.where("text = ''").count() == 2


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts(seed):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(5000)}" for _ in range(400)] for _ in range(5)]
    docs = []
    for i in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
        docs.append((i, " ".join(words)))
    return docs


def test_simhash_equals_brute_force(spark):
    docs = [*near_texts(4), (500, None), (501, ""), (502, "one two"), (503, "ONE two"), (504, " \n"), (505, "Ünï CODE É"), (506, "one two three four")]
    found = {r["doc_id"]: r for r in simhash.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    prints = {d: brute_print(t) for d, t in docs}
    assert {d: r["fp"] & (2**64 - 1) for d, r in found.items()} == prints
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    assert {d: r["component_id"] for d, r in found.items()} == reach(prints, links)
    assert len(links) > 100


@pytest.mark.parametrize("blocks", [1, 7, 64])
def test_crowded_fingerprints_lose_no_link(spark, monkeypatch, blocks):
    """Fingerprints that share most bits, so that links cross groups and blocks at every level."""
    monkeypatch.setattr(simhash, "MIN_BLOCKS", blocks)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 1000)
    rng = random.Random(blocks)
    base = rng.getrandbits(64)
    prints = {base, 0, 1, 2**64 - 1, 2**63, 2**63 + 1}
    while len(prints) < 700:
        p = rng.choice(list(prints)) if rng.random() < 0.6 else base
        for _ in range(rng.randrange(1, 5)):
            p ^= 1 << rng.randrange(24)
        prints.add(p)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    found = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    links = [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    got, want = reach(signed, [(r["a"], r["b"]) for r in found]), reach(signed, links)
    assert got == want and len(set(want.values())) < len(signed)
    assert len(found) < len(links)  # a forest of each block and one link for each fingerprint sent to it


@pytest.mark.parametrize("spread", [14, 64])
def test_search_is_exact_and_prunes_groups_at_upper_levels(spread):
    rng = np.random.default_rng(spread)
    bits = np.unique(rng.integers(0, 1 << spread, 3000, dtype=np.uint64) if spread < 64 else rng.integers(0, 2**64 - 1, 9000, dtype=np.uint64))
    near = bits[:300] ^ (np.uint64(1) << rng.integers(0, spread, 300).astype(np.uint64))
    bits = np.unique(np.concatenate([bits, near]))
    rank = bits.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    bits = bits[np.argsort(rank)]
    index = simhash.GrayIndex(bits, bits)
    got = sorted((int(q), int(e), int(d)) for found in index.search(bits, np.zeros(len(bits), np.int64)) for q, e, d in zip(*found, strict=True))
    apart = [np.bitwise_count(bits ^ b) for b in bits]
    assert got == sorted((q, int(e), int(apart[q][e])) for q in range(len(bits)) for e in np.flatnonzero(apart[q] <= 2))
    if spread == 64:
        below = [simhash.FANOUT**level for level in range(len(index.levels))]
        saved = [n * size for n, size in zip(index.pruned, below, strict=True)]
        assert len(index.levels) >= 4 and min(index.pruned[1:-1]) > 0
        assert sum(saved[1:]) > 0.9 * len(bits) ** 2  # nearly all comparisons are saved by groups, not by single entries
    # Bits that were compared above are not compared again, and what they differ in counts.
    again = [f for f in index.search(bits[:50], np.full(50, 2), (1 << 64) - 1)]
    assert sum(len(f[0]) for f in again) == 50 * len(bits)


def test_keep_one_keeps_the_columns_and_rows_without_id(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x"), (2, "a b c d", "y"), (2, "a b c d", "z"), (None, "a b c d", "n")], "doc_id long, text string, fp string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["fp"]) for r in kept.collect()) == [(-1, "n"), (1, "x")]
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(7, 7), (None, 3), (2001, 2000), (2000, 2001)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1040), 1000), 2000: 2000, 2001: 2000}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_long_chains(spark):
    rng, n = random.Random(7), 3000
    shuffled = rng.sample(range(n), n)
    falling = [n, *range(2 * n - 1, n, -1)]  # labels that spread one edge a round need n - 1 rounds
    names = [f"u{x}" for x in rng.sample(range(n), n)]
    edges = [*itertools.pairwise(shuffled), *itertools.pairwise(falling)]
    parts = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in parts} == {x: 0 if x < n else n for x in range(2 * n)}
    assert len(parts) == 2 * n
    parts = connected_components(spark.createDataFrame([*itertools.pairwise(names)], "a string, b string")).collect()
    assert sorted((r["node"], r["component"]) for r in parts) == sorted((x, "u0") for x in names)


def brute_cosine(rows):
    good = {i: np.array(v, float) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = [(a, b) for a, b in itertools.combinations(good, 2) if len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.9]
    degree = dict.fromkeys([i for i, _ in rows], 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    least = reach([i for i, _ in rows], links)
    return {i: (degree[i], least[i], least[i] == i) for i, _ in rows}


@pytest.mark.parametrize("block", [16, 2048])
def test_embeddings_equal_brute_force(spark, monkeypatch, block):
    """Small blocks give many cells and blocks, so links across both are looked for."""
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 8))
    rows = [(i, (centres[rng.integers(12)] + rng.normal(size=8) * rng.choice([0.1, 0.3, 0.6])).astype(np.float32).tolist()) for i in range(400)]
    rows += [(500 + i, rows[0][1]) for i in range(30)]
    rows += [(600, None), (601, [0.0] * 8), (602, [1.0, None] + [0.0] * 6), (603, [float("nan")] + [1.0] * 7), (604, [float("inf")] + [1.0] * 7), (605, []), (606, [1e-30] * 8), (607, [1e30] * 8), (608, [1.0] * 7)]
    found = embeddings.groups(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found.collect()} == brute_cosine(rows)


def test_embeddings_recall_of_a_limited_search(spark, monkeypatch):
    """Vectors without clusters, some of them with a partner just above the threshold: with four deviations hardly a link is lost."""
    monkeypatch.setattr(embeddings, "SMALL_CELL", 16)
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(1500, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    apart = rng.normal(size=(300, 64))
    apart -= (apart * vectors[:300]).sum(1, keepdims=True) * vectors[:300]
    near = 0.91 * vectors[:300] + math.sqrt(1 - 0.91**2) * apart / np.linalg.norm(apart, axis=1, keepdims=True)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(np.concatenate([vectors, near]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, name string").cache()
    want = brute_cosine([r[:2] for r in rows])
    exact = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.groups(frame).collect()}
    assert exact == want
    found = sum(r["n_links"] for r in embeddings.groups(frame, sigmas=4).collect())
    assert 0.99 * sum(n for n, _, _ in want.values()) <= found <= sum(n for n, _, _ in want.values())


def test_embeddings_of_repeated_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.99, 0.01]), (None, [0.0, 2.0])]
    found = sorted(((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in embeddings.groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert found == [(-1, 1, 1, False), (1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


def test_embeddings_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, name string")
    assert embeddings.groups(empty).count() == 0
    none = spark.createDataFrame([(3, None, "x")], empty.schema)
    assert [tuple(r) for r in embeddings.groups(none).collect()] == [(3, 0, 3, True)]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, sf, oracle, same, name):
    same(registry.queries()[name](spark, sf), oracle(registry.oracle_sql()[name]))


@pytest.mark.parametrize("doc_id", [7, None])
def test_substring_with_thousands_of_copies_of_one_row(spark, doc_id):
    """Copies cost their words and nothing more: 20,000 of them beside a smaller document, and null ids of other texts."""
    text = " ".join(WORDS + WORDS[::-1])
    tail = " ".join([*WORDS[::-1], *(f"t{i}" for i in range(30))])
    rows = [(5, "x " + text)] + [(None, tail)] * 3
    one = spark.createDataFrame([(doc_id, text)], "doc_id long, text string").selectExpr("doc_id", "text", "explode(sequence(1, 20000)) AS n").drop("n")
    found = substring.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").union(one).repartition(8))
    got = {(r["doc_id"], r["_n_words"]): (r["n"], r["_n_removed"]) for r in found.groupBy("doc_id", "_n_words", "_n_removed").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert got == {(5, 81): (1, 0), (None, 70): (3, 0), (doc_id, 80): (20000, 80)}


def test_substring_of_two_thousand_copies_equals_brute_force(spark):
    docs = passages(4, 20)
    copies = [(1000 + i, docs[0][1]) for i in range(2000)]
    found = substring.dedup_substrings(spark.createDataFrame(docs + copies, "doc_id long, text string").repartition(8))
    got = {r["doc_id"]: (r["_n_words"], r["_n_removed"], r["_kept_sha256"]) for r in found.collect()}
    assert got == brute_substring(docs + copies)


def test_substring_of_a_very_long_text(spark):
    """Two texts of 10 MB: the later one loses what both share, to the word."""
    rng = random.Random(3)
    words = [rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(1_600_000)]
    docs = [(1, " ".join(words)), (2, "new " + " ".join(words[:800_000]) + " other " + " ".join(words[800_000:]))]
    assert len(docs[0][1]) > 10_000_000
    found = substring.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string")).drop("text", "_kept")
    got = {r["doc_id"]: (r["_n_words"], r["_n_removed"], r["_kept_sha256"]) for r in found.collect()}
    assert got[1][:2] == (1_600_000, 0)
    assert got[2] == (1_600_002, 1_600_000, hashlib.sha256(b"new other").hexdigest())
