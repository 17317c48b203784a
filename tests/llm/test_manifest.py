"""The Merkle manifest against a plain tree, with runs that partitions cut at any place."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import manifest


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """Levels of nodes, from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([sha("".join(at[i : i + 8])) for i in range(0, len(at), 8)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        start = at - at % 8
        out.append(("".join(level[start:at]), "".join(level[at + 1 : start + 8])))
        at //= 8
    return out


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) -> sorted result rows."""
    first = lambda x: (x is not None, x if x is not None else 0)
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((first(row[0]), plain_leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([leaf for _, leaf, _ in sorted(groups[g], key=lambda x: x[:2])]) for g in names}
    upper = plain_tree([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for at, (_, leaf, row) in enumerate(sorted(groups[g], key=lambda x: x[:2])):
            kin = siblings(trees[g], at) + siblings(upper, place)
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                node = plain_leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for a, b in kin:
                node = sha(a + node + b)
            out.append((row[0], leaf, trees[g][-1][0], upper[-1][0], sha("".join(a + b for a, b in kin)), node, node == upper[-1][0]))
    return sorted(out, key=repr)


def found(spark, tmp_path, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df.withColumns(more).write.parquet(f"{tmp_path}/documents.parquet")
    got = manifest.op13_merkle_manifest(spark, str(tmp_path)).collect()
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got], key=repr)


@pytest.fixture
def many_partitions(spark):
    """Range partitions stay as many as asked for, so runs are cut at any place."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", [1, 2])
def test_trees_equal_a_plain_tree(spark, tmp_path, many_partitions, seed):
    rng = random.Random(seed)
    sizes = {None: 3, "": 1, "a": 1, "b": 8, "c": 9, "d": 64, "é": 65, "E": 513, "z": 6000} if seed == 1 else {"en": 4097, "de": 7, "fr": rng.randrange(1, 700)}
    rows, ids = [], list(range(-50, 20_000))
    rng.shuffle(ids)
    for lang, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "Some Text é", "lower", "X" * rng.randrange(50)])
            rows.append((ids.pop(), rng.choice([None, "web", ""]), lang, rng.choice([None, 5]), text))
    rng.shuffle(rows)
    assert found(spark, tmp_path, rows) == brute(rows)


def test_repeated_rows_null_ids_long_texts_and_clashing_columns(spark, tmp_path, many_partitions):
    rows = [(7, "s", "en", 1, "Aa")] * 20 + [(None, None, None, None, None)] * 9 + [(7, "t", "en", 1, "Aa"), (None, "s", "en", 2, "Q" * 3_000_000), (9, "s", "de", 0, "")]
    clash = {"_g": F.lit("x"), "leaf": F.lit(1), "at": F.lit(2), "root": F.lit("y"), "key": F.lit(None).cast("string")}
    assert found(spark, tmp_path, rows, **clash) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(4, "s", "en", 1, "Tamper")], [(4, None, None, None, None)]])
def test_no_rows_and_one_row(spark, tmp_path, rows):
    assert found(spark, tmp_path, rows) == brute(rows)


def test_open_runs_are_few(spark, tmp_path, many_partitions):
    """A partition leaves at most two open runs a level of a group, however many leaves it holds."""
    rows = spark.range(50_000).select(F.col("id").alias("k"), F.lit("g").alias("g"))
    leaves, nodes = manifest.manifest(rows, ["k"], "g", "k")
    assert nodes.where("level > 0").count() == sum(-(-50_000 // 8**k) for k in range(1, 7))
    assert nodes.where("level = 0").count() <= 13 * 14
    assert manifest.roots(nodes).first().root == plain_tree([plain_leaf((k,)) for k in range(50_000)])[-1][0]
