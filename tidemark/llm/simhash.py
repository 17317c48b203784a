"""SimHash near-dedup over a Gray-order hierarchical index.

Each document gets a 64-bit fingerprint of its three-word shingles; fingerprints that differ in at
most ``MAX_BITS`` bits are linked, and the links' components are the groups of near copies.

Only distinct fingerprints are indexed, so a group of exact copies of any size is one entry.

* Fingerprints are sorted by Gray rank over ranges, so neighbours share most of their bits.
* The bits on which a run of neighbours agrees are factored into a node above them, those on which
  a run of nodes agrees into a node above these. A node keeps only the bits that its own upper node
  does not have, as a masked pattern.
* A search goes down from the top. The differences of a fingerprint from the patterns on its way
  add up, and a node is left, with all that is below it, as soon as there are more than ``MAX_BITS``.

The index is split between Spark's tasks: the ranges are the blocks at the foot of the upper part,
whose size is bounded (``MAX_BLOCKS`` nodes) and which every task has; each fingerprint goes down it
and is sent, with the differences so far, to the blocks that it reaches. There the lower part of the
index is built over the block's own fingerprints, and the search goes on to its end. Of two
blocks only the earlier is sent to the later. Each block passes on a spanning forest of the links
it finds, never all pairs.

In sparse data a fingerprint reaches the blocks whose common leading bits are within two of its own:
half of 1 + k + k(k-1)/2 of 2^k blocks, 11 of 64.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, connected_components, cut, table

MAX_BITS = 2
FANOUT = 16
SEED = 42
#: Fingerprints of a block, and how many blocks there are at least and at most; beyond the most, blocks grow instead.
BLOCK_ROWS, MIN_BLOCKS, MAX_BLOCKS = 1 << 18, 64, 1 << 16
#: Steps of a search that are taken at once.
STEPS = 1 << 16


def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint of one text.

    A-Z are lower-cased; fewer than three words make one shingle, none give zero, as null does.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) < 3:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED)), "<u8", len(words) - 2)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(x.as_py()) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(bits: Column) -> Column:
    """Position of ``bits`` in the Gray sequence, as a long that sorts in unsigned order."""
    rank = bits
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that each of n entries reaches over the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (before == root).all():
            return root


class GrayIndex:
    """A hierarchy of masked bit patterns over entries in Gray order.

    ``ones`` and ``any_`` are the bitwise AND and OR of what each entry stands for: twice the
    fingerprints, or a block's figures.
    """

    def __init__(self, ones: np.ndarray, any_: np.ndarray) -> None:
        #: (pattern, mask of the bits that are decided here) of each node, by level from the entries up.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        #: Nodes left by a search at each level, and entries below them are never looked at.
        self.pruned: list[int] = []
        agreed = ~(ones ^ any_)
        while len(ones) > FANOUT:
            at = np.arange(0, len(ones), FANOUT)
            upper, upper_any = np.bitwise_and.reduceat(ones, at), np.bitwise_or.reduceat(any_, at)
            above = ~(upper ^ upper_any)
            self.levels.append((ones, agreed & ~above[np.arange(len(ones)) // FANOUT]))
            ones, any_, agreed = upper, upper_any, above
        self.levels.append((ones, agreed))
        self.pruned = [0] * len(self.levels)

    def search(self, bits: np.ndarray, apart: np.ndarray, known: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, entry, differences) of all entries that each of ``bits`` reaches, a portion after the other.

        ``apart`` are the differences so far, in the bits of the mask ``known``, which are not compared again.
        """
        skip = ~np.uint64(known)
        top = len(self.levels) - 1
        roots = len(self.levels[top][0])
        for first in range(0, len(bits), max(1, STEPS // FANOUT)):
            some = np.arange(first, min(len(bits), first + max(1, STEPS // FANOUT)))
            pending = [(top, np.repeat(some, roots), np.tile(np.arange(roots), len(some)), np.repeat(apart[some], roots))]
            while pending:
                level, query, node, so_far = pending.pop()
                if len(query) > STEPS:
                    pending += [(level, query[i : i + STEPS], node[i : i + STEPS], so_far[i : i + STEPS]) for i in range(0, len(query), STEPS)]
                    continue
                pattern, decided = self.levels[level]
                so_far = so_far + np.bitwise_count((bits[query] ^ pattern[node]) & decided[node] & skip)
                near = so_far <= MAX_BITS
                self.pruned[level] += len(near) - int(near.sum())
                query, node, so_far = query[near], node[near], so_far[near]
                if not len(query):
                    continue
                if not level:
                    yield query, node, so_far
                    continue
                child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                there = child < len(self.levels[level - 1][0])
                pending.append((level - 1, np.repeat(query, FANOUT)[there], child[there], np.repeat(so_far, FANOUT)[there]))


def _deal(batches: Iterator[pa.RecordBatch], upper: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows (block, fp) -> (target, probe, apart, fp): for each fingerprint its own block and the later ones that it reaches."""
    blocks, ones, any_ = upper
    index = GrayIndex(ones, any_)
    for batch in batches:
        own, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own, np.zeros(len(own), np.int32), np.zeros(len(own), np.int32), fp)], _DEALT)
        for query, node, apart in index.search(fp.view(np.uint64), np.zeros(len(fp), np.int64)):
            later = blocks[node] > own[query]
            query, node, apart = query[later], node[later], apart[later]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (blocks[node], np.ones(len(query), np.int32), apart.astype(np.int32), fp[query])], _DEALT)


_DEALT = ["target", "probe", "apart", "fp"]


class _Block:
    """The lower part of the index, over one block's own fingerprints, and what its links connect."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.root = bits, np.arange(len(bits))
        self.index = GrayIndex(bits, bits)
        self.agreed = ~int(np.bitwise_and.reduce(bits) ^ np.bitwise_or.reduce(bits)) & (1 << 64) - 1
        # No bit that the whole block shares tells its own fingerprints apart.
        for x, y, _ in self.index.search(bits, np.zeros(len(bits), np.int64), self.agreed):
            self._join(x, y)

    def _join(self, x: np.ndarray, y: np.ndarray) -> None:
        linked = x != y
        if linked.any():
            every = np.arange(len(self.root))
            self.root = _forest(len(every), np.concatenate([x[linked], every]), np.concatenate([y[linked], self.root]))

    def probe(self, bits: np.ndarray, apart: np.ndarray) -> pa.RecordBatch:
        """A link of each fingerprint of an earlier block that has any here; those that it links are connected."""
        found = [f[:2] for f in self.index.search(bits, apart, self.agreed)]
        query, entry = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(2))
        some, first = np.unique(query, return_index=True)
        self._join(entry, entry[first[np.searchsorted(some, query)]])
        return _pairs(bits[some], self.bits[entry[first]])

    def links(self) -> pa.RecordBatch:
        far = np.flatnonzero(self.root != np.arange(len(self.root)))
        return _pairs(self.bits[far], self.bits[self.root[far]])


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (target, probe, apart, fp) sorted so, own fingerprints in Gray order -> links (a, b)."""
    target, held, block = None, [], None
    for batch in batches:
        to, probe, apart, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(to):
            continue
        starts = np.flatnonzero(np.r_[True, (to[1:] != to[:-1]) | (probe[1:] != probe[:-1])])
        for first, end in zip(starts, [*starts[1:], len(to)], strict=True):
            if to[first] != target:
                if target is not None:
                    yield (block or _Block(np.concatenate(held))).links()
                target, held, block = to[first], [], None
            bits = fp[first:end].view(np.uint64)
            if not probe[first]:
                held.append(bits)
                continue
            block = block or _Block(np.concatenate(held))
            yield block.probe(bits, apart[first:end].astype(np.int64))
    if target is not None:
        yield (block or _Block(np.concatenate(held))).links()


def near_links(distinct: DataFrame) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints ``fp``; together they connect what is linked.

    Fingerprints are not null and none comes twice. No rows give no links.
    """
    spark = distinct.sparkSession
    rows = distinct.count()
    blocks = min(MAX_BLOCKS, max(MIN_BLOCKS, -(-rows // BLOCK_ROWS)))
    rank = gray_rank(F.col("fp"))
    ranged = distinct.select("fp").repartitionByRange(blocks, rank).sortWithinPartitions(rank)
    # Written, so that a range keeps its number whoever reads it; numbers follow the order of the ranges.
    indexed = cut(ranged.select(F.spark_partition_id().alias("block"), "fp"), "indexed")
    nodes = indexed.groupBy("block").agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("any"))
    found = sorted(nodes.collect())  # one row a block
    upper = tuple(np.array([r[k] for r in found], t) for k, t in ((0, np.int32), (1, np.int64), (2, np.int64)))
    sent = spark.sparkContext.broadcast((upper[0], upper[1].view(np.uint64), upper[2].view(np.uint64)))
    dealt = indexed.mapInArrow(lambda b: _deal(b, sent.value), "target int, probe int, apart int, fp long")
    dealt = dealt.repartition("target").sortWithinPartitions("target", "probe", rank)
    return dealt.mapInArrow(_search, "a long, b long")


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text; more columns are ignored).

    ``component_id`` is the smallest doc_id of the group over links of at most two bits. Null and
    empty texts have fingerprint zero and are linked like any other. A null doc_id takes part but
    names no group: a group of such rows alone has a null component_id. Repeated rows are
    returned as often as they came. No rows give no rows.
    """
    prints = cut(fingerprints(docs), "prints")
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    parts = connected_components(near_links(distinct)).withColumnRenamed("node", "fp")
    labelled = distinct.join(parts, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    labelled = cut(labelled, "labelled")
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    names = cut(labelled.join(least, "component").select("fp", "component_id"), "names")
    return prints.join(names, "fp").select("doc_id", "fp", "component_id")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    found = groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, one document of each group: that with the smallest doc_id.

    Of rows that repeat this doc_id one stays, the first by the hash of its text. Rows without a
    doc_id cannot be told apart by it and stay.
    """
    heads = groups(docs).where("doc_id = component_id").select("doc_id").distinct()
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), F.coalesce("text", F.lit("")))
    once = docs.join(heads, "doc_id", "left_semi").withColumn("_nth", F.row_number().over(order)).where("_nth = 1")
    return once.select(docs.columns).union(docs.where("doc_id IS NULL"))
