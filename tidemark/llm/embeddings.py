"""Embedding near-dedup: spherical k-means cells and blocked cosine products.

Equal vectors are compared once, as one entry with a count. A k-means model is fitted to a bounded
sample and every vector is assigned to the cell of its nearest centre. Products are formed within
cells. A vector is also sent to another cell if one of that cell's vectors may be within the
threshold: a vector that is nearer to centre c than to a must lie beyond the plane between them, and
within the cell's radius around c, so a vector farther than that from the plane, or from the cell,
has no link there. Both bounds are exact, so no link is lost; each pair of cells is compared from
one side only. Cells are dealt in blocks of about ``BLOCK`` vectors, so a cell with a third of all
vectors is many tasks, and what is sent to a block is read as a stream.

How much the bounds leave out depends on the vectors: nearly everything between cells if they have
clusters, little if they have none: the work is then that of all block products and grows with the
square of the vectors. For such data ``sigmas`` limits the search. A vector at the threshold differs
from its partner in a direction that is as good as random, so its product with the difference of
two centres strays from what is expected by a known standard deviation; cells that it would reach
only beyond so many deviations are left out, and cells are made smaller. Links are then found with
a recall below 1, which is to be measured; none is made up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, connected_components, cut, table
from tidemark.llm.simhash import _forest

COSINE = 0.9
BLOCK = 2048
#: Bounds of the k-means model: rows and bytes of the sample that it is fitted to, and cells.
SAMPLE_ROWS, SAMPLE_BYTES, MAX_CELLS = 16_384, 1 << 25, 1024
#: Vectors of a cell, on average, where ``sigmas`` limits the search.
SMALL_CELL = 128
#: Copies of vectors that a task deals out at a time.
DEAL_ROWS = 1 << 17


def valid(vector: Column) -> Column:
    """Whether a vector links at all: not null, no null or non-finite component, not zero."""
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: list, width: int) -> np.ndarray:
    """Rows as unit vectors in double precision, padded with zeros to ``width``."""
    out = np.zeros((len(rows), width))
    for n, row in enumerate(rows):
        out[n, : len(row)] = row
    out /= np.abs(out).max(1, keepdims=True, initial=1e-300)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def fit_cells(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centres of spherical k-means over unit vectors."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(rounds):
        own = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres


def _lists(column: pa.Array) -> list:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    ends = ends - ends[0]
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _products(batches: Iterator[pa.RecordBatch], width: int, cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows (cell, block, probe, name, n, vector), a block's own vectors first -> (a, b, n).

    Rows with b are spanning links, rows without give a number of vectors linked to a.
    """
    key = None
    names: list[str] = []
    own, lengths, sizes, counts, pairs = np.zeros((0, width)), np.zeros(0), np.zeros(0), np.zeros(0), []

    def result(links: list[tuple[str, str]], found: list[tuple[str, int]]) -> pa.RecordBatch:
        a = [x for x, _ in links] + [x for x, _ in found]
        b = [x for _, x in links] + [None] * len(found)
        n = [0] * len(links) + [x for _, x in found]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(n, pa.int64())], ["a", "b", "n"])

    def close() -> pa.RecordBatch:
        links = []
        if pairs:
            x, y = (np.concatenate(p) for p in zip(*pairs, strict=True))
            root = _forest(len(names), x, y)
            links = [(names[i], names[root[i]]) for i in np.flatnonzero(root != np.arange(len(root)))]
        return result(links, [(names[i], int(counts[i])) for i in np.flatnonzero(counts)])

    for batch in batches:
        cells, blocks, probes, titles, n, vectors = (batch.column(i) for i in range(6))
        marks = np.stack([cells.to_numpy(), blocks.to_numpy()])
        probe, weight, title, rows = probes.to_numpy(), n.to_numpy(), titles.to_pylist(), _lists(vectors)
        starts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0) | (probe[1:] != probe[:-1])) + 1).tolist(), len(rows)]
        for first, end in zip(starts[:-1], starts[1:], strict=True):
            if first == end:
                continue
            if (mark := (int(marks[0, first]), int(marks[1, first]))) != key:
                if key is not None:
                    yield close()
                key, names, pairs = mark, [], []
                own, lengths, sizes, counts = np.zeros((0, width)), np.zeros(0), np.zeros(0), np.zeros(0)
            part = unit(rows[first:end], width)
            size, length = weight[first:end], np.array([len(r) for r in rows[first:end]])
            if not probe[first]:  # the block's own vectors: with each other and with those before
                before = len(names)
                names = names + title[first:end]
                own, lengths = np.concatenate([own, part]), np.concatenate([lengths, length])
                sizes, counts = np.concatenate([sizes, size]), np.concatenate([counts, np.zeros(len(part))])
                for at in range(0, len(part), 512):
                    x, y = np.nonzero((part[at : at + 512] @ own.T >= cosine) & (length[at : at + 512, None] == lengths))
                    x = x + at + before
                    x, y = x[x > y], y[x > y]
                    np.add.at(counts, x, sizes[y])
                    np.add.at(counts, y, sizes[x])
                    pairs.append((x, y))
                continue
            links, found = [], []
            for at in range(0, len(part), 512):
                x, y = np.nonzero((part[at : at + 512] @ own.T >= cosine) & (length[at : at + 512, None] == lengths))
                if not len(x):
                    continue
                x = x + at
                np.add.at(counts, y, size[x])
                some, head = np.unique(x, return_index=True)
                totals = np.bincount(x, sizes[y])
                links += [(title[first + i], names[y[h]]) for i, h in zip(some.tolist(), head.tolist(), strict=True)]
                found += [(title[first + i], int(totals[i])) for i in some.tolist()]
                pairs.append((y, y[head[np.searchsorted(some, x)]]))  # what one vector links belongs together
                if sum(len(p[0]) for p in pairs) > 4_000_000:
                    a, b = (np.concatenate(p) for p in zip(*pairs, strict=True))
                    pairs = [(np.arange(len(names)), _forest(len(names), a, b))]
            if links:
                yield result(links, found)
    if key is not None:
        yield close()


def groups(vectors: DataFrame, cosine: float = COSINE, sigmas: float | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    Links join vectors whose cosine in double precision is at least ``cosine``; vectors of different
    lengths do not link, nor do those that are null or zero or hold null or non-finite components:
    they are groups of their own. ``n_links`` counts rows, equal ones too. A null vec_id takes part
    but is never the smallest of its group; it is kept if its group has no other. Repeated rows are
    returned as often as they came and link with each other. Other columns are ignored. No rows give
    no rows. All links are found unless ``sigmas`` limits the search (4 finds nearly all).
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    name = F.when(valid(F.col("embedding")), F.md5(F.concat_ws(",", F.col("embedding").cast("array<string>"))))
    named = vectors.select(F.col("vec_id").cast("long"), "embedding", name.alias("name"))
    ids = cut(named.select("vec_id", "name"), "ids")
    distinct = cut(
        named.where("name IS NOT NULL").groupBy("name").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.any_value("embedding").alias("embedding")),
        "distinct",
    )
    total, width = distinct.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    if not total:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * width)))
    sample = distinct.orderBy("name").limit(most).select("embedding").toArrow().column(0).combine_chunks()  # a bounded sample, as bytes
    cells = min(MAX_CELLS, max(1, total // (BLOCK if sigmas is None else SMALL_CELL)))
    centres = fit_cells(unit(_lists(sample), width), cells)
    cells = len(centres)
    model = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = unit(_lists(batch.column(2)), width) @ model.value.T
            own = near.argmax(1) if len(near) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own.astype(np.int32)), pa.array(near[np.arange(len(own)), own])], ["name", "n", "embedding", "cell", "near"]
            )

    kind = distinct.schema["embedding"].dataType.simpleString()
    assigned = cut(distinct.select("name", "n", "embedding").mapInArrow(assign, f"name string, n long, embedding {kind}, cell int, near double"), "assigned")
    sizes, radius = np.zeros(cells, np.int64), np.zeros(cells)
    for cell, count, near in assigned.groupBy("cell").agg(F.count("*"), F.min("near")).collect():
        sizes[cell], radius[cell] = count, math.acos(max(-1.0, min(1.0, near)))
    blocks = np.maximum(1, -(-sizes // BLOCK))
    gap = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-6
    plan = spark.sparkContext.broadcast((sizes, radius, blocks))

    # Of a pair at the threshold, the standard deviation of what random parts add for centres one apart, by what the rest keeps.
    slack = None if sigmas is None else sigmas * math.sqrt(max(0.0, 1 - cosine * cosine)) / max(cosine, 1e-6) / math.sqrt(width)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, (sizes, radius, blocks) = model.value, plan.value
        apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
        first, every = np.cumsum(blocks) - blocks, int(blocks.sum())
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                near = unit(_lists(batch.column(2)), width) @ centres.T
                cell = batch.column(3).to_numpy()
                block = np.array([int(x[:8], 16) for x in batch.column(0).to_pylist()]) % blocks[cell]
                own = near[np.arange(len(cell)), cell]
                reach = (own[:, None] - near) <= (gap if slack is None else min(gap, slack)) * apart[cell] + 1e-9
                reach &= np.arccos(np.clip(near, -1, 1)) <= radius + math.acos(cosine) + 1e-6
                reach = (reach | (np.arange(cells) == cell[:, None])) & (sizes > 0)
                rows, to_cell = np.nonzero(reach)
                ends = np.cumsum(blocks[to_cell])
                start = 0
                while start < len(rows):  # portions of bounded size, however many blocks a vector is sent to
                    end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + DEAL_ROWS, "right")))
                    n = blocks[to_cell[start:end]]
                    row, target = np.repeat(rows[start:end], n), np.repeat(to_cell[start:end], n)
                    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    # Of two blocks one is sent to the other: the one from which it is less than half way round.
                    here, to = (first[cell] + block)[row], first[target] + number
                    ahead = (to - here) % every
                    keep = (2 * ahead < every) | ((2 * ahead == every) & (to > here))
                    row, target, number = row[keep], target[keep], number[keep]
                    taken, probe = batch.take(pa.array(row)), (to != here)[keep]
                    columns = [pa.array(x.astype(np.int32)) for x in (target, number, probe)]
                    yield pa.RecordBatch.from_arrays([*columns, taken.column(0), taken.column(1), taken.column(2)], ["cell", "block", "probe", "name", "n", "embedding"])
                    start = end

    dealt = assigned.mapInArrow(deal, f"cell int, block int, probe int, name string, n long, embedding {kind}")
    dealt = dealt.repartition("cell", "block").sortWithinPartitions("cell", "block", "probe")
    found = cut(dealt.mapInArrow(lambda b: _products(b, width, cosine), "a string, b string, n long"), "links")
    parts = connected_components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "name")
    linked = found.where("b IS NULL").groupBy(F.col("a").alias("name")).agg(F.sum("n").alias("links"))
    labelled = distinct.select("name", "least", "n").join(parts, "name", "left").join(linked, "name", "left")
    labelled = cut(labelled.select("name", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "name").alias("component")), "labelled")
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    names = cut(labelled.join(least, "component").select("name", "links", "component_id"), "names")
    joined = ids.join(names, "name", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.expr("vec_id <=> coalesce(component_id, vec_id)").alias("kept")
    )


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and group of every vector."""
    return groups(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9
), reach(a, b) AS (
  SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a
)
SELECT vec_id, (SELECT count(*) FROM e WHERE e.a = vec_id) AS n_links,
       least(vec_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = vec_id), vec_id)) AS component_id,
       vec_id <= coalesce((SELECT min(b) FROM reach WHERE reach.a = vec_id), vec_id) AS kept
FROM embeddings
"""
