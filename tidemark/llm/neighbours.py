"""Nearest neighbours by a block matrix join of quantised vectors.

Equal vectors are one class that carries its smallest ids, as no more than those can be among the
nearest. Classes that hold queries are dealt to blocks and all classes to streams; every block meets
every stream once, in tiles. In a tile the vectors are coded as int8 components with a scale and with
the exact length of the error that the coding leaves. By the triangle inequality the integer product
of two codes and the two errors bound a distance from below and above. Pairs whose lower bound is
within the query's least upper bounds, or what it has found so far, survive; they are recomputed from
the original vectors in double precision and pushed to the query's heap, which holds as many classes
as rows are wanted. The heaps of all streams are merged in the same way.

The bounds are exact, so the neighbours are those of a full comparison. A task holds one block, its
heaps and one tile's survivors, however many near copies its vectors have, and returns no more than
the heaps.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, cut, table
from tidemark.llm.embeddings import _lists, valid

NEAREST, EVERY = 10, 100
#: Queries of a block and their bytes in double precision, classes of a stream at least, and streams at most.
QUERY_BLOCK, BLOCK_BYTES, STREAM_ROWS, MAX_STREAMS = 16_384, 1 << 25, 4096, 1024
#: Queries and candidates of one product, and bytes of the pairs that are recomputed at a time.
TILE_QUERIES, TILE_ROWS, PAIR_BYTES = 512, 1024, 1 << 22
#: Components up to which sums of int8 products are exact in single precision: 1040 * 127 * 127 < 2 ** 24.
EXACT_WIDTH = 1040


def quantise(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scales, errors) of vectors: codes times scale is the vector, but for an error of the length given."""
    scale = np.maximum(np.abs(rows).max(1, initial=0.0) / 127, 1e-300)
    codes = np.clip(np.rint(rows / scale[:, None]), -127, 127).astype(np.int8)
    left = rows - codes * scale[:, None]
    return codes, scale, np.sqrt((left * left).sum(1)) * (1 + 1e-9)


def bounds(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all distances between two sets of (codes as floats, scales, errors, squared lengths)."""
    with np.errstate(over="ignore", invalid="ignore"):
        product = (a[0] @ b[0].T).astype(np.float64) * a[1][:, None] * b[1]
        both = a[3][:, None] + b[3]
        square, slack = both - 2 * product, 1e-13 * both
        error = a[2][:, None] + b[2]
        lower = np.sqrt(np.maximum(square - slack, 0)) * (1 - 1e-9) - error
        upper = np.sqrt(np.maximum(square + slack, 0)) * (1 + 1e-9) + error
    return np.nan_to_num(lower, nan=-np.inf, posinf=np.inf), np.nan_to_num(upper, nan=np.inf, posinf=np.inf)


def coded(rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """What ``bounds`` takes: codes as floats, scales, errors and squared lengths of the coded vectors."""
    codes, scale, error = quantise(rows)
    values = codes.astype(np.float32 if rows.shape[1] <= EXACT_WIDTH else np.float64)
    return values, scale, error, np.square(values, dtype=np.float64).sum(1) * scale * scale


#: An entry of a heap, the farthest first: all signs are turned. No id counts as larger than any.
Entry = tuple[float, int, int, int]


def entry(score: float, vec_id: int | None, name: int) -> Entry:
    return -score, -(vec_id is None), -(vec_id or 0), -name


def push(heap: list[Entry], new: Entry, wanted: int) -> None:
    if len(heap) < wanted:
        heapq.heappush(heap, new)
    elif new > heap[0]:
        heapq.heapreplace(heap, new)


class _Block:
    """The queries of one block in one stream, each with a heap of the nearest classes met."""

    def __init__(self, wanted: int) -> None:
        self.wanted = wanted
        self.names: list[int] = []
        self.parts: list[np.ndarray] = []
        self.heaps: list[list[Entry]] = []

    def ask(self, names: list[int], vectors: np.ndarray) -> None:
        self.names += names
        self.parts.append(vectors)

    def _start(self) -> None:
        self.rows = np.concatenate(self.parts)
        self.codes = coded(self.rows)
        self.parts = []
        self.heaps = [[] for _ in self.names]
        self.reached = np.full(len(self.names), np.inf)  # the heap's farthest, once it is full

    def meet(self, names: list[int], least: list[int | None], vectors: np.ndarray) -> int:
        """Take in candidates; the number of pairs that had to be recomputed."""
        if not self.names:
            return 0
        if self.parts:
            self._start()
        others, survived = coded(vectors), 0
        step = max(1, PAIR_BYTES // (8 * max(1, vectors.shape[1])))
        for q in range(0, len(self.names), TILE_QUERIES):
            mine = tuple(x[q : q + TILE_QUERIES] for x in self.codes)
            for c in range(0, len(names), TILE_ROWS):
                lower, upper = bounds(mine, tuple(x[c : c + TILE_ROWS] for x in others))
                most = self.reached[q : q + TILE_QUERIES]
                if upper.shape[1] >= self.wanted:
                    most = np.minimum(most, np.partition(upper, self.wanted - 1, axis=1)[:, self.wanted - 1])
                x, y = np.nonzero(lower <= most[:, None])
                survived += len(x)
                for at in range(0, len(x), step):
                    self._recompute(x[at : at + step] + q, y[at : at + step] + c, names, least, vectors)
        return survived

    def _recompute(self, x: np.ndarray, y: np.ndarray, names: list[int], least: list[int | None], vectors: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            apart = self.rows[x] - vectors[y]
            apart *= apart
            score = np.sqrt(np.add.accumulate(apart, axis=1, out=apart)[:, -1]) if apart.shape[1] else np.zeros(len(x))
        near = score <= self.reached[x]
        for i, j, s in zip(x[near].tolist(), y[near].tolist(), score[near].tolist(), strict=True):
            heap = self.heaps[i]
            push(heap, entry(s, least[j], names[j]), self.wanted)
            if len(heap) == self.wanted:
                self.reached[i] = -heap[0][0]

    def left(self) -> Iterator[pa.RecordBatch]:
        yield from _entries(zip(self.names, self.heaps, strict=False))


_PAIR = "query long, class long, least long, score double"


def _entries(heaps: Iterable[tuple[int, list[Entry]]]) -> Iterator[pa.RecordBatch]:
    rows = [(q, -name, None if absent else -vec_id, -score) for q, heap in heaps for score, absent, vec_id, name in heap]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    for at in range(0, len(rows), 1 << 16):
        columns = [pa.array(c, k) for c, k in zip(zip(*rows[at : at + (1 << 16)], strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["query", "class", "least", "score"])


def _tiles(batches: Iterator[pa.RecordBatch], wanted: int) -> Iterator[pa.RecordBatch]:
    """Rows (width, block, stream, candidate, class, least, embedding), a block's queries first -> its heaps."""
    key, block = None, None
    for batch in batches:
        marks = np.stack([batch.column(i).to_numpy() for i in range(4)])
        starts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for first, end in zip(starts[:-1], starts[1:], strict=True):
            if first == end:
                continue
            if (mark := tuple(marks[:3, first].tolist())) != key:
                if block is not None:
                    yield from block.left()
                key, block = mark, _Block(wanted)
            part = batch.slice(first, end - first)
            names, least, vectors = part.column(4).to_pylist(), part.column(5).to_pylist(), np.array(_lists(part.column(6)), np.float64)
            if marks[3, first]:
                block.meet(names, least, vectors)
            else:
                block.ask(names, vectors)
    if block is not None:
        yield from block.left()


def _merged(batches: Iterator[pa.RecordBatch], wanted: int) -> Iterator[pa.RecordBatch]:
    """Entries of all streams, by query -> the ``wanted`` nearest classes of each query."""
    query: int | None = None
    heap: list[Entry] = []
    done: list[tuple[int, list[Entry]]] = []
    for batch in batches:
        for q, name, least, score in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if q != query:
                if query is not None:
                    done.append((query, heap))
                query, heap = q, []
            push(heap, entry(score, least, name), wanted)
        yield from _entries(done)
        done = []
    if query is not None:
        yield from _entries([(query, heap)])


def neighbours(vectors: DataFrame, nearest: int = NEAREST, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` other rows of each row whose vec_id ``every`` divides.

    ``vectors`` has vec_id and embedding. ``score`` is the Euclidean distance of the original vectors,
    its squares added in order, in double precision; smaller is nearer, ties go to the smaller vec_id,
    those without one last. Null and zero vectors and those with null or non-finite components take no
    part. Vectors of different lengths have no distance and are no neighbours. A row is never its own
    neighbour, but others that repeat its vec_id or its vector are; repeated queries are answered each.
    A null vec_id is a candidate and no query. A query with fewer candidates gets all of them. Other
    columns are ignored; no rows give no rows.
    """
    spark, wanted = vectors.sparkSession, nearest + 1  # a query meets itself
    bound_batches(spark)
    name = F.md5(F.concat_ws(",", F.col("embedding").cast("array<double>").cast("array<string>")))
    own = vectors.where(valid(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", name.alias("name"))
    rows = cut(own.select("*", F.monotonically_increasing_id().alias("row")), "vectors")
    asked = rows.where(F.col("vec_id") % every == 0).select("vec_id", "row", "name")
    order = Window.partitionBy("name").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    few = rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= wanted)
    members = F.transform(F.array_sort(F.collect_list(F.struct("_place", "vec_id", "row"))), lambda m: F.struct(m["vec_id"].alias("vec_id"), m["row"].alias("row")))
    classes = few.groupBy("name").agg(F.min("row").alias("class"), F.any_value("embedding").alias("embedding"), members.alias("members"))
    classes = classes.join(asked.select("name", F.lit(1).alias("asked")).distinct(), "name", "left").withColumn("asked", F.coalesce("asked", F.lit(0)))
    classes = cut(classes, "classes")
    n, n_asked, width = classes.agg(F.count("*"), F.coalesce(F.sum("asked"), F.lit(0)), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    most = max(TILE_QUERIES, min(QUERY_BLOCK, BLOCK_BYTES // (8 * max(1, width))))
    blocks, streams = max(1, -(-n_asked // most)), min(MAX_STREAMS, max(1, -(-n // STREAM_ROWS)))
    place, own = F.xxhash64("class"), ["class", F.col("members")[0]["vec_id"].alias("least"), "embedding"]
    deal = lambda df, block, stream, candidate: df.select(F.size("embedding").alias("width"), block.alias("block"), "*").select("*", stream.alias("stream")).select("width", "block", "stream", F.lit(candidate).alias("candidate"), *own)
    every_block, every_stream = (F.explode(F.sequence(F.lit(0), F.lit(x - 1))) for x in (blocks, streams))
    candidates = deal(classes, every_block, F.pmod(place, F.lit(streams)).cast("int"), 1)
    queries = deal(classes.where("asked = 1"), F.pmod(place, F.lit(blocks)).cast("int"), every_stream, 0)
    dealt = candidates.union(queries).repartition("width", "block", "stream").sortWithinPartitions("width", "block", "stream", "candidate")
    met = dealt.mapInArrow(lambda b: _tiles(b, wanted), _PAIR).repartition("query").sortWithinPartitions("query")
    best = cut(met.mapInArrow(lambda b: _merged(b, wanted), _PAIR), "nearest")
    row = F.transform("members", lambda m: F.struct(F.col("score"), m["vec_id"].isNull().alias("absent"), m["vec_id"].alias("vec_id"), m["row"].alias("row")))
    near = best.join(classes.select("class", "members"), "class").groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list(row))), 1, wanted).alias("near"))
    found = asked.join(classes.select("name", F.col("class").alias("query")), "name").join(near, "query")
    found = found.select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(F.filter("near", lambda x: x["row"] != F.col("row")), 1, nearest)).alias("rank", "_near"))
    return found.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("_near.vec_id").alias("vec_id"), F.col("_near.score").alias("score"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector among all others."""
    return neighbours(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda s, y: s + y, 0.0::DOUBLE)) AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM d QUALIFY rank <= 10
"""
