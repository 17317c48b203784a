"""What the operators share: shared-folder tables, word rules and connected components."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as a Java, RE2 or Python pattern.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of an Arrow batch that goes to Python; Spark's own bound is 64 MB, for each task and on both sides.
BATCH_BYTES = "4m"
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Set ``BATCH_BYTES`` for the session unless it has a bound of its own, so long texts come in small batches."""
    if spark.conf.get(_BATCH_CONF) == "67108864b":
        spark.conf.set(_BATCH_CONF, BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset, and the master is local, a temporary folder is set instead.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local-cluster")) and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-tidemark-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: Paths that ``cut`` wrote within each open ``scratch``.
_OPEN: list[list[str]] = []


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there.

    Unlike a checkpoint the rows stay columnar and keep their size statistics, and executors
    that are lost take nothing with them.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    for paths in _OPEN:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in the shared folder, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """A block at whose end the tables that ``cut`` wrote in it are deleted, but for those taken out of the list."""
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield paths
    finally:
        _OPEN[:] = [p for p in _OPEN if p is not paths]
        for path in paths:
            remove(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of the undirected ``edges`` (a, b) as rows (node, component).

    ``component`` is the smallest node that can be reached, in the order of the column's type.
    Only nodes with an edge are returned. Null ends and loops are ignored, repeated edges count
    once, no edges give no rows.

    Each round hashes the nodes anew and merges each into the one of least hash among itself and
    its neighbours; edges within a merged node go. The node of the largest hash of a component is
    always merged away, so the rounds end without a cap, and as the order is random the nodes
    left fall by a constant factor in expectation, whatever the shape: the number of rounds grows
    with the logarithm of the largest component. The merges are then followed from the last round
    to the first. All steps are equi-joins between written tables, which adaptive execution can
    split where one node has a large share of the edges, and least values are combined before the
    shuffle.
    """
    clean = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    left = cut(clean.select(F.inline(ways)).distinct(), "edges")  # both ways in one pass
    merges: list[DataFrame] = []
    while not merges or not left.isEmpty():
        rank = lambda c, n=len(merges): F.struct(F.xxhash64(F.lit(n), c).alias("h"), F.col(c).alias("node"))
        heard = left.groupBy("a").agg(F.min(rank("b")).alias("least"))
        merges.append(cut(heard.select(F.col("a").alias("node"), F.least("least", rank("a"))["node"].alias("into")), "merges"))
        ends = [merges[-1].select(F.col("node").alias(c), F.col("into").alias(f"new_{c}")) for c in ("a", "b")]
        moved = left.join(ends[0], "a").join(ends[1], "b").where("new_a <> new_b")
        left = cut(moved.select(F.col("new_a").alias("a"), F.col("new_b").alias("b")).distinct(), "edges")
    parts = merges.pop()
    while merges:
        later = parts.select(F.col("node").alias("into"), F.col("into").alias("last"))
        parts = cut(merges.pop().join(later, "into", "left").select("node", F.coalesce("last", "into").alias("into")), "merges")
    least = parts.groupBy("into").agg(F.min("node").alias("component"))
    return parts.join(least, "into").select("node", "component")
