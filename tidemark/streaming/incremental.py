"""Totals kept up to date from a stream of files, and windowed counts with late rows dropped."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.cumulative import totals


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where it is unset and the master is local."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    return tempfile.mkdtemp(prefix="spark-tidemark-")


def stream_totals(
    spark: SparkSession, path: str, rows: Callable[[DataFrame], DataFrame], keys: Sequence[str], sums: Sequence[str], count: str, folder: str | None = None, files: int = 8
) -> DataFrame:
    """Totals by key over all files that have arrived at ``path``; a later call with the same ``folder`` reads the new ones only.

    A batch takes at most ``files`` files.

    Each batch adds its own partial totals as a folder named by the batch, so a batch that is
    repeated after a failure replaces itself. The result sums the parts.
    """
    folder = folder or f"{shared_dir(spark)}/totals-{uuid.uuid4().hex}"
    source = path if "." not in path.rsplit("/", 1)[-1] else path.rsplit("/", 1)[0]
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", str(files))
    if source != path:
        reader = reader.option("pathGlobFilter", path.rsplit("/", 1)[-1])

    def add(batch: DataFrame, number: int) -> None:
        totals(rows(batch), keys, sums, count=count).write.mode("overwrite").parquet(f"{folder}/parts/batch={number}")

    query = reader.parquet(source).writeStream.foreachBatch(add).option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True).start()
    query.awaitTermination()
    parts = spark.read.parquet(f"{folder}/parts")
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], F.sum(count).alias(count))


def windowed_counts(stream: DataFrame, time: str, keys: Sequence[str], late: str = "1 hour", size: str = "1 day", slide: str | None = None) -> DataFrame:
    """Counts by key and event-time window; rows later than ``late`` are dropped and their state is freed."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    return stream.withWatermark(time, late).groupBy(window.alias("window"), *keys).count()


def sessions(stream: DataFrame, time: str, keys: Sequence[str], gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Counts by key and session: rows with no more than ``gap`` between them."""
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("session"), *keys).count()
