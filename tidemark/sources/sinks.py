"""Sinks: partition replacement, merges into Parquet, copies, CSV and datasets with a lineage record."""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.filters import in_periods


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows for and leave the others; running it twice changes nothing.

    Rows are dealt by partition first, so each holds few files.
    """
    dealt = df.hint("rebalance", *[F.col(c) for c in by])
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None, keep_old: bool = False) -> DataFrame:
    """``target`` with the rows of ``source`` merged in by key, as a new frame with the target's columns.

    Matched rows take the source's ``update`` columns (all but the keys, unless named); with
    ``keep_old`` a null there keeps the old value. Rows of the source alone are added. Both sides
    are unique by key. Keys may be null: null equals null.
    """
    update = [c for c in target.columns if c not in keys] if update is None else list(update)
    a, b = target.select(F.lit(True).alias("_t"), "*").alias("a"), source.select(F.lit(True).alias("_s"), "*").alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    new, both = F.col("b._s").isNotNull(), F.col("a._t").isNotNull()
    columns = []
    for c in target.columns:
        old = F.col(f"a.{c}")
        if c not in source.columns:
            columns.append(old.alias(c))
        elif c in keys:
            columns.append(F.when(both, old).otherwise(F.col(f"b.{c}")).alias(c))
        elif c in update:
            value = F.coalesce(F.col(f"b.{c}"), old) if keep_old else F.col(f"b.{c}")
            columns.append(F.when(new, value).otherwise(old).alias(c))
        else:
            columns.append(F.when(both, old).otherwise(F.col(f"b.{c}")).alias(c))
    return a.join(b, on, "full_outer").select(*columns)


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(n_inserted, n_updated) that ``merge`` would make."""
    known = source.select(*keys).join(target.select(*keys, F.lit(1).alias("_hit")), list(keys), "left")
    return known.agg(F.count_if(F.col("_hit").isNull()).alias("n_inserted"), F.count_if(F.col("_hit").isNotNull()).alias("n_updated"))


def merge_into(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], keep_old: bool = False) -> str:
    """Merge ``source`` into the Parquet table at ``path``; returns the folder of the new version.

    The table is a folder of numbered versions: the new one is written beside the old and takes the
    next number at the end, so readers never see a part of it and a failed run leaves the old one.
    A number is taken once: of two writers that began from the same version the later one fails with
    RuntimeError, and nothing is lost. This holds where the file system creates a file only once.
    """
    number, current = _latest_version(spark, path)
    merged = merge(spark.read.parquet(current), source, keys, keep_old=keep_old) if current else source
    new = f"{path}/v-{number + 1}-{uuid.uuid4().hex}"
    merged.write.parquet(new)
    _take_number(spark, path, number + 1, new)
    return new


def _take_number(spark: SparkSession, path: str, number: int, version: str) -> None:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_current/{number}")
    try:
        out = mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark, False)
    except Exception as error:
        if "AlreadyExists" in str(error) or "already exists" in str(error):
            raise RuntimeError(f"version {number} of {path} was written by another merge; {version} is not part of the table") from error
        raise
    out.write(bytearray(version, "utf-8"))
    out.close()


def _latest_version(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The highest number that names a version, and its folder; 0 and null if there is none."""
    try:
        log = spark.read.text(f"{path}/_current", wholetext=True)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return 0, None
        raise
    number = F.col("_metadata.file_name").try_cast("long")
    row = log.where("value <> ''").select("value", number.alias("n")).agg(F.max("n"), F.max_by("value", "n")).first()
    return row[0] or 0, row[1]


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest version, null if there is none."""
    return _latest_version(spark, path)[1]


def copy_periods(spark: SparkSession, source: str, target: str, seasons: str | None = None, weeks: str | None = None) -> None:
    """Copy a table, or the partitions of some periods. A table without weeks is skipped if weeks are asked for."""
    df = spark.read.parquet(source)
    by = [c for c in ("season", "week") if c in df.columns]
    if weeks and by == ["season"]:
        return
    for c, spec in (("season", seasons), ("week", weeks)):
        if c in by:
            df = df.where(in_periods(F.col(c), spec))
    if by:
        write_partitions(df, target, by)
    else:
        df.write.mode("overwrite").parquet(target)


def stamped(folder: str, name: str, when: datetime.datetime | None = None) -> str:
    """The path of ``name`` in ``folder`` with a time, now by default, in its name: later ones sort after earlier ones."""
    when = when or datetime.datetime.now(datetime.UTC)
    return f"{folder.rstrip('/')}/{name}_{when:%Y%m%d_%H%M%S_%f}"


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in each file, under a folder that must be new."""
    df.write.option("header", "true").csv(path)


def write_dataset(df: DataFrame, path: str, keys: Sequence[str]) -> dict[str, int]:
    """Write ``df`` and, beside it, what was counted on the way: rows and nulls in the keys; no second pass."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys]]
    df.observe(seen, *counts).write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    record = {"columns": df.columns, **seen.get}
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}_lineage")
    return seen.get


def backup(df: DataFrame, path: str) -> None:
    """A copy that fails if there is one already."""
    df.write.mode("error").parquet(path)


def append_jdbc(df: DataFrame, url: str, name: str, properties: dict[str, str], batch: int = 1000) -> None:
    df.write.mode("append").jdbc(url, name, properties={**properties, "batchsize": str(batch)})
