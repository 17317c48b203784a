"""Data-quality checks as rows (check, passed, n): n counts what speaks against it, or the rows for ``not_empty``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checks(
    df: DataFrame, required: Sequence[str] = (), known: Sequence[str] = (), unique: Sequence[str] = (), within: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Whether there are rows, columns are present and without nulls, keys are unique and values within bounds.

    Row checks are one aggregation; uniqueness needs a shuffle by the key.
    """
    counts = {"not_empty": F.count(F.lit(1))}
    counts |= {f"no_nulls:{c}": F.count_if(F.col(c).isNull()) for c in known}
    counts |= {f"within:{c}": F.count_if((F.col(c) < low) | (F.col(c) > high)) for c, (low, high) in (within or {}).items()}
    wide = df.agg(*[v.alias(f"c{i}") for i, v in enumerate(counts.values())])
    rows = [F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("n")) for i, name in enumerate(counts)]
    rows += [F.struct(F.lit(f"required:{c}").alias("check"), F.lit(int(c not in df.columns)).cast("long").alias("n")) for c in required]
    found = wide.select(F.inline(F.array(*rows)))
    if unique:
        repeated = df.groupBy(*unique).agg(F.count("*").alias("_n")).where("_n > 1").agg(F.count("*").alias("n"))
        found = found.union(repeated.select(F.lit(f"unique:{','.join(unique)}").alias("check"), "n"))
    passed = F.when(F.col("check") == "not_empty", F.col("n") > 0).otherwise(F.col("n") == 0)
    return found.select("check", passed.alias("passed"), "n")


def incomplete(df: DataFrame, season: str, period: str, expected: int) -> DataFrame:
    """(season, n_missing) of the seasons with fewer periods than expected."""
    seen = df.groupBy(season).agg(F.count_distinct(period).alias("_n"))
    return seen.where(F.col("_n") < expected).select(season, (F.lit(expected).cast("long") - F.col("_n")).alias("n_missing"))


def leaks(df: DataFrame, keys: Sequence[str], order: Sequence[str], stat: str, rolled: str, size: int) -> DataFrame:
    """Rows whose rolling mean is not that of the rows before them alone, recomputed from collected values."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-size, -1)
    again = df.withColumn("_v", F.collect_list(stat).over(w))
    mean = F.when(F.size("_v") > 0, F.aggregate("_v", F.lit(0.0), lambda s, x: s + x) / F.size("_v"))
    return again.where(~F.col(rolled).eqNullSafe(mean) & ~F.coalesce(F.abs(F.col(rolled) - mean) < 1e-9, F.lit(False))).drop("_v")
