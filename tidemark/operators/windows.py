"""Window operators over an entity's own sequence of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.metrics import ratio
from tidemark.functions.scalar import SENTINEL


def lead_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str], targets: Mapping[str, str], steps: int = 1) -> DataFrame:
    """``df`` with values of a later row of the same key: new name -> column. Null at the end."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({new: F.lead(old, steps).over(w) for new, old in targets.items()})


def rolling_means(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], stats: Sequence[str], sizes: Sequence[int] = (3, 5), sentinel: float | None = SENTINEL
) -> DataFrame:
    """``df`` with ``roll_{k}g_{stat}``: the mean over the k rows before each, its own never included.

    The sentinel counts as null; a mean has at least one value or is null. All frames share one
    sort.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    new = {}
    for k in sizes:
        for stat in stats:
            value = F.col(stat) if sentinel is None else F.nullif(F.col(stat), F.lit(sentinel))
            new[f"roll_{k}g_{stat}"] = F.avg(value).over(w.rowsBetween(-k, -1))
    return df.withColumns(new)


def rolling_ratios(df: DataFrame, pairs: Mapping[str, tuple[str, str]], sizes: Sequence[int] = (3, 5)) -> DataFrame:
    """``df`` with ratios of rolling means, null unless the denominator is positive: name -> (top, bottom)."""
    new = {}
    for k in sizes:
        for name, (top, bottom) in pairs.items():
            below = F.col(f"roll_{k}g_{bottom}")
            new[f"roll_{k}g_{name}"] = F.when(below > 0, ratio(f"roll_{k}g_{top}", below))
    return df.withColumns(new)


def sequence_numbers(df: DataFrame, entity: str, season: str, order: Sequence[str], sizes: Sequence[int] = (3, 5)) -> DataFrame:
    """``df`` with the place of each row in its season and career, and what follows from both.

    ``is_season_carryover``: an early row of a season with rows of earlier seasons before it;
    ``has_min_games_{k}g``: at least k rows before it.
    """
    career = F.row_number().over(Window.partitionBy(entity).orderBy(season, *order))
    own = F.row_number().over(Window.partitionBy(entity, season).orderBy(*order))
    df = df.withColumn("career_game_seq_num", career).withColumn("game_seq_num", own)
    early = (F.col("career_game_seq_num") > F.col("game_seq_num")) & (F.col("game_seq_num") <= min(sizes))
    df = df.withColumn("is_season_carryover", F.when(early, 1).otherwise(0))
    return df.withColumns({f"has_min_games_{k}g": F.when(F.col("career_game_seq_num") > k, 1).otherwise(0) for k in sizes})


def decreases(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(column, falls): how often a column that may only grow is smaller than in the row before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = df.select(*[(F.col(c) < F.lag(c).over(w)).alias(c) for c in columns])
    return marked.agg(*[F.count_if(F.col(c)).alias(c) for c in columns]).unpivot([], list(columns), "column", "falls")


def numbered(df: DataFrame, within: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    """``df`` with numbers from 1 in each partition of ``within``, in a total order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*order)))


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    return numbered(df, keys, order, "_nth").where("_nth = 1").drop("_nth")


def trend(df: DataFrame, keys: Sequence[str], order: Sequence[str], y: str, size: int = 3) -> DataFrame:
    """``df`` with the slope of ``y`` over the last ``size`` rows, its own included; null with fewer than two."""
    w = Window.partitionBy(*keys).orderBy(*order)
    seq = F.row_number().over(w)
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1 - size, 0)
    return df.withColumn("_seq", seq).withColumn(f"trend_{size}g_{y}", F.regr_slope(F.col(y), F.col("_seq")).over(frame)).drop("_seq")


def average_ranks(df: DataFrame, columns: Sequence[str], slices: int = 64) -> DataFrame:
    """``df`` with ``rank_{column}``: the mean place of each value among all, ties alike; null stays null.

    Values are counted first, so a frequent one is a single row. The counts are summed over slices
    of the value range, whose number is fixed, then within each slice, so no task holds all values.
    The slices' bounds are a subquery: nothing runs until the result does.
    """
    for c in columns:
        counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_v")).agg(F.count("*").alias("_n"))
        bounds = counts.select(F.percentile_approx("_v", [i / slices for i in range(1, slices)], 1000)).scalar()
        counts = counts.withColumn("_bounds", bounds).withColumn("_slice", F.size(F.filter("_bounds", lambda b: b < F.col("_v")))).drop("_bounds")
        all_before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.groupBy("_slice").agg(F.sum("_n").alias("_all"))
        starts = starts.select("_slice", F.coalesce(F.sum("_all").over(all_before), F.lit(0)).alias("_start"))
        within = Window.partitionBy("_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ends = F.col("_start") + F.sum("_n").over(within)
        ranks = counts.join(F.broadcast(starts), "_slice").select("_v", (ends - (F.col("_n") - 1) / 2).alias(f"rank_{c}"))
        df = df.join(ranks, df[c] == ranks["_v"], "left").drop("_v")
    return df
