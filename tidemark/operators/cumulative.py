"""Point-in-time totals: what was known at the end of a period, never what came later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import any_null

COUNT = "game_count"


def sum0(x: Column) -> Column:
    """A sum that is zero where all values are null."""
    return F.coalesce(F.sum(x), F.lit(0))


def totals(df: DataFrame, keys: Sequence[str], sums: Sequence[str], maxima: Sequence[str] = (), count: str = COUNT) -> DataFrame:
    """One row for each key: sums (zero if all null), maxima (null if all null) and the number of rows.

    Rows with a null key are left out, as are columns that ``df`` lacks. Rates belong on the result:
    they are never averaged.
    """
    known = set(df.columns)
    aggs = [sum0(F.col(c)).alias(c) for c in sums if c in known] + [F.max(c).alias(c) for c in maxima if c in known]
    return df.where(~any_null(keys)).groupBy(*keys).agg(*aggs, F.count("*").alias(count))


def totals_until(df: DataFrame, keys: Sequence[str], period: str, until: int, sums: Sequence[str], maxima: Sequence[str] = (), count: str = COUNT) -> DataFrame:
    """``totals`` over the periods up to ``until``; the filter reaches the scan."""
    return totals(df.where(F.col(period) <= until), keys, sums, maxima, count)


def running_totals(
    df: DataFrame, keys: Sequence[str], period: str, last: Column, sums: Sequence[str], maxima: Sequence[str] = (), count: str = COUNT
) -> DataFrame:
    """``totals_until`` for every period at once, in one pass.

    Each key has a row for every period from its first to ``last`` (an expression over the keys),
    with or without rows of its own in that period. Rows are summed by key and period first, so the
    window sees one row for each; its totals hold until the period before the next, and are
    repeated for those. ``keys`` and ``period`` are the only shuffle.
    """
    by_period = totals(df, [*keys, period], sums, maxima, count)
    known = set(by_period.columns)
    order = Window.partitionBy(*keys).orderBy(period)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.lead(period).over(order) - 1, last)
    run = by_period.select(
        *keys,
        F.col(period).alias("_from"),
        until.cast(by_period.schema[period].dataType).alias("_until"),
        *[F.sum(c).over(so_far).alias(c) for c in sums if c in known],
        *[F.max(c).over(so_far).alias(c) for c in maxima if c in known],
        F.sum(count).over(so_far).alias(count),
    ).where("_from <= _until")
    values = [c for c in run.columns if c not in (*keys, "_from", "_until")]
    return run.select(*keys, F.explode(F.sequence("_from", "_until")).alias(period), *values)


def two_phase(df: DataFrame, keys: Sequence[str], game: str, sums: Sequence[str], maxima: Sequence[str] = (), count: str = COUNT) -> DataFrame:
    """Players' rows summed to games of a team, then to the team; ``count`` counts games, not rows."""
    games = totals(df, [*keys, game], sums, maxima, "_rows")
    return totals(games, keys, sums, maxima, count)


def typed_nulls(df: DataFrame, names: Sequence[str], kind: str = "double") -> DataFrame:
    """``df`` with null columns for figures that no source has yet."""
    return df.withColumns({c: F.lit(None).cast(kind) for c in names if c not in df.columns})
