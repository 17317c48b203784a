"""Aggregations beyond plain totals: deduplication, row selection, sets, profiles, reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import any_null, kind_of_text, text


def merge_duplicates(df: DataFrame, keys: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """One row for each key: means of numbers, the smallest value that is not null of ids and others."""
    aggs = []
    for f in df.schema.fields:
        if f.name in keys:
            continue
        number = isinstance(f.dataType, T.NumericType) and f.name not in ids
        aggs.append((F.avg(f.name) if number else F.min(f.name)).alias(f.name))
    return df.groupBy(*keys).agg(*aggs).select(df.columns)


def eligible(df: DataFrame, keys: Sequence[str], condition: Column, least: int) -> DataFrame:
    """All rows of the keys that have at least ``least`` rows with ``condition``."""
    counts = df.where(condition).groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    return df.join(counts.drop("_n"), list(keys), "left_semi")


def summary_rows(df: DataFrame, keys: Sequence[str], is_total: Column, order: Sequence[Column]) -> DataFrame:
    """One row for each key: the first that is a total of several parts, else the first."""
    w = Window.partitionBy(*keys).orderBy(F.coalesce(is_total, F.lit(False)).desc(), *order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def total_rows_only(df: DataFrame, keys: Sequence[str], is_total: Column) -> DataFrame:
    """Of keys with several rows only the totals; all rows of a key that has no total or is single."""
    w = Window.partitionBy(*keys)
    total = F.coalesce(is_total, F.lit(False))
    marked = df.withColumn("_total", total).withColumn("_any", F.max("_total").over(w)).withColumn("_n", F.count("*").over(w))
    return marked.where("_n = 1 OR NOT _any OR _total").drop("_total", "_any", "_n")


def set_text(x: Column) -> Column:
    """Aggregate: the sorted distinct values joined by commas."""
    return F.array_join(F.transform(F.array_sort(F.collect_set(x)), lambda v: v.cast("string")), ",")


def first_filled(df: DataFrame, keys: Sequence[str], order: Column, largest: Sequence[str] = ()) -> DataFrame:
    """One row for each key: of each column the first value that is not blank, of ``largest`` the maximum."""
    rest = [c for c in df.columns if c not in keys]
    aggs = [
        (F.max(c) if c in largest else F.min_by(text(c), F.when(text(c).isNotNull(), order))).alias(c)
        for c in rest
    ]
    return df.groupBy(*keys).agg(*aggs)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with n."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def distinct_of(*columns: str) -> Column:
    """Aggregate: distinct combinations without a null."""
    return F.count_distinct(*[F.col(c) for c in columns])


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_rows, n_known, n_null, n_distinct, least, most, mean) for numeric columns, in one pass over the rows.

    Distinct values are counted exactly: the columns become rows and each value is counted once
    for its column before anything is gathered.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    values = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    known = F.when(F.col("value").isNotNull(), F.col("n"))
    return values.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(known), F.lit(0)).alias("n_known"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum(known)).alias("mean"),
    )


def null_counts(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by, column, n_null) for each group and column."""
    wide = df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([F.col(b) for b in by], list(columns), "column", "n_null")


def quantiles(values: DataFrame, shares: Sequence[float], slices: int = 64) -> DataFrame:
    """(column, q0, q1, ...): exact quantiles, interpolated, of counted values (column, value, n), each value once.

    Values are cut at approximate quantiles into slices, whose counts tell in which slice a wanted
    rank lies; only there are values ranked. So no task holds all values of a column, however many
    differ. Null values do not count.
    """
    known = values.where("value IS NOT NULL").select("column", "value", "n")
    bounds = known.groupBy("column").agg(F.percentile_approx("value", [i / slices for i in range(1, slices)], 1000).alias("_cuts"))  # a row for each column
    cut = known.join(F.broadcast(bounds), "column").withColumn("_slice", F.size(F.filter("_cuts", lambda b: b < F.col("value")))).drop("_cuts")
    sizes = cut.groupBy("column", "_slice").agg(F.sum("n").alias("_size"))
    before, all_ = Window.partitionBy("column").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("column")
    starts = sizes.select("column", "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"), F.sum("_size").over(all_).alias("_total"))
    within = Window.partitionBy("column", "_slice").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = cut.join(F.broadcast(starts), ["column", "_slice"]).withColumn("_end", F.col("_start") + F.sum("n").over(within))  # at most slices rows a column
    out = []
    for i, share in enumerate(shares):
        place = (F.col("_total") - 1) * F.lit(float(share))
        for name, rank in (("l", F.floor(place)), ("h", F.ceil(place))):
            out.append(F.max(F.when((F.col("_end") > rank) & (F.col("_end") - F.col("n") <= rank), F.col("value"))).alias(f"_{name}{i}"))
        out.append(F.max(place - F.floor(place)).alias(f"_f{i}"))
    found = ranked.groupBy("column").agg(*out)
    return found.select("column", *[(F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * F.col(f"_f{i}")).alias(f"q{i}") for i in range(len(shares))])


def counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n): how often each value of each numeric column occurs."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    return long.groupBy("column", "value").agg(F.count("*").alias("n"))


def outliers(df: DataFrame, columns: Sequence[str], reach: float = 3.0) -> DataFrame:
    """(column, q1, q3, n_outliers): values beyond ``reach`` times the quartile distance, by exact quartiles."""
    values = counted(df, columns).where("value IS NOT NULL")
    bounds = quantiles(values, (0.25, 0.75)).select("column", F.col("q0").alias("q1"), F.col("q1").alias("q3"))
    far = (F.col("value") < F.col("q1") - reach * (F.col("q3") - F.col("q1"))) | (F.col("value") > F.col("q3") + reach * (F.col("q3") - F.col("q1")))
    joined = values.join(F.broadcast(bounds), "column")  # a row for each column
    return joined.groupBy("column", "q1", "q3").agg(F.coalesce(F.sum(F.when(far, F.col("n"))), F.lit(0)).alias("n_outliers"))


def correlations(df: DataFrame, columns: Sequence[str], least: float = 0.0) -> DataFrame:
    """(a, b, r) of every pair of columns with \\|r\\| >= ``least``, in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    long = wide.unpivot([], [F.col(f"`{a}|{b}`") for a, b in pairs], "pair", "r")
    bits = F.split("pair", r"\|")
    return long.select(bits[0].alias("a"), bits[1].alias("b"), "r").where(F.abs("r") >= least)


def key_values(df: DataFrame, keys: Sequence[str], field: str, value: str, names: Mapping[str, str]) -> DataFrame:
    """(field, value) rows as columns: field -> new name; of repeated fields the largest value."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(field) == k, F.col(value))).alias(v) for k, v in names.items()])


def transposed(df: DataFrame, keys: Sequence[str], category: str, parts: Sequence[str], names: Mapping[str, str], part_name: str = "team") -> DataFrame:
    """Rows of categories with a column for each part -> a row for each part with a column for each category."""
    long = df.unpivot([F.col(k) for k in [*keys, category]], list(parts), part_name, "_value")
    return key_values(long, [*keys, part_name], category, "_value", names)


def slots(df: DataFrame, keys: Sequence[str], slot: str, metrics: Sequence[str], numbers: Sequence[int]) -> DataFrame:
    """Rows numbered by ``slot`` as prefixed columns ``s{n}_{metric}``."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(slot) == n, F.col(m))).alias(f"s{n}_{m}") for n in numbers for m in metrics])


def statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, std, std_pop, skew, kurtosis, median): a row for each column; skew and kurtosis of the population."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    moments = long.groupBy("column").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.stddev_pop("value").alias("std_pop"),
        F.skewness("value").alias("skew"), F.kurtosis("value").alias("kurtosis"),
    )
    return moments.join(quantiles(counted(df, columns), (0.5,)).withColumnRenamed("q0", "median"), "column", "left")


def without_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(~any_null(keys))


def consolidated(df: DataFrame, key: str, group: str, games: str, position: str, born: str, week: str) -> DataFrame:
    """One row for each key over all its groups: games, primary and other positions, earliest birth date, groups by week.

    The primary position is the one with most games, of equals the first by name; groups are in the
    order of their first week. The positions and groups of one key are few.
    """
    parts = df.groupBy(key, group, position).agg(F.sum(games).alias("_n"), F.min(born).alias("_born"), F.min(week).alias("_from"), F.max(week).alias("_to"))
    by_group = parts.groupBy(key, group).agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))
    spans = by_group.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_from", "_to", group))).alias("_spans"))
    by_position = parts.groupBy(key, position).agg(F.sum("_n").alias("_n"), F.min("_born").alias("_born"))
    out = by_position.groupBy(key).agg(
        F.sum("_n").alias(games), F.min(F.struct((-F.col("_n")).alias("_n"), position))[position].alias(position), F.collect_set(position).alias("_all"), F.min("_born").alias(born)
    )
    others = F.array_join(F.array_sort(F.array_except("_all", F.array(position))), ",")
    text_ = F.array_join(F.transform("_spans", lambda s: F.concat_ws(":", s[group].cast("string"), s["_from"].cast("string"), s["_to"].cast("string"))), ",")
    return out.join(spans, key).select(key, games, position, others.alias("alt_positions"), born, text_.alias("groups"))


def text_kinds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, kind, n): how many values of each text column look like which kind; a column with several is inconsistent."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    return long.groupBy("column", kind_of_text(F.col("value")).alias("kind")).agg(F.count("*").alias("n")).where("kind IS NOT NULL")
