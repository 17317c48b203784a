"""Joins with more meaning than an equality: intervals, as-of, tiered matches, record linkage, role-playing keys.

All come down to equi-joins or to one window over a union, so that they shuffle by key and do not
fan out.
"""

from __future__ import annotations

import functools
import itertools
import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import latest


def unique(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key, the first in ``order``: the right side of a join that must not fan out."""
    return latest(df, keys, order)


def lookup(left: DataFrame, right: DataFrame, keys: Mapping[str, str], prefix: str = "", null_safe: bool = False) -> DataFrame:
    """``left`` with the columns of ``right``, unique on its keys: left column -> right column.

    The right keys are dropped and its other columns are prefixed, so one table can play several
    roles.
    """
    right = right.select(*[F.col(f"`{c}`").alias("_k_" + c if c in keys.values() else prefix + c) for c in right.columns])
    on = [left[a].eqNullSafe(right["_k_" + b]) if null_safe else left[a] == right["_k_" + b] for a, b in keys.items()]
    return left.join(right, on, "left").drop(*["_k_" + b for b in keys.values()])


@dataclass(frozen=True)
class FeatureSource:
    """A table to be joined to a spine: its keys there, its columns, and how many periods it is moved on."""

    table: DataFrame
    keys: Mapping[str, str]
    features: Sequence[str]
    prefix: str = ""
    shift: int = 0
    period: str = "week_id"
    fill: Mapping[str, object] = field(default_factory=dict)


def join_source(spine: DataFrame, source: FeatureSource) -> DataFrame:
    """``spine`` with the features of ``source``; with a shift of n a row meets what held n periods before."""
    names = [c for c in dict.fromkeys([*source.keys.values(), *source.features]) if c in source.table.columns]
    right = source.table.select(*names)
    if source.shift:
        right = right.withColumn(source.period, F.col(source.period) + source.shift)
    out = lookup(spine, right, source.keys, source.prefix)
    return out.fillna({source.prefix + c: v for c, v in source.fill.items()}) if source.fill else out


def full_outer(a: DataFrame, b: DataFrame, keys: Sequence[str], merged: Sequence[str] = ()) -> DataFrame:
    """Rows of either side; ``merged`` columns take a's value, or b's where that is null. Null keys match nothing."""
    other = b.select(*[F.col(c).alias("_b_" + c) if c in merged else F.col(c) for c in b.columns])
    joined = a.join(other, list(keys), "full_outer")
    return joined.withColumns({c: F.coalesce(c, "_b_" + c) for c in merged}).drop(*["_b_" + c for c in merged])


def only_in(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key ``b`` lacks."""
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")


def both_sides(games: DataFrame, game: str, home: str, away: str) -> DataFrame:
    """(game, team, opponent, is_home): two rows for each game."""
    rows = F.array(
        F.struct(F.col(home).alias("team"), F.col(away).alias("opponent"), F.lit(1).alias("is_home")),
        F.struct(F.col(away).alias("team"), F.col(home).alias("opponent"), F.lit(0).alias("is_home")),
    )
    return games.select(game, F.inline(rows))


def opponent_values(stats: DataFrame, games: DataFrame, game: str, team: str, home: str, away: str, values: Sequence[str]) -> DataFrame:
    """(game, team, values): the sums of the other team of the same game."""
    sums = stats.groupBy(game, team).agg(*[F.sum(v).alias(v) for v in values])
    pairs = both_sides(games, game, home, away)
    flipped = pairs.join(sums.withColumnRenamed(team, "opponent"), [game, "opponent"])
    return flipped.select(game, F.col("team").alias(team), *values)


def pair_key(a: Column, b: Column) -> Column:
    """A key that is the same for (a, b) and (b, a)."""
    return F.struct(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))


#: Rows of a key, on both sides, beyond which its time line is cut into slices.
FREQUENT = 1 << 20


def in_interval(
    left: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, start: str, end: str, value: str, frequent: int = FREQUENT, slices: int = 32
) -> DataFrame:
    """``left`` with the ``value`` of the first span that contains ``at``; ends are included, null ends open.

    Spans that start first win, then those that end first; rows in a gap, and of a null key, get null. In
    that order a span holds only what lies beyond the greatest end before it, so the spans become disjoint
    and a time needs just the last one begun: one window over the spans and one over both sides, two
    shuffles by key. Keys with more than ``frequent`` rows go another way, so that neither their spans nor
    their rows meet in one task: their time lines are cut at quantiles of their own and what is open is
    carried from slice to slice. Both ways give the same result.
    """
    known = left.dropna(subset=list(keys))
    held = spans.select(*keys, F.col(start).alias("_s"), F.col(end).alias("_e"), F.col(value).alias("_v")).dropna(subset=list(keys)).where("_s IS NULL OR _e IS NULL OR _s <= _e")
    sizes = known.select(*keys).union(held.select(*keys)).groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > frequent).select(*keys)
    kind = spans.schema[value].dataType
    rest = left.where(functools.reduce(operator.or_, [F.col(k).isNull() for k in keys])).withColumn(value, F.lit(None).cast(kind))
    if sizes.isEmpty():
        return _in_interval(known, held, keys, at, value).unionByName(rest)
    sliced = _in_interval_sliced(known.join(sizes, list(keys), "left_semi").select(left.columns), held.join(sizes, list(keys), "left_semi"), keys, at, value, slices)
    return _in_interval(known.join(sizes, list(keys), "left_anti").select(left.columns), held.join(sizes, list(keys), "left_anti"), keys, at, value).unionByName(sliced).unionByName(rest)


def _until() -> Column:
    """A span's end, an open one the greatest."""
    return F.struct(F.col("_e").isNull().alias("open"), F.col("_e").alias("e"))


def _begun(held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spans as the times from which they hold: kind 2 after that time, 0 at it. ``_m`` is the greatest end before."""
    covered = F.col("_m").isNotNull() & (F.col("_s").isNull() | (F.col("_m.e") >= F.col("_s")))
    new = held.where(F.col("_m").isNull() | (_until() > F.col("_m")))
    return new.select(*keys, F.when(covered, F.col("_m.e")).otherwise(F.col("_s")).alias("_at"), F.when(covered, 2).otherwise(0).alias("_kind"), F.struct("_e", "_v").alias("_span"))


def _in_interval(left: DataFrame, held: DataFrame, keys: Sequence[str], at: str, value: str) -> DataFrame:
    before = Window.partitionBy(*keys).orderBy("_s", "_e", "_v").rowsBetween(Window.unboundedPreceding, -1)
    begun = _begun(held.withColumn("_m", F.max(_until()).over(before)), keys)
    asked = left.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*left.columns).alias("_row"))
    upto = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = asked.unionByName(begun, allowMissingColumns=True).withColumn("_span", F.last("_span", ignorenulls=True).over(upto))
    fits = F.col("_span._e").isNull() | (F.col("_span._e") >= F.col("_at"))
    return line.where("_kind = 1").select("_row.*", F.when(fits, F.col("_span._v")).alias(value))


def _in_interval_sliced(left: DataFrame, held: DataFrame, keys: Sequence[str], at: str, value: str, slices: int) -> DataFrame:
    """The same with each key's time line cut into slices; repeated times of a key are looked up once."""
    asked = left.select(*keys, F.col(at).alias("_at")).distinct()
    times = asked.union(held.select(*keys, F.col("_s").alias("_at")))
    cuts = times.groupBy(*keys).agg(F.percentile_approx("_at", [i / slices for i in range(1, slices)], 1000).alias("_cuts"))  # a row for each frequent key
    sliced = lambda df, c: df.join(cuts, list(keys)).withColumn("_slice", F.greatest(F.size(F.filter("_cuts", lambda b: b < F.col(c))), F.lit(0))).drop("_cuts")
    part, slice_ = [*keys, "_slice"], Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)

    held = sliced(held, "_s")
    prior = held.groupBy(*part).agg(F.max(_until()).alias("_top")).withColumn("_prior", F.max("_top").over(slice_)).drop("_top")
    within = Window.partitionBy(*part).orderBy("_s", "_e", "_v").rowsBetween(Window.unboundedPreceding, -1)
    begun = _begun(held.join(prior, part).withColumn("_m", F.greatest(F.max(_until()).over(within), F.col("_prior"))), keys)

    line = sliced(asked.withColumn("_kind", F.lit(1)).unionByName(begun, allowMissingColumns=True), "_at")
    latest_ = F.max(F.when(F.col("_kind") != 1, F.struct("_at", "_kind", "_span")))
    carried = line.groupBy(*part).agg(latest_.alias("_top")).withColumn("_carried", F.max("_top").over(slice_)["_span"]).drop("_top")
    upto = Window.partitionBy(*part).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = line.join(carried, part).withColumn("_span", F.coalesce(F.last("_span", ignorenulls=True).over(upto), F.col("_carried")))
    fits = F.col("_span._e").isNull() | (F.col("_span._e") >= F.col("_at"))
    found = line.where("_kind = 1").select(*[F.col(k).alias("_k_" + k) for k in keys], F.col("_at"), F.when(fits, F.col("_span._v")).alias("_found"))
    on = [left[k] == found["_k_" + k] for k in keys] + [left[at].eqNullSafe(found["_at"])]
    return left.join(found, on, "left").withColumn(value, F.col("_found")).drop("_found", "_at", *["_k_" + k for k in keys])


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, time: str, values: Sequence[str]) -> DataFrame:
    """``left`` with ``values`` of the latest ``right`` row at or before ``at``, null if there is none.

    Of rows at the same time the largest values win. Both sides are put on one time line for each
    key, so the cost is that of one sort, whatever the number of matches.
    """
    order = Window.partitionBy(*keys).orderBy("_at", "_left", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = _time_line(left, right, keys, at, time, values).withColumn("_found", F.last("_v", ignorenulls=True).over(order))
    return found.where("_left = 1").select("_row.*", *[F.col("_found")[v].alias(v) for v in values])


def nearest(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, time: str, values: Sequence[str]) -> DataFrame:
    """``left`` with ``values`` of the ``right`` row nearest in time; of two as near the earlier one."""
    line = _time_line(left, right, keys, at, time, [time, *[v for v in values if v != time]])
    base = Window.partitionBy(*keys)
    before = base.orderBy("_at", "_left", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = base.orderBy(F.col("_at").desc(), F.col("_left"), F.col("_v").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = line.withColumn("_b", F.last("_v", ignorenulls=True).over(before)).withColumn("_a", F.last("_v", ignorenulls=True).over(after))
    gap_b, gap_a = (F.abs(F.col("_at").cast("timestamp").cast("double") - F.col(c)[time].cast("timestamp").cast("double")) for c in ("_b", "_a"))
    pick = F.when(F.col("_a").isNull() | (gap_b <= gap_a), F.col("_b")).otherwise(F.col("_a"))
    return line.where("_left = 1").withColumn("_found", pick).select("_row.*", *[F.col("_found")[v].alias(v) for v in values])


def _time_line(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, time: str, values: Sequence[str]) -> DataFrame:
    row, value = F.struct("*"), F.struct(*values)
    a = left.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_left"), row.alias("_row"))
    b = right.select(*keys, F.col(time).alias("_at"), F.lit(0).alias("_left"), value.alias("_v"))
    return a.unionByName(b, allowMissingColumns=True)


@dataclass(frozen=True)
class Tier:
    """A rule of a match: expressions on the left and the right that must be equal, one or an array of variants."""

    left: Sequence[Column]
    right: Sequence[Column]
    unique: bool = True


def tiered_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tiers: Sequence[Tier]) -> DataFrame:
    """(left_id, right_id, tier) for every id on the left: the match of the first tier that has one.

    An expression that is an array stands for all its elements. A tier with ``unique`` matches only
    if it has one candidate; others take the smallest id. What no tier resolves has a null
    right_id and tier: the rows to report. The right side is reduced to one row for each key of a
    tier before it is joined, so a frequent key does not fan out.
    """
    found = None
    for n, tier in enumerate(tiers):
        a, b = _keyed(left, left_id, tier.left), _keyed(right, right_id, tier.right)
        names = [c for c in a.columns if c.startswith("_k")]
        b = b.groupBy(*names).agg(F.min(right_id).alias("_low"), F.max(right_id).alias("_high"))
        hits = a.join(b, names).groupBy(left_id).agg(F.min("_low").alias(right_id), F.max("_high").alias("_high"))
        if tier.unique:
            hits = hits.where(F.col(right_id) == F.col("_high"))
        hits = hits.select(left_id, right_id, F.lit(n).alias("tier"))
        found = hits if found is None else found.union(hits)
    best = found.groupBy(left_id).agg(F.min(F.struct("tier", right_id)).alias("_best"))
    ids = left.select(left_id).distinct()
    return ids.join(best, left_id, "left").select(left_id, F.col(f"_best.{right_id}").alias(right_id), F.col("_best.tier").alias("tier"))


def _keyed(df: DataFrame, id_: str, keys: Sequence[Column]) -> DataFrame:
    out = df.select(id_, *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    for field_ in out.schema.fields[1:]:
        if field_.dataType.typeName() == "array":
            out = out.withColumn(field_.name, F.explode(field_.name))
    return out.dropna().distinct()


def date_tolerant(left: DataFrame, right: DataFrame, keys: Sequence[str], left_date: str, right_date: str, days: int = 1) -> DataFrame:
    """Pairs with equal keys and dates at most ``days`` apart: an equi-join on the dates that are near enough."""
    near = F.explode(F.sequence(F.date_sub(F.col(left_date), days), F.date_add(F.col(left_date), days)))
    return left.withColumn("_near", near).join(right.withColumn("_near", F.col(right_date)), [*keys, "_near"]).drop("_near")


def _agreements(df: DataFrame, id_: str, name: str, names: Sequence[str], dates: Sequence[str], least: int, days: Sequence[int]) -> DataFrame:
    """(id, name, _key): a row for each choice of ``least`` columns without nulls, with its values; dates moved by each of ``days``."""
    options = []
    for n, chosen in enumerate(itertools.combinations([*names, *dates], least)):
        for moves in itertools.product(*[days if c in dates else (0,) for c in chosen]):
            by = dict(zip(chosen, moves, strict=True))
            values = [F.date_add(c, by.get(c, 0)) if c in dates else F.col(c) for c in [*names, *dates]]
            held = [F.when(F.lit(c in by), v).alias(c) for c, v in zip([*names, *dates], values, strict=True)]
            filled = [F.col(c).isNotNull() for c in chosen]
            options.append(F.when(functools.reduce(operator.and_, filled, F.lit(True)), F.struct(F.lit(n).alias("_n"), *held)))
    return df.where(F.col(name).isNotNull()).select(id_, name, F.explode(F.array_compact(F.array(*options))).alias("_key"))


def _links(df: DataFrame, id_: str, name: str, names: Sequence[str], dates: Sequence[str], least: int) -> DataFrame:
    """(a, b): each record with the least id of every agreement that it shares, its own included."""
    firsts = _agreements(df, id_, name, names, dates, least, (0,)).groupBy(name, "_key").agg(F.min(id_).alias("b"))
    return _agreements(df, id_, name, names, dates, least, (-1, 0, 1)).join(firsts, [name, "_key"]).select(F.col(id_).alias("a"), "b")


def linked_records(df: DataFrame, id_: str, name: str, names: Sequence[str], dates: Sequence[str] = (), least: int = 4) -> DataFrame:
    """(id, same_as): the smallest id among the records of the same name that agree in ``least`` columns, its own included.

    Dates may be one day apart. Records meet by equi-joins with the least id of each choice of
    ``least`` columns, never in pairs, so a frequent name costs no more than its rows. Only direct
    links count; ``linkage.clusters`` follows them.
    """
    least_ = _links(df, id_, name, names, dates, least).groupBy(F.col("a").alias(id_)).agg(F.min("b").alias("same_as"))
    return df.select(id_).join(least_, id_, "left").select(id_, F.coalesce("same_as", id_).alias("same_as"))


def best_candidates(scored: DataFrame, key: str, candidate: str, score: str) -> DataFrame:
    """(key, candidate, score) of the highest score; a tie is left unresolved, with a null candidate."""
    top = scored.groupBy(key, score).agg(F.min(candidate).alias("_c"), F.count("*").alias("_n"))
    best = top.groupBy(key).agg(F.max(F.struct(score, "_n", "_c")).alias("_b"))
    return best.select(key, F.when(F.col("_b._n") == 1, F.col("_b._c")).alias(candidate), F.col(f"_b.{score}").alias(score))


def rekeyed(df: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """``df`` with its key replaced where ``mapping`` (old, new) has it."""
    return df.join(mapping.select(F.col("old").alias(key), F.col("new").alias("_new")), key, "left").withColumn(key, F.coalesce("_new", key)).drop("_new").select(df.columns)


def with_following(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, time: str, values: Sequence[str], after: int = 3) -> DataFrame:
    """``nearest`` with the values of the next ``after`` right rows too, as ``{value}_1`` and so on; null past the end."""
    order = Window.partitionBy(*keys).orderBy(time, *values)
    more = {f"{v}_{n}": F.lead(v, n).over(order) for v in values for n in range(1, after + 1)}
    return nearest(left, right.withColumns(more), keys, at, time, [*values, *more])


def protected(target: DataFrame, source: DataFrame, keys: Sequence[str], column: str, placeholder: str) -> DataFrame:
    """``source`` with the value that ``target`` has for a key wherever its own is only the placeholder."""
    stored = target.select(*keys, F.col(column).alias("_stored")).where("_stored IS NOT NULL")
    held = F.when(F.col(column) == placeholder, F.coalesce("_stored", column)).otherwise(F.col(column))
    return source.join(stored, list(keys), "left").withColumn(column, held).drop("_stored").select(source.columns)
