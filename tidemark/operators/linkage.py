"""Records that are the same, keys that are replaced, sets that share nothing, and names found in text.

Where a result follows links of any length (clusters, mappings), each round is an equi-join between
written tables, and the number of rounds grows with the logarithm of what is followed.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import _links
from tidemark.streaming.incremental import shared_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that it is computed once and lost executors take nothing with them."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# clusters


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (a, b); ``component`` is the least node that can be reached.

    Each round draws a rank for every node and merges it into the neighbour of least rank, if that is
    less than its own; edges between merged nodes remain. In expectation a constant share of the nodes
    that still have an edge goes with each round, whatever the shape of the graph. Null ends, loops and
    repeated edges are left out; no edges give no rows.
    """
    kept = edges.where("a <> b").select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    kept, steps = written(kept.distinct(), "links"), []
    while not steps or not kept.isEmpty():
        drawn = lambda c, turn=len(steps): F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("rank"), F.col(c).alias("at"))
        least = kept.groupBy("a").agg(F.least(F.min(drawn("b")), drawn("a"))["at"].alias("to"))
        steps.append(written(least, "merged"))
        a, b = (steps[-1].select(F.col("a").alias(c), F.col("to").alias(f"{c}_to")) for c in ("a", "b"))
        kept = written(kept.join(a, "a").join(b, "b").where("a_to <> b_to").select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).distinct(), "links")
    last = steps.pop()
    for step in reversed(steps):  # what a node was merged into may have been merged in a later round
        last = written(step.join(last.select(F.col("a").alias("to"), F.col("to").alias("end")), "to", "left").select("a", F.coalesce("end", "to").alias("to")), "merged")
    return last.join(last.groupBy("to").agg(F.min("a").alias("component")), "to").select(F.col("a").alias("node"), "component")


def clusters(df: DataFrame, id_: str, name: str, names: Sequence[str], dates: Sequence[str] = (), least: int = 4) -> DataFrame:
    """(id, same_as): the least id of each record's cluster, for records of one name that agree in ``least`` columns, directly or over others.

    Dates may be one day apart; a null agrees with nothing. Records meet by equi-joins with the least id
    of each choice of ``least`` columns, never in pairs. A record without links is its own cluster.
    """
    parts = components(_links(df, id_, name, names, dates, least)).select(F.col("node").alias(id_), F.col("component").alias("same_as"))
    return df.select(id_).join(parts, id_, "left").select(id_, F.coalesce("same_as", id_).alias("same_as"))


# keys that are replaced


def duplicates(df: DataFrame, id_: str, same: Sequence[str], column: str, placeholder: str) -> DataFrame:
    """(old, new): rows whose ``column`` is only the placeholder, and the least other row that agrees in ``same`` and has a value.

    The values are reduced to one row for each key before they are joined, so a frequent key does not fan out.
    """
    held = df.where(F.col(column) != placeholder).groupBy(*same).agg(F.min(id_).alias("new"))
    return df.where(F.col(column) == placeholder).join(held, list(same)).select(F.col(id_).alias("old"), "new")


def closure(mapping: DataFrame) -> DataFrame:
    """(old, new) with chains followed to their ends: a -> b -> c gives a -> c and b -> c.

    Each round replaces every target by its own target, so the length that is followed doubles.
    ValueError if a key has two targets, or if some keys lead into a cycle and so have no end; repeated
    rows, nulls and keys mapped to themselves are left out.
    """
    found = written(mapping.select("old", "new").where("old <> new").distinct(), "mapping")
    if twice := found.groupBy("old").count().where("count > 1").select("old").limit(3).collect():
        raise ValueError(f"keys with several targets, such as {[r.old for r in twice]}")
    longest = math.ceil(math.log2(found.count() + 1)) + 1
    for _ in range(longest):
        further = found.select(F.col("old").alias("new"), F.col("new").alias("end"))
        step = written(found.join(further, "new", "left").select("old", F.coalesce("end", "new").alias("new"), F.col("end").isNotNull().alias("moved")), "mapping")
        found = step.select("old", "new")
        if step.where("moved").isEmpty():
            return found
    caught = found.join(found.select(F.col("old").alias("new")), "new", "left_semi").select("old").limit(3).collect()
    raise ValueError(f"keys that lead into a cycle, such as {[r.old for r in caught]}")


def conflicts(tables: Mapping[str, tuple[DataFrame, str, Sequence[str]]], mapping: DataFrame) -> DataFrame:
    """(table, key, n_rows, n_old): keys that would no longer be unique once ``mapping`` (old, new) is applied.

    ``tables`` gives for each name the rows, the column to be re-keyed, and the columns that must be unique
    together. Nothing is written: the report is made on the image of the tables. ``key`` is the unique
    columns as text; ``n_old`` counts the different old keys that meet. Keys with a null are not compared,
    as a unique constraint has it.
    """
    reports = []
    for name, (df, column, unique) in tables.items():
        image = df.join(mapping.select(F.col("old").alias(column), F.col("new").alias("_new")), column, "left")
        image = image.select(F.coalesce("_new", column).alias("_image"), F.col(column).alias("_old"), *[c for c in unique if c != column])
        keys = [F.col("_image") if c == column else F.col(c) for c in unique]
        text = F.concat_ws("|", *[k.cast("string") for k in keys])
        counts = image.dropna(subset=["_image", *[c for c in unique if c != column]]).groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_distinct("_old").alias("n_old"))
        reports.append(counts.where("n_rows > 1").select(F.lit(name).alias("table"), text.alias("key"), "n_rows", "n_old"))
    out = reports[0]
    for report in reports[1:]:
        out = out.union(report)
    return out


# sets that share nothing


def mask(values: Column) -> Column:
    """An array of integers from 0 to 62 as a bit mask; null is empty."""
    return F.aggregate(F.coalesce(values, F.array().cast("array<int>")), F.lit(0).cast("long"), lambda m, v: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), v.cast("int"))))


def set_classes(df: DataFrame, id_: str, name: str, group: str, values: str) -> DataFrame:
    """(id, name, group, mask): the class of each record, to which ``disjoint_classes`` refers."""
    return df.select(id_, name, group, mask(F.col(values)).alias("mask"))


def disjoint_classes(members: DataFrame, name: str, group: str, low_bits: int = 6) -> DataFrame:
    """(name, group, mask, n, other_group, other_mask, other_n): classes of one name in different groups whose sets share nothing.

    Records of equal name, group and set are one class with their number n, so the result grows with
    the different sets and not with the pairs of records. A class asks for the sets that lie within its
    complement: it enumerates the subsets of the lowest ``low_bits`` bits that it lacks, at most 2 **
    ``low_bits``, which is an equi-join, and compares the other bits. Each pair comes once, the smaller
    group first. Null names and groups match nothing.
    """
    classes = members.groupBy(name, group, "mask").agg(F.count("*").alias("n")).dropna(subset=[name, group])
    full = (1 << low_bits) - 1
    low, high = F.col("mask").bitwiseAND(F.lit(full)), F.call_function("shiftright", F.col("mask"), F.lit(low_bits))
    free = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(full).cast("long")), lambda s: s.bitwiseAND(low) == 0)
    asks = classes.select(name, group, "mask", "n", high.alias("_high"), F.explode(free).alias("_low"))
    others = classes.select(name, F.col(group).alias("other_group"), F.col("mask").alias("other_mask"), F.col("n").alias("other_n"), high.alias("_other_high"), low.alias("_low"))
    pairs = asks.join(others, [name, "_low"]).where((F.col(group) < F.col("other_group")) & (F.col("_high").bitwiseAND(F.col("_other_high")) == 0))
    return pairs.select(name, group, "mask", "n", "other_group", "other_mask", "other_n")


def disjoint_pairs(members: DataFrame, id_: str, name: str, group: str, low_bits: int = 6) -> DataFrame:
    """(id, other_id): all pairs of records of one name in different groups whose sets share nothing, the smaller id first.

    The pairs of ``disjoint_classes`` are joined to the members of either side, so records that share
    something never meet, and the work beyond the classes is that of the pairs returned. ``members`` is
    what ``set_classes`` gives; it is written once, as each side is read from it again.
    """
    members = written(members.dropna(subset=[id_, name, group]), "members")
    pairs = disjoint_classes(members, name, group, low_bits).select(name, group, "mask", "other_group", "other_mask")
    own = members.select(name, group, "mask", F.col(id_).alias("_a"))
    other = members.select(name, F.col(group).alias("other_group"), F.col("mask").alias("other_mask"), F.col(id_).alias("_b"))
    both = pairs.join(own, [name, group, "mask"]).join(other, [name, "other_group", "other_mask"])
    return both.select(F.least("_a", "_b").alias(id_), F.greatest("_a", "_b").alias(f"other_{id_}"))


# rows left over


def left_over(left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[str], salts: int = 64) -> DataFrame:
    """Rows of ``left`` beyond as many of each key as ``right`` has, with n_left and n_right, the key's rows on either side.

    The rows that go are the first in a fixed order of ``order``'s hashes. Rows are numbered within the
    salts of a key and moved on by the salts before, so a frequent key is not numbered in one task. Keys
    match null-safely; a key that occurs three times on the left and twice on the right leaves one row.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    own = Window.partitionBy(*keys, "_salt").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    counts = salted.groupBy(*keys, "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("n_left", F.sum("_n").over(Window.partitionBy(*keys)))
    taken = right.groupBy(*keys).agg(F.count("*").alias("_right"))
    renamed = lambda df, p: df.select(*[F.col(c).alias(p + c) if c in (*keys, "_salt") else F.col(c) for c in df.columns])
    a, b = renamed(counts, "_c"), renamed(taken, "_t")
    numbered = salted.withColumn("_at", F.row_number().over(own))
    joined = numbered.join(a, [numbered[k].eqNullSafe(a["_c" + k]) for k in (*keys, "_salt")]).join(b, [numbered[k].eqNullSafe(b["_t" + k]) for k in keys], "left")
    joined = joined.withColumn("n_right", F.coalesce("_right", F.lit(0)))
    return joined.where(F.col("_before") + F.col("_at") > F.col("n_right")).select(*left.columns, "n_left", "n_right")


# names in text


def words_of(text: Column) -> Column:
    """Lower-case words of a text, in order: runs of letters, with inner apostrophes, hyphens and points."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(\p{L}+(?:['’.-]\p{L}+)*)"), F.lit(1))


def name_index(roster: DataFrame, name: str, group: str) -> DataFrame:
    """(gram, tier, low, high, n): by which words a name of the roster is found, and the groups that have it.

    Tier 0 is the whole name, 1 its first and last word, 2 its last word if that has more than three
    letters. One row for each gram and tier, so that a frequent name does not fan out.
    """
    words = roster.select(F.col(group).alias("_g"), words_of(F.col(name)).alias("_w")).where("size(_w) > 0")
    first, last = F.col("_w")[0], F.element_at("_w", -1)
    grams = F.array(
        F.struct(F.array_join("_w", " ").alias("gram"), F.lit(0).alias("tier")),
        F.when(F.size("_w") > 1, F.struct(F.concat_ws(" ", first, last).alias("gram"), F.lit(1).alias("tier"))),
        F.when(F.length(last) > 3, F.struct(last.alias("gram"), F.lit(2).alias("tier"))),
    )
    return words.select("_g", F.inline(F.array_compact(grams))).groupBy("gram", "tier").agg(F.min("_g").alias("low"), F.max("_g").alias("high"), F.count_distinct("_g").alias("n"))


def attributed(plays: DataFrame, play: str, text: str, index: DataFrame, most_words: int = 4) -> DataFrame:
    """(play, group, tier, gram, n_groups) for every play: the group whose player its text names.

    Runs of up to ``most_words`` words of the text are joined to ``index``. The lowest tier wins, of
    equals the first in the text, of those at one place the longest. If several groups have that name the
    group is null and n_groups says how many: the ties to report. Without a match all but the play are
    null.
    """
    words = plays.select(play, words_of(F.col(text)).alias("_w"))
    spans = F.flatten(F.transform("_w", lambda w, i: F.transform(F.sequence(F.lit(1), F.lit(most_words)), lambda k: F.struct(i.alias("at"), k.alias("k"), F.slice("_w", i + 1, k).alias("words")))))
    fit = F.filter(spans, lambda s: F.size(s["words"]) == s["k"])
    grams = words.select(play, F.explode(F.transform(fit, lambda s: F.struct(s["at"], s["k"], F.array_join(s["words"], " ").alias("gram")))).alias("_s")).select(play, "_s.*")
    best = grams.join(index, "gram").groupBy(play).agg(F.min(F.struct("tier", "at", (-F.col("k")).alias("k"), "gram", "low", "high", "n")).alias("_b"))
    found = plays.select(play).join(best, play, "left")
    return found.select(play, F.when(F.col("_b.low") == F.col("_b.high"), F.col("_b.low")).alias("group"), F.col("_b.tier").alias("tier"), F.col("_b.gram").alias("gram"), F.col("_b.n").alias("n_groups"))

