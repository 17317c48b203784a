"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target number of words: the total shared by weight, no more than three times what
the source holds, the excess shared again among the rest. The weight of a source changes over the
training time x in [0, 1]: its density is ``target * (1 + tilt * (2x - 1))``, which integrates to the
demand ``target * (x + tilt * (x * x - x))`` up to x. The documents of a source stand in an order of
their own, by a hash of doc_id, and are repeated up to three times; a document's place in that order
is a cumulative demand, and the inverse of the integral gives its training position. Documents are
then sorted by position over ranges.

Only DataFrame functions are used. The running sum within a source is taken in two steps, over
blocks of the hash order and within a block, so a source with most of the rows is spread over many
tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, cut, table

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: The strongest tilt of a source's weight over training time; 0 keeps weights constant.
TILT = 0.8
BLOCK_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with _size, _key (source, null apart from all others) and _order (hex digits of a hash of doc_id)."""
    return docs.select(
        "*",
        word_count(F.col("text").cast("string")).alias("_size"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("~")).alias("_key"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_order"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, tilt: float = TILT) -> DataFrame:
    """(_key, source_size, target, tilt): one row for each source, from rows (_key, _size).

    Sources take the weights in turn, in the order of their names by code point, null last. The
    windows here run over one row for each source, however many documents there are.
    """
    sources = sizes.groupBy("_key").agg(F.sum("_size").alias("source_size"))
    all_ = Window.partitionBy(F.lit(0))
    # "~" is after "=", so the null source comes last.
    ranked = sources.withColumn("_rank", F.row_number().over(all_.orderBy("_key")) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.select(
        "*", weight.cast("double").alias("_weight"), (F.col("source_size") * max_repeats).alias("_most"), F.sum("source_size").over(all_).alias("_all")
    )
    ranked = ranked.withColumn("_full_at", F.col("_most") / F.col("_weight"))
    filling = all_.orderBy("_full_at", "_key")
    ranked = ranked.select(
        "*",
        F.coalesce(F.sum("_most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_filled"),
        F.sum("_weight").over(filling.rowsBetween(0, Window.unboundedFollowing)).alias("_open"),
    )
    level = (F.col("_all") - F.col("_filled")) / F.col("_open")
    ranked = ranked.withColumn("_level", F.min(F.when(level < F.col("_full_at"), F.struct("_full_at", "_key", level.alias("level")))).over(all_)["level"])
    target = F.least(F.col("_most").cast("double"), F.coalesce(F.col("_weight") * F.col("_level"), F.col("_most").cast("double")))
    ranked = ranked.withColumn("target", target)
    early = F.sum(F.when(F.col("_rank") % 2 == 0, F.col("target")).otherwise(0.0)).over(all_)
    late = F.sum(F.when(F.col("_rank") % 2 == 1, F.col("target")).otherwise(0.0)).over(all_)
    # Tilts weighted by the targets cancel, so the weights of all sources sum to one at any time.
    lean = (
        F.when((early <= 0) | (late <= 0), F.lit(0.0))
        .when(F.col("_rank") % 2 == 0, -tilt * F.least(F.lit(1.0), late / early))
        .otherwise(tilt * F.least(F.lit(1.0), early / late))
    )
    return ranked.select("_key", "source_size", "target", lean.alias("tilt"))


def position(share: Column, tilt: Column) -> Column:
    """The time at which a source has met this share of its demand: the inverse of x + tilt * (x * x - x)."""
    a = 1 - tilt
    return 2 * share / (a + F.sqrt(a * a + 4 * tilt * share))


def _place(keyed: DataFrame, stats: DataFrame) -> DataFrame:
    """``keyed`` rows with their source's figures, taken and _copies; ``stats``: the same rows' keys and sizes."""
    rows = stats.count()
    digits = math.ceil(math.log(rows / BLOCK_ROWS, 16)) if rows > BLOCK_ROWS else 0
    block = F.substring("_order", 1, digits)
    sources = cut(targets(stats), "targets")
    blocks = stats.groupBy("_key", block.alias("_block")).agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_key", "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    blocks = cut(blocks.join(sources, "_key"), "blocks")
    ties = ["_tie"] if "_tie" in keyed.columns else []
    within = Window.partitionBy("_key", "_block").orderBy("_order", "doc_id", "_size", *ties).rowsBetween(Window.unboundedPreceding, 0)
    placed = keyed.withColumn("_block", block).withColumn("_until", F.sum("_size").over(within))
    placed = placed.join(blocks, ["_key", "_block"])
    start, size, budget = F.col("_before") + F.col("_until") - F.col("_size"), F.col("_size"), F.floor("target")
    copies = []
    for n in range(MAX_REPEATS):
        at = F.col("source_size") * n + start
        words = F.greatest(F.lit(0), F.least(size, budget - at)).cast("long")
        share = F.least(F.lit(1.0), (at + words / 2) / F.col("target"))
        copies.append(F.struct(F.lit(n).alias("copy"), words.alias("words"), F.when(words > 0, position(share, F.col("tilt"))).alias("position")))
    placed = placed.withColumn("_copies", F.filter(F.array(*copies), lambda c: c["words"] > 0))
    return placed.withColumn("_taken", F.aggregate("_copies", F.lit(0).cast("long"), lambda s, c: s + c["words"]))


def mix(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` for each copy that the mix takes, sorted over ranges by training position.

    A source's taken words sum to its target, rounded down: the last document that is needed is
    taken in part, and its text is then the words taken, joined by one space. No document exceeds three times its
    size. Null and empty texts have size 0 and are never taken; a null source is a source of its
    own; documents without doc_id and repeated rows are mixed like others, ties in the order being
    broken by doc_id, size and text, so reruns take the same texts. Other columns pass through,
    whatever their names. No rows give no rows.
    """
    keyed = _keyed(docs.select("doc_id", "source", "text", F.struct("*").alias("_row"))).withColumn("_tie", F.md5(F.col("text").cast("string")))
    stats = cut(keyed.select("_key", "_order", "_size"), "sizes")
    taken = _place(keyed, stats).select("_row", "text", "_size", F.explode("_copies").alias("_copy"))
    text = F.col("text").cast("string")
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    part = F.array_join(F.slice(words, F.lit(1), F.col("_copy.words").cast("int")), " ")
    text = F.when(F.col("_copy.words") < F.col("_size"), part).otherwise(text)
    columns = [F.col("_text").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns]
    return taken.withColumn("_text", text).orderBy("_copy.position", "_row.doc_id", F.col("_copy.copy")).select(columns)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of every document in the mix, in the order of the first training position; no text is shuffled."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sizes = cut(_keyed(docs).select("doc_id", "_key", "_order", "_size"), "sizes")
    found = _place(sizes, sizes).withColumn("position", F.get("_copies", F.lit(0))["position"])
    return found.orderBy(F.col("position").asc_nulls_last(), "doc_id").select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", F.col("_taken").alias("taken"), "position"
    )


OP3_SQL = r"""
WITH s AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), k AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
  FROM s GROUP BY source
), w AS (
  SELECT *, CAST(CASE r % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight,
         CAST(sum(source_size) OVER () AS BIGINT) AS total
  FROM k
), f AS (
  SELECT *, 3 * source_size / weight AS full_at FROM w
), l AS (
  SELECT *, (total - coalesce(sum(3 * source_size) OVER (ORDER BY full_at, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY full_at, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM f
), t AS (
  SELECT *, least(CAST(3 * source_size AS DOUBLE), coalesce(weight * (
    SELECT arg_min(level, full_at) FROM l AS x WHERE x.level < x.full_at), 3.0 * source_size)) AS target
  FROM l
), e AS (
  SELECT *, sum(CASE WHEN r % 2 = 0 THEN target ELSE 0 END) OVER () AS early,
            sum(CASE WHEN r % 2 = 1 THEN target ELSE 0 END) OVER () AS late
  FROM t
), g AS (
  SELECT *, CASE WHEN early <= 0 OR late <= 0 THEN 0.0
                 WHEN r % 2 = 0 THEN -0.8 * least(1.0, late / early) ELSE 0.8 * least(1.0, early / late) END AS tilt
  FROM e
), d AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.tilt,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.o, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS start
  FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source
), c AS (
  SELECT *, list_transform([0, 1, 2], lambda n: greatest(0, least(size, CAST(floor(target) AS BIGINT) - n * source_size - start))) AS copies
  FROM d
), q AS (
  SELECT *, CASE WHEN copies[1] > 0 THEN least(1.0, (start + copies[1] / 2) / target) END AS share FROM c
)
SELECT doc_id, size, source_size, target, CAST(list_sum(copies) AS BIGINT) AS taken,
       2 * share / ((1 - tilt) + sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * share)) AS position
FROM q
"""
