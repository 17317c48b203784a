"""Quality rules as a short-circuit cascade.

Each rule is a condition under which a document fails. On a sample, the selectivity of a rule is
counted on the documents that the base conditions leave, and its cost is timed: the rule runs over
the sample's rows many times over, and what the same job takes without it is subtracted. The cascade
asks first the rule with the most rejections per cost; the first rule that fails decides, and none
after it is evaluated. The order changes only the work that is done: a document is kept if no rule
fails, in whatever order they are asked.

Only DataFrame functions are used.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, cut, table

MIN_WORDS = 50
#: About how many rows costs are estimated on, from so many ranges of ids. They fix the order of the rules, never their outcome.
SAMPLE_ROWS, SAMPLE_RANGES = 1000, 8
SAMPLE_SEED = 3
#: How many rows, and characters, a rule is timed on, each sample row as often as it takes; times are the least of so many runs, in steps of seconds.
TIMED_ROWS, TIMED_CHARS, RUNS, STEP = 8000, 1 << 24, 2, 0.05


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for documents to reject; it may use ``text`` and the base columns."""

    name: str
    fails: Column


def rules() -> list[Rule]:
    """The rules that follow the base conditions."""
    text = F.col("_text")
    return [
        Rule("symbols", F.col("n_symbols") * 10 > F.col("n_words") * 8),
        Rule("repeated_lines", F.col("n_dup_lines") * 10 > F.size(F.split(text, "\n")) * 6),
        Rule("word_length", (F.col("word_chars") < F.col("n_words") * 2) | (F.col("word_chars") > F.col("n_words") * 15)),
        Rule("shouting", F.regexp_count(text, F.lit("!!")) * 10 > F.col("n_words") * 3),
        Rule("no_letters", F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*")) * 10 < F.col("n_words") * 6),
    ]


def base_columns(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``_text`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Repeated three-word windows are found by their hashes within a document: if all are distinct
    none repeat; else windows are sorted by hash, those equal to a neighbour are marked, and the
    words that they cover are counted along the text. The work is that of a sort.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select("doc_id", text.alias("_text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"))
    n = F.size("_words")
    grams = F.when(n >= 4, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))))
    read = read.select("*", n.cast("long").alias("n_words"), grams.alias("_grams"))
    sorted_ = F.when(
        F.size(F.array_distinct("_grams")) < F.size("_grams"),
        F.array_sort(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
    )
    read = read.select(
        "doc_id", "_text", "n_words", F.length(F.array_join("_words", "")).cast("long").alias("word_chars"), sorted_.alias("_sorted")
    )

    def repeats(x: Column, k: Column) -> Column:
        def same(j: Column) -> Column:
            return F.coalesce(F.get("_sorted", j)["g"] == x["g"], F.lit(False))

        return same(k - 1) | same(k + 1)

    at = F.array_sort(F.transform(F.filter("_sorted", repeats), lambda x: x["i"]))
    covered = F.aggregate(
        at,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, i: F.struct((i + 3).alias("end"), (s["n"] + i + 3 - F.greatest(i, s["end"])).alias("n")),
        lambda s: s["n"],
    )
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    read = read.select("*", lines.alias("_lines"))
    figures = F.struct(
        "n_words", "word_chars",
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    # A generator: a filter on the figures stays above it, instead of computing them again for each place that names them.
    return read.select("doc_id", "_text", F.inline(F.array(figures)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def sampled(docs: DataFrame) -> DataFrame:
    """About ``SAMPLE_ROWS`` rows of ``docs``, with their base columns, as a table in the shared folder.

    The rows are those of a few narrow ranges of doc_id, so where a table is laid out by id the scan
    reads their row groups alone, and otherwise no more than one column of the rest to choose them.
    Without ids, or where the ranges are empty, each row is taken with the same chance.
    """
    rows, low, high = docs.agg(F.count("*"), F.min(F.col("doc_id").cast("long")), F.max(F.col("doc_id").cast("long"))).first()
    read = docs.select("doc_id", "text")
    chosen = read.sample(min(1.0, SAMPLE_ROWS / max(1, rows)), SAMPLE_SEED)
    if rows > SAMPLE_ROWS and low is not None and high > low:
        span = (high - low) / SAMPLE_RANGES
        width = int(span * SAMPLE_ROWS / rows)
        starts = [low + int(span * (n + 0.5)) for n in range(SAMPLE_RANGES)]
        within = F.lit(False)
        for start in starts:
            within = within | F.col("doc_id").between(start, start + width)
        found = cut(base_columns(read.where(within).limit(2 * SAMPLE_ROWS)), "sample")
        if not found.isEmpty():
            return found
    return cut(base_columns(chosen), "sample")


def costs(sample: DataFrame, found: list[Rule]) -> tuple[dict[str, float], dict[str, int]]:
    """Seconds and rejections of each rule over the rows of ``sample`` that pass the base conditions."""
    left = cut(sample.where(~base_failed()), "left")
    rows, chars = left.agg(F.count("*"), F.sum(F.length("_text"))).first()
    if not rows:
        return {rule.name: STEP for rule in found}, {rule.name: 0 for rule in found}
    times = max(1, min(TIMED_ROWS // rows, TIMED_CHARS // max(1, chars)))
    repeated = left.select("*", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("_time"))

    def timed(fails: Column) -> tuple[float, int]:
        best, rejected = float("inf"), 0
        for run in range(RUNS + 1):
            began = time.perf_counter()
            rejected = repeated.agg(F.count_if(fails)).first()[0] // times
            best = min(best, time.perf_counter() - began) if run else best  # the first run compiles the plan
        return best, rejected

    empty, _ = timed(F.length("_text") < F.col("_time") - times)
    measured = {rule.name: timed(F.coalesce(rule.fails, F.lit(False))) for rule in found}
    return {name: max(1, round((took - empty) / STEP)) * STEP for name, (took, _) in measured.items()}, {name: n for name, (_, n) in measured.items()}


def ordered(sample: DataFrame, found: list[Rule]) -> list[Rule]:
    """The rules by rejections per cost over ``sample``, a small table of base columns; ties by cost, then by name.

    Costs below ``STEP`` are not told apart. Without rows the rules are in the order of their names.
    """
    cost, rejected = costs(sample, found)
    return sorted(found, key=lambda rule: (-rejected[rule.name] / cost[rule.name], cost[rule.name], rule.name))


def cascade(found: list[Rule]) -> Column:
    """The name of the first rule that fails, or null; later rules are not evaluated."""
    reason = F.when(base_failed(), F.lit("base"))
    for rule in found:
        reason = reason.when(F.coalesce(rule.fails, F.lit(False)), F.lit(rule.name))
    return reason


def judge(docs: DataFrame, found: list[Rule] | None = None) -> DataFrame:
    """Base columns of every row of ``docs`` (doc_id, text) with base_failed, failed_rule and kept.

    The base columns are part of the result and are computed for every row; what the cascade saves
    are the conditions of the rules after the base conditions or a rule has failed. A null text has
    no words and fails, as does an empty one. Very long texts are judged whole; the arrays of their
    words and windows take the memory of some copies of the text. Repeated rows and null ids are
    judged like others. Other columns of ``docs`` are ignored. No rows give no rows.
    """
    found = rules() if found is None else found
    judged = base_columns(docs).select("*", cascade(ordered(sampled(docs), found)).alias("failed_rule"))
    return judged.select("*", base_failed().alias("base_failed"), F.col("failed_rule").isNull().alias("kept")).drop("_text")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures of every document and whether it is kept."""
    return judge(table(spark, sf_dir, "documents")).drop("failed_rule")


OP9_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, greatest(len(words) - 1, 1))) AS i, words FROM w
), h AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM g
), c AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM h WHERE n > 1) GROUP BY doc_id
), b AS (
  SELECT w.doc_id, text, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id
), f AS (
  SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM b
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 10 > n_words * 8
            OR n_dup_lines * 10 > len(string_split(text, chr(10))) * 6
            OR word_chars < n_words * 2 OR word_chars > n_words * 15
            OR len(regexp_extract_all(text, '!!')) * 10 > n_words * 3
            OR len(regexp_extract_all(text, '[^\x20\x09-\x0D]*\pL[^\x20\x09-\x0D]*')) * 10 < n_words * 6) AS kept
FROM f
"""
