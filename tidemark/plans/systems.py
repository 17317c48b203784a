"""Queries on spanned tables, types of text, jobs that go on where they stopped, and saved models."""

from __future__ import annotations

import uuid
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import types as T
from tidemark.operators import ledger as G
from tidemark.operators.model import evaluate, fit_forest, load_model, save_model
from tidemark.plans.registry import query
from tidemark.plans.totals import exact, table
from tidemark.sources import html as H
from tidemark.streaming.incremental import shared_dir
from tidemark.streaming.keyed import keyed_totals

if TYPE_CHECKING:
    import pandas as pd

#: A table whose header has a column over two rows and two groups, whose spans are those of the page: p and r columns.
_TABLE = """concat(html, '<TABLE class=x id="stats"><thead><tr class="over_header"><th rowspan="2">Player</th><th colspan="', p, '">Passing</th><th colspan=', r, '>Rush<i>ing</i></th></tr><tr>',
array_join(transform(sequence(1, p), x -> concat('<th scope="col">Yds', x, '</th>')), ''), array_join(transform(sequence(1, r), x -> concat('<th>\\n Att', x, ' </th>')), ''), '</tr></thead>',
array_join(transform(sequence(1, 2), y -> concat('<tr><th>P', y, '</th>', CASE WHEN page_id % 2 = 0 THEN concat('<td colspan="', p, '">', y * 7, '</td>') ELSE array_join(transform(sequence(1, p), x -> concat('<td>', y * 10 + x, '</td>')), '') END,
  array_join(transform(sequence(1, r), x -> concat('<td><b>', y * 100 + x, '</b></td>')), ''), '</tr><tr class="thead"><th>Player</th></tr>')), ''), '</table>')"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = table(spark, sf_dir, "pages").select("page_id", "html", (F.col("page_id") % 3 + 1).cast("int").alias("p"), (F.col("page_id") % 4 + 1).cast("int").alias("r"))
    return spans.select("page_id", F.expr(_TABLE).alias("html"))


_CELLS = """
WITH p AS (SELECT page_id, CAST(page_id % 3 + 1 AS INTEGER) AS p, CAST(page_id % 4 + 1 AS INTEGER) AS r FROM pages), y AS (SELECT *, CAST(unnest(range(1, 3)) AS INTEGER) AS y FROM p),
c AS (
  SELECT page_id, y, 0 AS "at", NULL AS "group", 'Player' AS name, 'P' || y AS value FROM y
  UNION ALL SELECT page_id, y, x, 'Passing', 'Yds' || x, CAST(CASE WHEN page_id % 2 = 0 THEN y * 7 ELSE y * 10 + x END AS VARCHAR) FROM y, range(1, 4) AS x(x) WHERE x <= p
  UNION ALL SELECT page_id, y, p + x, 'Rush ing', 'Att' || x, CAST(y * 100 + x AS VARCHAR) FROM y, range(1, 5) AS x(x) WHERE x <= r
)
"""


@query(f'{_CELLS} SELECT page_id, CAST(y - 1 AS INTEGER) AS "row", CAST("at" AS INTEGER) AS "at", "group", name, value FROM c')
def header_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a wide table under a spanned header, with the group and the name of their column."""
    return H.spanned_cells(_pages(spark, sf_dir), "page_id", "html", 'id="stats"').drop("table")


@query(f"""{_CELLS} SELECT page_id, CAST(y - 1 AS INTEGER) AS "row", "group", count(*) AS n, string_agg(name || '=' || value, ',' ORDER BY name) AS "values" FROM c GROUP BY page_id, y, "group" """)
def header_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table split by the groups of its header."""
    found = H.by_group(H.spanned_cells(_pages(spark, sf_dir), "page_id", "html", 'id="stats"'), "page_id")
    text = F.array_join(F.transform(F.map_entries("values"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return found.select("page_id", "row", "group", F.size("values").cast("long").alias("n"), text.alias("values"))


_TEXTS = {
    "whole": "CAST(CASE WHEN l_linenumber % 2 = 0 THEN -l_orderkey ELSE l_orderkey END AS {text})",
    "price": "CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS {text})",
    "mixed": "CASE WHEN l_linenumber < 4 THEN CAST(l_linenumber AS {text}) ELSE concat('0', CAST(l_linenumber AS {text}), '.250') END",
    "day": "CAST(CAST(l_shipdate AS DATE) AS {text})",
    "flag": "CASE WHEN l_linenumber = 1 THEN l_returnflag WHEN l_linenumber = 2 THEN ' ' ELSE CAST(l_partkey AS {text}) END",
    "none": "CAST(NULL AS {text})",
}
_TYPES = {"whole": "TINYINT(1)", "price": "DECIMAL(7,4)", "mixed": "FLOAT(7,4)", "day": "VARCHAR(10)", "flag": "INT UNSIGNED", "none": "ENUM('a','bb')"}


def _profile_sql(name: str) -> str:
    return f"""SELECT '{name}' AS "column", count(x) AS n, count(*) FILTER (WHERE regexp_full_match(x, '[+-]?[0-9]+')) AS n_integer, count(*) FILTER (WHERE regexp_full_match(x, '[+-]?[0-9]*\\.[0-9]+')) AS n_decimal,
count(*) FILTER (WHERE regexp_full_match(x, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) AS n_date, max(CASE WHEN regexp_full_match(x, '[+-]?[0-9]*(\\.[0-9]+)?') THEN length(ltrim(split_part(ltrim(x, '+-'), '.', 1), '0')) END) AS digits,
max(CASE WHEN regexp_full_match(x, '[+-]?[0-9]*(\\.[0-9]+)?') THEN length(rtrim(split_part(x, '.', 2), '0')) END) AS "scale", max(length(x)) AS "length" FROM (SELECT nullif(trim({_TEXTS[name].format(text='VARCHAR')}), '') AS x FROM lineitem)"""


@query(" UNION ALL ".join(map(_profile_sql, _TEXTS)))
def type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds, digits and lengths of columns of text."""
    rows = table(spark, sf_dir, "lineitem").select(*[F.expr(x.format(text="STRING")).alias(c) for c, x in _TEXTS.items()])
    return T.profile(rows, list(_TEXTS))


@query(f"""
WITH p AS ({" UNION ALL ".join(map(_profile_sql, _TEXTS))}), d AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{v.replace(chr(39), chr(39) * 2)}')" for k, v in _TYPES.items())}) AS v("column", declared))
SELECT p."column", declared, CASE p."column" WHEN 'whole' THEN 'integer' WHEN 'price' THEN 'decimal' WHEN 'mixed' THEN 'decimal' WHEN 'day' THEN 'date' WHEN 'flag' THEN 'text' END AS kind,
  CASE p."column" WHEN 'whole' THEN 'INT' WHEN 'price' THEN 'DECIMAL(' || (digits + "scale") || ',' || "scale" || ')' WHEN 'mixed' THEN 'DECIMAL(' || (digits + "scale") || ',' || "scale" || ')' WHEN 'day' THEN 'DATE' WHEN 'flag' THEN 'VARCHAR(' || "length" || ')' END AS recommended,
  CASE p."column" WHEN 'whole' THEN CASE WHEN digits > 2 THEN 'too narrow' ELSE 'ok' END WHEN 'price' THEN CASE WHEN digits > 3 THEN 'too narrow' ELSE 'ok' END WHEN 'flag' THEN 'other kind' WHEN 'none' THEN 'no values' ELSE 'ok' END AS verdict
FROM p JOIN d ON p."column" = d."column"
""")
def type_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared types beside what is found and recommended."""
    return T.compared(T.recommended(type_profile(spark, sf_dir)), _TYPES)


class _Killed(Exception):
    pass


@query("""
SELECT year(o_orderdate) AS season, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL
""")
def resumed_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job of four stages is killed after the third and called again: it goes on with the fourth, from what the third has written."""
    folder = f"{shared_dir(spark)}/stages-{uuid.uuid4().hex}"
    source = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    stages = [
        ("known", lambda df: df.where("o_orderstatus <> 'P'")),
        ("seasons", lambda df: df.withColumn("season", F.year("o_orderdate").cast("long"))),
        ("exact", lambda df: df.select("season", exact("o_totalprice").alias("total"))),
        ("totals", lambda df: df.groupBy("season").agg(F.count("*").alias("n"), F.sum("total").cast("double").alias("total"))),
    ]

    def kill(df: DataFrame) -> DataFrame:
        raise _Killed

    try:
        list(G.run_stages(source, [*stages[:3], ("totals", kill)], folder))
    except _Killed:
        pass
    runs = list(G.run_stages(source, stages, folder))
    if [done for _, done, _ in runs] != [True, True, True, False]:
        raise ValueError("stages that were committed ran again")
    return runs[-1][2]


@query("""
WITH u AS (SELECT l_suppkey, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity, max(l_quantity) AS most FROM lineitem GROUP BY ALL)
SELECT l_suppkey, CASE WHEN l_suppkey % 5 > 0 THEN 'done' ELSE 'failed' END AS outcome, CASE WHEN l_suppkey % 5 > 0 THEN quantity END AS quantity, CAST(CASE WHEN l_suppkey % 5 = 0 THEN 3 END AS INTEGER) AS attempts FROM u
""")
def retried_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of work of which some always fail, after two calls of which the first was cut off: results, and what failed three times."""
    folder = f"{shared_dir(spark)}/units-{uuid.uuid4().hex}"
    work = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        import pandas as pd

        key = int(rows["l_suppkey"].iloc[0])
        if key % 5 == 0:
            raise ValueError(f"no page for {key}")
        return pd.DataFrame({"l_suppkey": [key], "quantity": [float(rows["l_quantity"].sum())]})

    call = lambda **how: G.process(work, ["l_suppkey"], total, "l_suppkey long, quantity double", folder, **how)
    call(rounds=1)
    results, failed = call()
    done = results.select("l_suppkey", F.lit("done").alias("outcome"), "quantity", F.lit(None).cast("int").alias("attempts"))
    return done.union(failed.select("l_suppkey", F.lit("failed"), F.lit(None).cast("double"), "attempt"))


@query("SELECT count(*) AS n_rows, count(*) AS n_same, 5 AS n_trees, 'o_totalprice' AS target, 2 AS n_features FROM orders")
def reloaded_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest is saved with its record and read again: its predictions for all orders are those of before."""
    folder = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice"), F.month("o_orderdate").alias("month"), (F.col("o_custkey") % 7).alias("kind"))
    features = ["month", "kind"]
    model = fit_forest(rows, features, "o_totalprice", trees=5, depth=4)
    before = model.transform(rows).select("o_orderkey", F.col("prediction").alias("before"))
    save_model(model, folder, features, "o_totalprice", evaluate(model.transform(rows), "o_totalprice", "prediction"))
    again, record = load_model(spark, folder)
    both = again.transform(rows).select("o_orderkey", "prediction").join(before, "o_orderkey")
    counts = both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("prediction") == F.col("before")).alias("n_same"))
    return counts.select("*", F.lit(int(record["trees"])).alias("n_trees"), F.lit(record["target"]).alias("target"), F.lit(len(record["features"].split(","))).alias("n_features"))


@query("""
SELECT user_id % 50 AS team, CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY ALL
""")
def corrected_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by team and day in state: files come in order of time, every fifth event first with a wrong amount, and the job is started again between."""
    folder = f"{shared_dir(spark)}/keyed-{uuid.uuid4().hex}"
    amount = F.round(F.col("value") * 100).cast("long")
    events = table(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("team"), F.col("event_id").alias("id"), amount.alias("amount"), F.col("ts").cast("timestamp").alias("time"))
    events = events.withColumn("wrong", F.col("id") % 5 == 0)
    half = events.agg(F.timestamp_micros(F.floor(F.avg(F.unix_micros("time"))))).scalar()
    dealt = events.withColumn("second", F.col("time") >= half)
    first = lambda df: df.select("team", "id", F.lit(0).cast("long").alias("version"), F.when(F.col("wrong"), F.lit(-1).cast("long")).otherwise(F.col("amount")).alias("amount"), "time")
    right = lambda df: df.where("wrong").select("team", "id", F.lit(1).cast("long").alias("version"), "amount", "time")
    schema = "team long, id long, version long, amount long, time timestamp"
    for second in (False, True):
        part = dealt.where(F.col("second") == second)
        first(part).repartition(2, "id").write.mode("append").parquet(f"{folder}/in")
        if second:
            right(dealt).union(right(dealt)).repartition(2, "id").write.mode("append").parquet(f"{folder}/in")  # delivered twice
        found = keyed_totals(spark, f"{folder}/in", schema, ["team"], f"{folder}/job", "1000 days")
    return found.select("team", F.col("day").cast("date").alias("day"), "n", "total")
