"""Queries on sequences of rows: leads, rolling means, sequence numbers, as-of joins, intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import windows as W
from tidemark.operators.aggregates import slots
from tidemark.operators.joins import as_of, in_interval, nearest
from tidemark.plans.registry import query
from tidemark.plans.totals import table

_ORDER = ["ts", "event_id"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users; every ninth value is the sentinel of a missing one."""
    value = F.when(F.col("event_id") % 9 == 0, F.lit(-999.0)).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", value.alias("value"), F.get_json_object("props", "$.k").cast("double").alias("k"))


_EVENTS = """
e AS (
  SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 9 = 0 THEN -999.0::DOUBLE ELSE value END AS value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events
)
"""


@query("""
SELECT event_id, user_id, lead(event_id) OVER w AS next_event_id, lead(event_type) OVER w AS next_event_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def lead_next_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = W.lead_columns(table(spark, sf_dir, "events"), ["user_id"], _ORDER, {"next_event_id": "event_id", "next_event_type": "event_type"})
    return found.select("event_id", "user_id", "next_event_id", "next_event_type")


@query(f"""
WITH {_EVENTS}
SELECT event_id, round(avg(nullif(value, -999)) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS roll_3g_value,
       round(avg(nullif(value, -999)) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS roll_5g_value,
       round(avg(k) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS roll_3g_k, round(avg(k) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS roll_5g_k
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def rolling_mean_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = W.rolling_means(events(spark, sf_dir), ["user_id"], _ORDER, ["value", "k"])
    names = [f"roll_{k}g_{c}" for c in ("value", "k") for k in (3, 5)]
    return found.select("event_id", *[F.round(c, 6).alias(c) for c in names])


@query(f"""
WITH {_EVENTS}, r AS (
  SELECT event_id, avg(nullif(value, -999)) OVER w AS v, avg(k) OVER w AS k FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
)
SELECT event_id, round(CASE WHEN k > 0 THEN v / k END, 6) AS roll_3g_value_per_k FROM r
""")
def rolling_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = W.rolling_means(events(spark, sf_dir), ["user_id"], _ORDER, ["value", "k"], [3])
    found = W.rolling_ratios(found, {"value_per_k": ("value", "k")}, [3])
    return found.select("event_id", F.round("roll_3g_value_per_k", 6).alias("roll_3g_value_per_k"))


@query("""
WITH s AS (
  SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, o_orderdate FROM orders
), n AS (
  SELECT o_orderkey, season, row_number() OVER (PARTITION BY o_custkey ORDER BY season, o_orderdate, o_orderkey) AS career,
         row_number() OVER (PARTITION BY o_custkey, season ORDER BY o_orderdate, o_orderkey) AS own FROM s
)
SELECT o_orderkey, CAST(career AS INTEGER) AS career_game_seq_num, CAST(own AS INTEGER) AS game_seq_num, CAST(career > own AND own <= 3 AS INTEGER) AS is_season_carryover,
       CAST(career > 3 AS INTEGER) AS has_min_games_3g, CAST(career > 5 AS INTEGER) AS has_min_games_5g FROM n
""")
def seq_num_carryover(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.year("o_orderdate").alias("season"))
    return W.sequence_numbers(rows, "o_custkey", "season", ["o_orderdate", "o_orderkey"]).drop("o_custkey", "o_orderdate", "season")


@query("""
WITH n AS (SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq FROM orders)
SELECT o_orderkey, round(CASE WHEN count(*) OVER w > 1 THEN regr_slope(o_totalprice, seq) OVER w END, 4) AS slope
FROM n WINDOW w AS (PARTITION BY o_custkey ORDER BY seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
""")
def trend_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = W.trend(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice")
    return found.select("o_orderkey", F.round("trend_3g_o_totalprice", 4).alias("slope"))


@query("""
WITH f AS (
  SELECT o_totalprice < lag(o_totalprice) OVER w AS a, o_orderkey < lag(o_orderkey) OVER w AS b FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)
)
SELECT 'o_totalprice' AS "column", count(*) FILTER (WHERE a) AS falls FROM f UNION ALL SELECT 'o_orderkey', count(*) FILTER (WHERE b) FROM f
""")
def monotonic_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.decreases(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"], ["o_totalprice", "o_orderkey"])


@query("""
SELECT l_orderkey, l_partkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS INTEGER) AS row_id FROM lineitem
""")
def numbered_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return W.numbered(table(spark, sf_dir, "lineitem"), ["l_orderkey"], order, "row_id").select("l_orderkey", "l_partkey", "row_id")


@query("""
WITH r AS (
  SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS a, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2 AS b
  FROM lineitem
)
SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(a, b), 9) AS r, count(*) AS n FROM r
""")
def spearman_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.average_ranks(table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
    found = rows.agg(F.round(F.corr("rank_l_quantity", "rank_l_extendedprice"), 9).alias("r"), F.count("*").alias("n"))
    return found.select(F.lit("l_quantity").alias("a"), F.lit("l_extendedprice").alias("b"), "r", "n")


def _purchases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "events")
    buys = rows.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = rows.where("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    return buys, views


@query("""
SELECT b.event_id, b.user_id, v.event_id AS view_id, v.value AS view_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') AS b ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') AS v ON b.user_id = v.user_id AND b.ts >= v.ts
""")
def asof_latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last view before each purchase."""
    buys, views = _purchases(spark, sf_dir)
    return as_of(buys, views, ["user_id"], "ts", "view_ts", ["view_id", "view_value"]).drop("ts")


@query("""
SELECT b.event_id, min_by(v.event_id, (abs(epoch_us(v.ts) - epoch_us(b.ts)), epoch_us(v.ts), v.event_id)) AS view_id
FROM (SELECT * FROM events WHERE event_type = 'purchase') AS b LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') AS v ON b.user_id = v.user_id GROUP BY b.event_id
""")
def asof_nearest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view nearest in time to each purchase, before or after."""
    buys, views = _purchases(spark, sf_dir)
    return nearest(buys, views, ["user_id"], "ts", "view_ts", ["view_id"]).select("event_id", "view_id")


@query("""
WITH n AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS slot FROM events)
SELECT user_id, max(event_type) FILTER (WHERE slot = 1) AS s1_event_type, max(value) FILTER (WHERE slot = 1) AS s1_value,
       max(event_type) FILTER (WHERE slot = 2) AS s2_event_type, max(value) FILTER (WHERE slot = 2) AS s2_value FROM n GROUP BY user_id
""")
def slots_to_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.numbered(table(spark, sf_dir, "events"), ["user_id"], _ORDER, "slot").where("slot <= 2")
    return slots(rows, ["user_id"], "slot", ["event_type", "value"], [1, 2])


@query("""
WITH s AS (
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders
), i AS (
  SELECT o_custkey, d AS s, lead(d) OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS e, o_orderkey AS v FROM s
)
SELECT o.o_orderkey, (SELECT min_by(i.v, (i.s, coalesce(i.e, DATE '9999-01-01'), i.v)) FROM i WHERE i.o_custkey = o.o_custkey AND i.s <= CAST(o.o_orderdate AS DATE) AND (i.e IS NULL OR i.e >= CAST(o.o_orderdate AS DATE))) AS span
FROM orders AS o
""")
def interval_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stint that each order falls into; a stint lasts from one order of a customer to the next."""
    rows = table(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    spans = W.lead_columns(rows, ["o_custkey"], ["d", "o_orderkey"], {"e": "d"})
    spans = spans.select("o_custkey", F.col("d").alias("s"), F.coalesce("e", F.to_date(F.lit("9999-01-01"))).alias("e"), F.col("o_orderkey").alias("span"))
    return in_interval(rows, spans, ["o_custkey"], "d", "s", "e", "span").select("o_orderkey", "span")
