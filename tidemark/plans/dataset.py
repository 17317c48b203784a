"""The wide dataset from end to end, the model on it, and incremental totals over a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import windows as W
from tidemark.operators.aggregates import eligible, merge_duplicates
from tidemark.operators.cumulative import running_totals
from tidemark.operators.joins import FeatureSource, join_source
from tidemark.operators.model import evaluate, fit_forest
from tidemark.plans.registry import query
from tidemark.plans.totals import exact, table
from tidemark.streaming.incremental import shared_dir, stream_totals


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cust, season, month, spend): a customer's orders as one game a month; money in cents, so sums are exact."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("cust"), F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("month"),
        (F.col("o_totalprice").cast("decimal(14,2)") * 100).cast("long").alias("spend"),
    )
    return rows


_WIDE = """
WITH m AS (
  SELECT o_custkey AS cust, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 100 AS BIGINT) AS spend FROM orders
), g AS (
  SELECT cust, season, month, avg(spend) AS spend FROM m GROUP BY ALL
), e AS (
  SELECT cust, season FROM g WHERE spend >= 5000000 GROUP BY ALL HAVING count(*) >= 2
), s AS (
  SELECT g.* FROM g JOIN e ON g.cust = e.cust AND g.season = e.season
), t AS (
  SELECT cust, season, month, sum(spend) OVER w AS season_spend, count(*) OVER w AS game_count FROM m WINDOW w AS (PARTITION BY cust, season ORDER BY month)
), n AS (
  SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS nation_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
), r AS (
  SELECT s.*, lead(month) OVER v AS next_month, lead(spend) OVER v AS next_spend, avg(spend) OVER (PARTITION BY cust ORDER BY season, month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS roll_3g_spend
  FROM s WINDOW v AS (PARTITION BY cust, season ORDER BY month)
)
SELECT r.cust, r.season, r.month, round(r.spend, 4) AS spend, round(r.next_spend, 4) AS next_spend, r.next_month, round(r.roll_3g_spend, 4) AS roll_3g_spend, c_nationkey AS nation,
       CAST(t.season_spend AS BIGINT) AS season_spend, t.game_count, coalesce(n.nation_orders, 0) AS nation_orders
FROM r JOIN customer ON r.cust = c_custkey LEFT JOIN (SELECT DISTINCT * FROM t) AS t ON r.cust = t.cust AND r.season = t.season AND r.month = t.month
LEFT JOIN n ON n.nation = c_nationkey AND n.season = r.season AND n.month = r.month WHERE r.next_spend IS NOT NULL
"""


@query(_WIDE)
def wide_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine, eligibility, season-to-date totals, a dimension, a group's figures, rolling means and the next game's target.

    Inputs are unique by their join keys before any join, so no step fans out.
    """
    months = _months(spark, sf_dir)
    games = merge_duplicates(months, ["cust", "season", "month"])
    spine = eligible(games, ["cust", "season"], F.col("spend") >= 5000000, 2)
    spine = W.lead_columns(spine, ["cust", "season"], ["month"], {"next_spend": "spend", "next_month": "month"})
    spine = W.rolling_means(spine, ["cust"], ["season", "month"], ["spend"], [3])
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cust"), F.col("c_nationkey").alias("nation"))
    so_far = running_totals(months, ["cust", "season"], "month", F.lit(12), ["spend"]).withColumnRenamed("spend", "season_spend")
    by_nation = months.join(customers, "cust").groupBy("nation", "season", "month").agg(F.count("*").alias("nation_orders"))
    own = {"cust": "cust", "season": "season", "month": "month"}
    for source in (
        FeatureSource(customers, {"cust": "cust"}, ["nation"]),
        FeatureSource(so_far, own, ["season_spend", "game_count"]),
        FeatureSource(by_nation, {"nation": "nation", "season": "season", "month": "month"}, ["nation_orders"], fill={"nation_orders": 0}),
    ):
        spine = join_source(spine, source)
    rounded = {c: F.round(c, 4) for c in ("spend", "next_spend", "roll_3g_spend")}
    return spine.where("next_spend IS NOT NULL").withColumns(rounded)


@query()
def forest_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of a forest trained on earlier years and tested on later ones; trees have no SQL."""
    rows = wide_dataset(spark, sf_dir).withColumns({c: F.col(c) / 100 for c in ("spend", "next_spend", "roll_3g_spend", "season_spend")})
    features = ["spend", "roll_3g_spend", "season_spend", "game_count", "nation_orders"]
    train, test = rows.where("season <= 1998"), rows.where("season > 1998")
    model = fit_forest(train, features, "next_spend", trees=20, depth=6)
    return evaluate(model.transform(test.fillna(-999, features)), "next_spend", "prediction")


@query(f"""
WITH w AS ({_WIDE}), x AS (SELECT season, next_spend / 100 AS y, spend / 100 AS p FROM w),
a AS (SELECT count(*) AS n_train, avg(y) AS mean FROM x WHERE season <= 1998), b AS (SELECT 'mean' AS model, y, mean AS p, n_train FROM x, a WHERE season > 1998 UNION ALL SELECT 'last', y, p, n_train FROM x, a WHERE season > 1998)
SELECT model, n_train, count(*) AS n_rows, round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2, round(avg(abs(y - p) / greatest(y, 1)) * 100, 4) AS mape FROM b GROUP BY model, n_train
""")
def baseline_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the forest is measured against, on the same split: the mean of the earlier years, and the value of the game before."""
    rows = wide_dataset(spark, sf_dir).select("season", (F.col("next_spend") / 100).alias("y"), (F.col("spend") / 100).alias("last"))
    train, test = rows.where("season <= 1998"), rows.where("season > 1998")
    known = train.agg(F.avg("y").alias("mean"), F.count("*").alias("n_train"))
    test = test.withColumn("mean", known.select("mean").scalar())
    found = [evaluate(test, "y", p).select(F.lit(p).alias("model"), "*") for p in ("mean", "last")]
    both = found[0].union(found[1]).withColumn("n_train", known.select("n_train").scalar())
    return both.select("model", "n_train", "n_rows", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"), F.round("mape", 4).alias("mape"))


@query("""
SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS value FROM events GROUP BY ALL
""")
def streamed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals of users, read as a stream in several batches; more files arrive before a second call on the same folder."""
    rows = lambda df: df.select("user_id", F.col("ts").cast("date").alias("day"), exact("value").alias("value"))
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events")
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).repartition(3, "event_id").write.mode("append").parquet(f"{folder}/in")
        found = stream_totals(spark, f"{folder}/in", rows, ["user_id", "day"], ["value"], "n_events", f"{folder}/state", 2)
    return found.withColumn("value", F.col("value").cast("double"))
