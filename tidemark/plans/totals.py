"""Queries on point-in-time totals and other aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.metrics import passer_rating, ratio, with_metrics
from tidemark.operators import aggregates as A
from tidemark.operators.cumulative import running_totals, totals, totals_until, two_phase
from tidemark.plans.registry import query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact(c: str) -> Column:
    """Money and quantities as decimals: their sums do not depend on the order of rows."""
    return F.col(c).cast("decimal(12,2)")


def supplier_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as games of suppliers: season is the year, period the month of shipping."""
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("season"), F.month("l_shipdate").alias("month"),
        exact("l_quantity").alias("quantity"), exact("l_extendedprice").alias("price"), F.col("l_extendedprice").alias("largest"),
    )


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in names})


@query("""
SELECT l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS price,
       max(l_extendedprice) AS largest, count(*) AS game_count,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / nullif(CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE), 0) AS price_per_unit
FROM lineitem WHERE year(l_shipdate) = 1997 AND month(l_shipdate) <= 6 GROUP BY l_suppkey
""")
def cumulative_supplier_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = supplier_months(spark, sf_dir).where("season = 1997")
    found = totals_until(rows, ["l_suppkey"], "month", 6, ["quantity", "price"], ["largest"])
    return with_metrics(_doubles(found, "quantity", "price"), {"price_per_unit": ratio("price", "quantity")})


@query("""
WITH m AS (
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS season, CAST(month(l_shipdate) AS INTEGER) AS month, sum(CAST(l_quantity AS DECIMAL(12,2))) AS q,
         sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS p, max(l_extendedprice) AS largest, count(*) AS n
  FROM lineitem GROUP BY ALL
), g AS (
  SELECT l_suppkey, season, CAST(unnest(range(first, 13)) AS INTEGER) AS month FROM (SELECT l_suppkey, season, min(month) AS first FROM m GROUP BY ALL)
), t AS (
  SELECT g.l_suppkey, g.season, g.month, CAST(sum(q) AS DOUBLE) AS quantity, CAST(sum(p) AS DOUBLE) AS price, max(largest) AS largest, CAST(sum(n) AS BIGINT) AS game_count
  FROM g JOIN m ON g.l_suppkey = m.l_suppkey AND g.season = m.season AND m.month <= g.month GROUP BY ALL
)
SELECT *, price / nullif(quantity, 0) AS price_per_unit, quantity / nullif(CAST(game_count AS DOUBLE), 0) AS quantity_per_game FROM t
""")
def cumulative_all_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season-to-date totals of every supplier in every month, in one pass."""
    found = running_totals(supplier_months(spark, sf_dir), ["l_suppkey", "season"], "month", F.lit(12), ["quantity", "price"], ["largest"])
    rates = {"price_per_unit": ratio("price", "quantity"), "quantity_per_game": ratio("quantity", "game_count")}
    return with_metrics(_doubles(found, "quantity", "price"), rates)


@query("""
WITH g AS (
  SELECT s_nationkey, l_orderkey, sum(CAST(l_quantity AS DECIMAL(12,2))) AS q, max(l_extendedprice) AS largest
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL
)
SELECT s_nationkey, CAST(sum(q) AS DOUBLE) AS quantity, max(largest) AS largest, count(*) AS game_count,
       CAST(sum(q) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0) AS per_game
FROM g GROUP BY s_nationkey
""")
def two_phase_rollup_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' rows to a nation's orders, then to the nation: the count is of orders."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
    rows = rows.select("s_nationkey", "l_orderkey", exact("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("largest"))
    found = two_phase(rows, ["s_nationkey"], "l_orderkey", ["quantity"], ["largest"])
    return with_metrics(_doubles(found, "quantity"), {"per_game": ratio("quantity", "game_count")})


@query("""
SELECT l_suppkey, count(*) AS game_count,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / nullif(CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE), 0) AS rate
FROM lineitem GROUP BY l_suppkey
""")
def rate_not_averaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate from totals; the mean of the rows' rates would be another number."""
    rows = supplier_months(spark, sf_dir)
    found = _doubles(totals(rows, ["l_suppkey"], ["quantity", "price"]), "quantity", "price")
    return found.select("l_suppkey", "game_count", ratio("price", "quantity").alias("rate"))


@query("""
WITH t AS (
  SELECT l_suppkey, count(*) AS att, count(*) FILTER (WHERE l_returnflag <> 'R') AS cmp, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) / 4 AS yds,
         count(*) FILTER (WHERE l_tax > 0.07) AS td, count(*) FILTER (WHERE l_discount < 0.005) AS lost
  FROM lineitem GROUP BY l_suppkey
)
SELECT l_suppkey, att, (least(greatest((CAST(cmp AS DOUBLE) / att - 0.3::DOUBLE) * 5, 0), 2.375::DOUBLE) + least(greatest((yds / att - 3) * 0.25::DOUBLE, 0), 2.375::DOUBLE)
       + least(greatest(CAST(td AS DOUBLE) / att * 20, 0), 2.375::DOUBLE) + least(greatest(2.375::DOUBLE - CAST(lost AS DOUBLE) / att * 25, 0), 2.375::DOUBLE)) / 6 * 100 AS rating
FROM t
""")
def passer_rating_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("att"), F.count_if(F.col("l_returnflag") != "R").alias("cmp"), (F.sum(exact("l_quantity")).cast("double") / 4).alias("yds"),
        F.count_if(F.col("l_tax") > 0.07).alias("td"), F.count_if(F.col("l_discount") < 0.005).alias("lost"),
    )
    return t.select("l_suppkey", "att", passer_rating("cmp", "att", "yds", "td", "lost").alias("rating"))


@query("""
SELECT l_orderkey, l_linenumber, avg(l_quantity) AS l_quantity, min(l_partkey) AS l_partkey, min(l_returnflag) AS l_returnflag
FROM lineitem GROUP BY l_orderkey, l_linenumber
""")
def dedupe_mean_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_returnflag")
    return A.merge_duplicates(rows, ["l_orderkey", "l_linenumber"], ["l_partkey"])


@query("""
WITH e AS (SELECT o_custkey FROM orders WHERE o_totalprice >= 50000 GROUP BY o_custkey HAVING count(*) >= 4)
SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total
FROM orders WHERE o_custkey IN (SELECT o_custkey FROM e) GROUP BY o_custkey
""")
def having_semi_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = A.eligible(table(spark, sf_dir, "orders"), ["o_custkey"], F.col("o_totalprice") >= 50000, 4)
    return kept.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double").alias("total"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_returnflag = 'R' DESC, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_returnflag) AS nth FROM lineitem
) WHERE nth = 1
""")
def summary_row_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag")]
    rows = table(spark, sf_dir, "lineitem")
    return A.summary_rows(rows, ["l_orderkey", "l_linenumber"], F.col("l_returnflag") == "R", order).select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM (
  SELECT *, count(*) OVER w AS n, max(CAST(l_returnflag = 'R' AS INTEGER)) OVER w AS has FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber)
) WHERE n = 1 OR has = 0 OR l_returnflag = 'R'
""")
def total_rows_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return A.total_rows_only(rows, ["l_orderkey", "l_linenumber"], F.col("l_returnflag") == "R")


@query("""
SELECT l_suppkey, season, string_agg(CAST(month AS VARCHAR), ',' ORDER BY month) AS months, count(*) AS n_months FROM (
  SELECT DISTINCT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS season, month(l_shipdate) AS month FROM lineitem
) GROUP BY ALL
""")
def week_set_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = supplier_months(spark, sf_dir).groupBy("l_suppkey", "season").agg(A.set_text(F.col("month")).alias("months"))
    return rows.withColumn("n_months", F.size(F.split("months", ",")).cast("long"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_key_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
WITH p AS (
  SELECT l_suppkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags, count(DISTINCT (l_returnflag, l_linestatus)) AS n_pairs FROM lineitem GROUP BY l_suppkey
)
SELECT flags, count(*) AS n_suppliers, CAST(sum(n_pairs) AS BIGINT) AS n_pairs FROM p GROUP BY flags
""")
def group_concat_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(A.set_text(F.col("l_returnflag")).alias("flags"), A.distinct_of("l_returnflag", "l_linestatus").alias("n_pairs"))
    return per.groupBy("flags").agg(F.count("*").alias("n_suppliers"), F.sum("n_pairs").alias("n_pairs"))


@query("""
SELECT c_nationkey, min_by(c_name, c_custkey) FILTER (WHERE c_mktsegment <> 'FURNITURE') AS c_name, max(c_acctbal) AS c_acctbal FROM customer GROUP BY c_nationkey
""")
def first_filled_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of one key merged: the first name that is not blank, the largest balance."""
    rows = table(spark, sf_dir, "customer").select(
        "c_nationkey", "c_custkey", F.when(F.col("c_mktsegment") == "FURNITURE", " ").otherwise(F.col("c_name")).alias("c_name"), "c_acctbal"
    )
    return A.first_filled(rows, ["c_nationkey"], F.col("c_custkey"), ["c_acctbal", "c_custkey"]).drop("c_custkey")


_PROFILED = ["o_totalprice", "o_custkey", "o_orderkey"]


@query("""
SELECT 'o_totalprice' AS "column", count(*) AS n_rows, count(o_totalprice) AS n_known, count(*) - count(o_totalprice) AS n_null, count(DISTINCT o_totalprice) AS n_distinct,
       min(o_totalprice) AS least, max(o_totalprice) AS most, round(avg(o_totalprice), 4) AS mean FROM orders
UNION ALL SELECT 'o_custkey', count(*), count(o_custkey), count(*) - count(o_custkey), count(DISTINCT o_custkey), min(o_custkey), max(o_custkey), round(avg(o_custkey), 4) FROM orders
UNION ALL SELECT 'o_orderkey', count(*), count(o_orderkey), count(*) - count(o_orderkey), count(DISTINCT o_orderkey), min(o_orderkey), max(o_orderkey), round(avg(o_orderkey), 4) FROM orders
""")
def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.profile(table(spark, sf_dir, "orders"), _PROFILED).withColumn("mean", F.round("mean", 4))


@query("""
WITH o AS (SELECT o_orderstatus, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS cust FROM orders)
SELECT o_orderstatus, 'price' AS "column", count(*) - count(price) AS n_null FROM o GROUP BY ALL
UNION ALL SELECT o_orderstatus, 'cust', count(*) - count(cust) FROM o GROUP BY ALL
""")
def null_counts_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("price"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey")).alias("cust")
    )
    return A.null_counts(rows, ["o_orderstatus"], ["price", "cust"])


@query("""
WITH v AS (SELECT CASE WHEN l_orderkey % 97 = 0 THEN l_quantity * 100 ELSE l_quantity END AS q FROM lineitem),
b AS (SELECT quantile_cont(q, 0.25) AS q1, quantile_cont(q, 0.75) AS q3 FROM v)
SELECT 'q' AS "column", q1, q3, count(*) FILTER (WHERE q < q1 - 3 * (q3 - q1) OR q > q3 + 3 * (q3 - q1)) AS n_outliers FROM v, b GROUP BY ALL
""")
def outliers_3iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_orderkey") % 97 == 0, F.col("l_quantity") * 100).otherwise(F.col("l_quantity")).alias("q"))
    return A.outliers(rows, ["q"])


@query("""
WITH v AS (SELECT l_quantity AS q, l_quantity * 2 + l_linenumber * 5 AS near, -3 * l_quantity + l_linenumber AS against, l_discount AS d FROM lineitem)
SELECT a, b, round(r, 9) AS r FROM (
  SELECT 'q' AS a, 'near' AS b, corr(q, near) AS r FROM v UNION ALL SELECT 'q', 'against', corr(q, against) FROM v UNION ALL SELECT 'q', 'd', corr(q, d) FROM v
  UNION ALL SELECT 'near', 'against', corr(near, against) FROM v UNION ALL SELECT 'near', 'd', corr(near, d) FROM v UNION ALL SELECT 'against', 'd', corr(against, d) FROM v
) WHERE abs(r) >= 0.5
""")
def pearson_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of columns that rise or fall together; those that do not are left out."""
    q, line = F.col("l_quantity"), F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(q.alias("q"), (q * 2 + line * 5).alias("near"), (-3 * q + line).alias("against"), F.col("l_discount").alias("d"))
    return A.correlations(rows, ["q", "near", "against", "d"], 0.5).withColumn("r", F.round("r", 9))


@query("""
SELECT 'l_quantity' AS "column", round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std, round(stddev_pop(l_quantity), 6) AS std_pop,
       round(avg(pow((l_quantity - m) / s, 3)), 6) AS skew, round(avg(pow((l_quantity - m) / s, 4)) - 3, 6) AS kurtosis, median(l_quantity) AS median
FROM lineitem, (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM lineitem)
""")
def column_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = A.statistics(table(spark, sf_dir, "lineitem"), ["l_quantity"])
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "std", "std_pop", "skew", "kurtosis")})


@query("""
SELECT o_orderstatus, max(CASE WHEN o_orderpriority = '1-URGENT' THEN n END) AS urgent, max(CASE WHEN o_orderpriority = '5-LOW' THEN n END) AS low
FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_orderstatus
""")
def key_value_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    return A.key_values(counts, ["o_orderstatus"], "o_orderpriority", "n", {"1-URGENT": "urgent", "5-LOW": "low"})


@query("""
WITH c AS (SELECT l_suppkey, l_returnflag, count(*) FILTER (WHERE l_linestatus = 'O') AS open, count(*) FILTER (WHERE l_linestatus = 'F') AS filled FROM lineitem GROUP BY ALL)
SELECT l_suppkey, team, max(CASE WHEN l_returnflag = 'A' THEN v END) AS accepted, max(CASE WHEN l_returnflag = 'R' THEN v END) AS returned
FROM (SELECT l_suppkey, l_returnflag, 'open' AS team, open AS v FROM c UNION ALL SELECT l_suppkey, l_returnflag, 'filled', filled FROM c) GROUP BY ALL
""")
def transpose_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        F.count_if(F.col("l_linestatus") == "O").alias("open"), F.count_if(F.col("l_linestatus") == "F").alias("filled")
    )
    return A.transposed(counts, ["l_suppkey"], "l_returnflag", ["open", "filled"], {"A": "accepted", "R": "returned"})
