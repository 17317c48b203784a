"""Queries on imputation, merges, filters and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import filters as P
from tidemark.operators import impute as I
from tidemark.operators import quality as Q
from tidemark.plans.registry import query
from tidemark.plans.totals import table
from tidemark.sources.sinks import merge, merge_counts


def _receiving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as games of receivers, with nulls where a rate has no denominator or no source."""
    key = F.col("l_orderkey") + F.col("l_linenumber")
    rec = (F.col("l_linenumber") % 3).cast("int")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", rec.alias("plyr_gm_rec"), F.when((rec > 0) & (key % 5 > 0), F.col("l_quantity")).alias("plyr_gm_rec_first_dwn"),
        F.when(rec > 0, F.col("l_tax")).alias("plyr_gm_rec_aybc_route"), (key % 2).cast("int").alias("plyr_gm_rec_brkn_tkl"), F.when(key % 2 > 0, F.col("l_discount")).alias("plyr_gm_rec_brkn_tkl_rec"),
    )


@query("""
WITH r AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_linenumber % 3 AS INTEGER) AS rec, CAST((l_orderkey + l_linenumber) % 2 AS INTEGER) AS bt,
         CASE WHEN l_linenumber % 3 > 0 AND (l_orderkey + l_linenumber) % 5 > 0 THEN l_quantity END AS fd, CASE WHEN l_linenumber % 3 > 0 THEN l_tax END AS ay, CASE WHEN (l_orderkey + l_linenumber) % 2 > 0 THEN l_discount END AS btr
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, l_partkey, rec AS plyr_gm_rec, coalesce(fd, -999) AS plyr_gm_rec_first_dwn, CASE WHEN rec = 0 THEN coalesce(ay, -999) ELSE ay END AS plyr_gm_rec_aybc_route, bt AS plyr_gm_rec_brkn_tkl,
       CASE WHEN bt = 0 THEN coalesce(btr, -999) ELSE btr END AS plyr_gm_rec_brkn_tkl_rec, CAST(rec = 0 AND (fd IS NULL OR ay IS NULL) AS INTEGER) AS plyr_gm_rec_no_catches,
       CAST(bt = 0 AND btr IS NULL AS INTEGER) AS plyr_gm_rec_no_brkn_tkl, 0 AS plyr_gm_rec_no_drops, CAST(rec <> 0 AND fd IS NULL AS INTEGER) AS plyr_gm_rec_no_first_dwn FROM r
""")
def impute_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.impute(_receiving(spark, sf_dir), I.TABLES["plyr_gm_rec"])


@query("""
WITH r AS (
  SELECT event_id, CASE WHEN event_id % 3 > 0 THEN value END AS share, CASE WHEN event_id % 6 > 0 THEN value END AS epa FROM events
)
SELECT event_id, CASE WHEN share IS NULL AND epa IS NULL THEN -999 ELSE share END AS plyr_gm_rec_tgt_share, CASE WHEN share IS NULL AND epa IS NULL THEN -999 ELSE epa END AS plyr_gm_rec_epa,
       CAST(share IS NULL AND epa IS NULL AS INTEGER) AS nfl_fastr_missing_stats FROM r
""")
def all_null_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    rows = table(spark, sf_dir, "events").select("event_id", F.when(key % 3 > 0, F.col("value")).alias("plyr_gm_rec_tgt_share"), F.when(key % 6 > 0, F.col("value")).alias("plyr_gm_rec_epa"))
    return I.impute(rows, I.TABLES["dataset_fastr"])


@query("""
SELECT column_name AS "column", n_null, n_sentinel FROM (
  SELECT 'l_orderkey' AS column_name, 0 AS n_null, 0 AS n_sentinel UNION ALL SELECT 'l_linenumber', 0, 0 UNION ALL SELECT 'l_partkey', 0, 0 UNION ALL SELECT 'plyr_gm_rec', 0, 0 UNION ALL SELECT 'plyr_gm_rec_brkn_tkl', 0, 0
  UNION ALL SELECT 'plyr_gm_rec_first_dwn', count(*) FILTER (WHERE l_linenumber % 3 = 0 OR (l_orderkey + l_linenumber) % 5 = 0), 0 FROM lineitem
  UNION ALL SELECT 'plyr_gm_rec_aybc_route', count(*) FILTER (WHERE l_linenumber % 3 = 0), 0 FROM lineitem
  UNION ALL SELECT 'plyr_gm_rec_brkn_tkl_rec', count(*) FILTER (WHERE (l_orderkey + l_linenumber) % 2 = 0), 0 FROM lineitem
)
""")
def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.audit(_receiving(spark, sf_dir))


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New and changed orders: every fifth again with another status, and as many with new keys."""
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 5 = 0").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    changed = rows.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 > 0, F.lit("X"))).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return changed.union(rows.withColumn("o_orderkey", -F.col("o_orderkey") - 1))


_CHANGES = """
o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders), s AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 > 0 THEN 'X' END AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM o WHERE o_orderkey % 5 = 0
  UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice FROM o WHERE o_orderkey % 5 = 0
)
"""


@query(f"""
WITH {_CHANGES}
SELECT coalesce(o.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN o.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NULL THEN o.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus, CASE WHEN s.o_orderkey IS NULL THEN o.o_totalprice ELSE s.o_totalprice END AS o_totalprice
FROM o FULL JOIN s ON o.o_orderkey = s.o_orderkey
""")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return merge(target, _changes(spark, sf_dir), ["o_orderkey"])


@query(f"""
WITH {_CHANGES}
SELECT coalesce(o.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(s.o_custkey, o.o_custkey) AS o_custkey, coalesce(s.o_orderstatus, o.o_orderstatus) AS o_orderstatus, coalesce(s.o_totalprice, o.o_totalprice) AS o_totalprice
FROM o FULL JOIN s ON o.o_orderkey = s.o_orderkey
""")
def coalesce_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return merge(target, _changes(spark, sf_dir), ["o_orderkey"], keep_old=True)


@query("SELECT count(*) AS n_inserted, count(*) AS n_updated FROM orders WHERE o_orderkey % 5 = 0")
def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_counts(table(spark, sf_dir, "orders"), _changes(spark, sf_dir), ["o_orderkey"])


@query("""
SELECT year(o_orderdate) AS season, count(*) AS n FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998 OR year(o_orderdate) = 2000 GROUP BY 1
""")
def period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("long").alias("season"))
    return rows.where(P.in_periods(F.col("season"), "1996-1998,2000")).groupBy("season").agg(F.count("*").alias("n"))


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'large' WHEN o_orderstatus = 'F' THEN 'filled' ELSE 'other' END AS kind,
       CASE WHEN h > a THEN 'home_win' WHEN a > h THEN 'away_win' WHEN h = a THEN 'tie' END AS result
FROM (SELECT *, CASE WHEN o_orderkey % 11 > 0 THEN o_orderkey % 4 END AS h, o_custkey % 4 AS a FROM orders)
""")
def first_match_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = P.choose([(F.col("o_totalprice") > 100000, F.lit("large")), (F.col("o_orderstatus") == "F", F.lit("filled"))], F.lit("other"))
    home = F.when(F.col("o_orderkey") % 11 > 0, F.col("o_orderkey") % 4)
    return table(spark, sf_dir, "orders").select("o_orderkey", kind.alias("kind"), P.result_label(home, F.col("o_custkey") % 4).alias("result"))


@query("""
SELECT 'not_empty' AS "check", count(*) > 0 AS passed, count(*) AS n FROM lineitem
UNION ALL SELECT 'required:l_orderkey', true, 0 UNION ALL SELECT 'required:absent', false, 1
UNION ALL SELECT 'no_nulls:l_quantity', count(*) = 0, count(*) FROM lineitem WHERE l_quantity IS NULL
UNION ALL SELECT 'unique:l_orderkey,l_linenumber', count(*) = 0, count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'within:l_discount', count(*) = 0, count(*) FROM lineitem WHERE l_discount < 0 OR l_discount > 0.05::DOUBLE
""")
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.checks(
        table(spark, sf_dir, "lineitem"), required=["l_orderkey", "absent"], known=["l_quantity"], unique=["l_orderkey", "l_linenumber"], within={"l_discount": (0, 0.05)}
    )


@query("""
SELECT season, CAST(12 - count(DISTINCT month) AS BIGINT) AS n_missing FROM (SELECT year(o_orderdate) AS season, month(o_orderdate) AS month FROM orders) GROUP BY season HAVING count(DISTINCT month) < 12
""")
def season_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("long").alias("season"), F.month("o_orderdate").alias("month"))
    return Q.incomplete(rows, "season", "month", 12)
