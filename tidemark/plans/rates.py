"""Queries on the metric packs: rates of receivers, defences, pass defences and single games, and errors of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import filters as P
from tidemark.functions import metrics as M
from tidemark.operators.cumulative import totals
from tidemark.operators.model import evaluate
from tidemark.plans.registry import query
from tidemark.plans.totals import table

#: Whole-number totals by supplier: name -> SQL over line items, the same text in both engines.
_SUMS = {
    "tgt": "l_linenumber * 3", "rec": "l_linenumber * 2", "yds": "CAST(l_quantity AS INT) * 5", "air_yds": "CAST(l_quantity AS INT) * 3", "yac": "CAST(l_quantity AS INT) * 2",
    "td": "CASE WHEN l_linenumber > 5 THEN 1 ELSE 0 END", "int": "CASE WHEN l_linenumber = 4 THEN 1 ELSE 0 END", "drp": "CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END",
    "brkn_tkl": "CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END", "cmp": "l_linenumber * 2", "att": "l_linenumber * 3", "sk": "CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END",
    "sk_yds": "CASE WHEN l_linenumber = 1 THEN 7 ELSE 0 END", "prss": "CASE WHEN l_linenumber <= 2 THEN 1 ELSE 0 END", "mtkl": "CASE WHEN l_quantity < 5 THEN 1 ELSE 0 END",
    "comb_tkl": "l_linenumber", "fmbl_rec": "CASE WHEN l_orderkey % 7 = 0 THEN 1 END",
}


def _teams(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """Totals of all line items of a supplier, as columns with the prefix, and game_count."""
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", *[F.expr(f"CAST({e} AS BIGINT)").alias(prefix + n) for n, e in _SUMS.items()])
    return totals(rows, ["l_suppkey"], [prefix + n for n in _SUMS])


_TEAMS = f"t AS (SELECT l_suppkey, count(*) AS g, {', '.join(f'CAST(sum({e}) AS DOUBLE) AS x_{n}' for n, e in _SUMS.items())} FROM lineitem GROUP BY l_suppkey)"


def _rating(c: str, a: str, y: str, t: str, i: str) -> str:
    parts = [f"({c} / {a} - 0.3::DOUBLE) * 5", f"({y} / {a} - 3) * 0.25::DOUBLE", f"{t} / {a} * 20", f"2.375::DOUBLE - {i} / {a} * 25"]
    return f"CASE WHEN {a} > 0 THEN ({' + '.join(f'least(greatest({p}, 0), 2.375::DOUBLE)' for p in parts)}) / 6 * 100 END"


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


def _rates(df: DataFrame, pack: dict) -> DataFrame:
    return M.with_metrics(df, pack).select("l_suppkey", *[F.col(c).cast("double").alias(c) for c in pack])


_RECEIVING = {
    "rec_adot": "x_air_yds / nullif(x_tgt, 0)", "rec_catch_pct": "x_rec / nullif(x_tgt, 0)", "rec_yds_rec": "x_yds / nullif(x_rec, 0)", "rec_yds_tgt": "x_yds / nullif(x_tgt, 0)",
    "rec_ypg": "x_yds / g", "rec_air_yds_rec": "x_air_yds / nullif(x_rec, 0)", "rec_yac_rec": "x_yac / nullif(x_rec, 0)", "rec_brkn_tkl_rec": "x_brkn_tkl / nullif(x_rec, 0)",
    "rec_drp_pct": "x_drp / nullif(x_tgt, 0)", "rec_pass_rtg": _rating("x_rec", "x_tgt", "x_yds", "x_td", "x_int"),
}


@query(f"WITH {_TEAMS} SELECT l_suppkey, {_select(_RECEIVING)} FROM t")
def receiving_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rates of receivers, recomputed from season totals."""
    return _rates(_teams(spark, sf_dir, "rec_"), M.receiving_pack())


_DEFENCE = {
    "def_cmp_pct": "x_cmp / nullif(x_tgt, 0)", "def_yds_cmp": "x_yds / nullif(x_cmp, 0)", "def_yds_tgt": "x_yds / nullif(x_tgt, 0)", "def_adot": "x_air_yds / nullif(x_tgt, 0)",
    "def_yac_cmp": "x_yac / nullif(x_cmp, 0)", "def_mtkl_pct": "x_mtkl / nullif(x_comb_tkl + x_mtkl, 0)", "def_sk_pct": "x_sk / nullif(x_prss, 0)", "def_int_pct": "x_int / nullif(x_tgt, 0)",
    "def_tkl_pg": "x_comb_tkl / g", "def_sk_pg": "x_sk / g", "def_prss_pg": "x_prss / g", "def_to": "coalesce(x_int, 0) + coalesce(x_fmbl_rec, 0)",
    "def_to_pg": "(coalesce(x_int, 0) + coalesce(x_fmbl_rec, 0)) / g", "def_pass_rtg": _rating("x_cmp", "x_tgt", "x_yds", "x_td", "x_int"),
}


@query(f"WITH {_TEAMS} SELECT l_suppkey, {_select(_DEFENCE)} FROM t")
def defence_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fourteen rates of a defence, turnovers among them."""
    return _rates(_teams(spark, sf_dir, "def_"), M.defence_pack())


_BONUS = "20 * x_td - 45 * x_int"
_PASS_DEFENCE = {
    "pass_cmp_pct": "x_cmp / nullif(x_att, 0)", "pass_td_pct": "x_td / nullif(x_att, 0)", "pass_int_pct": "x_int / nullif(x_att, 0)", "pass_yds_att": "x_yds / nullif(x_att, 0)",
    "pass_adj_yds_att": f"(x_yds + {_BONUS}) / nullif(x_att, 0)", "pass_yds_cmp": "x_yds / nullif(x_cmp, 0)", "pass_ypg": "x_yds / g", "pass_sk_pct": "x_sk / nullif(x_att + x_sk, 0)",
    "pass_net_yds_att": "(x_yds - x_sk_yds) / nullif(x_att + x_sk, 0)", "pass_adj_net_yds_att": f"(x_yds - x_sk_yds + {_BONUS}) / nullif(x_att + x_sk, 0)",
    "pass_rtg": _rating("x_cmp", "x_att", "x_yds", "x_td", "x_int"),
}


@query(f"WITH {_TEAMS} SELECT l_suppkey, {_select(_PASS_DEFENCE)}, CAST(NULL AS DOUBLE) AS pass_exp, g AS games FROM t")
def pass_defence_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven rates of a pass defence, a typed null for what it has no source for, and the games under another name."""
    teams = _teams(spark, sf_dir, "pass_")
    found = _rates(teams, M.pass_defence_pack())
    games = teams.select("l_suppkey", F.col("game_count").alias("games"))
    return P.ensure_columns(found, {"pass_exp": "double"}).join(games, "l_suppkey")


@query("""
WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber <> 2 THEN CAST(l_quantity AS INT) END AS yds, CASE WHEN l_linenumber <> 3 THEN l_linenumber - 1 END AS att FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round(CAST(coalesce(yds, 0) AS DOUBLE) / nullif(coalesce(att, 0), 0), 4) AS yds_att FROM g
""")
def per_game_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of single games: a missing number counts as zero, and nothing by zero is null."""
    line = F.col("l_linenumber")
    games = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(line != 2, F.col("l_quantity").cast("int")).alias("yds"), F.when(line != 3, line - 1).alias("att")
    )
    return M.with_metrics(games, M.per_game({"yds_att": ("yds", "att")})).drop("yds", "att")


@query("""
WITH g AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber <> 2 THEN l_orderkey % 5 END AS cmp, CASE WHEN l_linenumber <> 3 THEN l_partkey % 8 - 1 END AS att, CASE WHEN l_suppkey % 4 > 0 THEN CAST(l_quantity AS BIGINT) - 9 END AS yds,
         CASE WHEN l_suppkey % 3 > 0 THEN l_partkey % 3 END AS td, CASE WHEN l_orderkey % 3 > 0 THEN l_suppkey % 2 END AS i, CASE WHEN l_orderkey % 7 > 0 THEN l_linenumber % 3 END AS sk, CASE WHEN l_partkey % 5 > 0 THEN l_linenumber * 2 END AS lost FROM lineitem
), z AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(cmp, 0) AS cmp, coalesce(att, 0) AS att, coalesce(yds, 0) AS yds, coalesce(td, 0) AS td, coalesce(i, 0) AS i, coalesce(sk, 0) AS sk, coalesce(lost, 0) AS lost FROM g)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN att > 0 THEN round(cmp / att, 4) END AS gm_cmp_pct, CASE WHEN att > 0 THEN round(td / att, 4) END AS gm_td_pct, CASE WHEN att > 0 THEN round(i / att, 4) END AS gm_int_pct,
  CASE WHEN att > 0 THEN round(yds / att, 4) END AS gm_yds_att, CASE WHEN att > 0 THEN round((yds + 20 * td - 45 * i) / att, 4) END AS gm_adj_yds_att, CASE WHEN cmp > 0 THEN round(yds / cmp, 4) END AS gm_yds_cmp,
  CASE WHEN att + sk > 0 THEN round(sk / (att + sk), 4) END AS gm_sk_pct, CASE WHEN att + sk > 0 THEN round((yds - lost) / (att + sk), 4) END AS gm_net_yds_att,
  CASE WHEN att + sk > 0 THEN round((yds - lost + 20 * td - 45 * i) / (att + sk), 4) END AS gm_adj_net_yds_att FROM z
""")
def game_passing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine passing rates of single games, with missing numbers, games without attempts and yards below zero."""
    order, part, supplier, line = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    games = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(line != 2, order % 5).alias("gm_cmp"), F.when(line != 3, part % 8 - 1).alias("gm_att"),
        F.when(supplier % 4 > 0, F.col("l_quantity").cast("long") - 9).alias("gm_yds"), F.when(supplier % 3 > 0, part % 3).alias("gm_td"), F.when(order % 3 > 0, supplier % 2).alias("gm_int"),
        F.when(order % 7 > 0, line % 3).alias("gm_sk"), F.when(part % 5 > 0, line * 2).alias("gm_sk_yds"),
    )
    pack = M.game_passing_pack("gm_")
    return M.with_metrics(games, pack).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *pack)


@query("""
WITH p AS (
  SELECT CAST(o_orderkey % 97 AS DOUBLE) AS y, CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_custkey % 89 AS DOUBLE) END AS p FROM orders WHERE year(o_orderdate) IN (1997, 1998)
), k AS (SELECT y, p FROM p WHERE p IS NOT NULL), m AS (SELECT avg(y) AS mean FROM k)
SELECT (SELECT count(*) FROM p) AS n_rows, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
       round(1 - sum((y - p) * (y - p)) / sum((y - mean) * (y - mean)), 6) AS r2, round(avg(abs(y - p) / greatest(y, 1)) * 100, 6) AS mape FROM k, m
""")
def regression_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of given predictions on the later years, which a split by years keeps apart from those learned from."""
    rows = table(spark, sf_dir, "orders").withColumn("season", F.year("o_orderdate"))
    _, test = P.split_by_years(rows, "season", [1995, 1996], [1997, 1998])
    scored = test.select((F.col("o_orderkey") % 97).alias("y"), F.when(F.col("o_orderkey") % 11 > 0, F.col("o_custkey") % 89).alias("p"))
    return evaluate(scored, "y", "p").select("n_rows", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2", "mape")])
