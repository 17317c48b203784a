"""Queries on joins: role-playing keys, opponents, tiered and tolerant matches, linkage, set differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import joins as J
from tidemark.operators import linkage as L
from tidemark.plans.registry import query
from tidemark.plans.totals import exact, table


@query("""
SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation AS cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation AS sn ON s_nationkey = sn.n_nationkey GROUP BY ALL
""")
def role_playing_nation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dimension in two roles; sums are taken by key before the names are looked up."""
    t = lambda n: table(spark, sf_dir, n)
    rows = (
        t("lineitem").join(t("orders"), F.expr("l_orderkey = o_orderkey")).join(t("customer"), F.expr("o_custkey = c_custkey"))
        .join(t("supplier"), F.expr("l_suppkey = s_suppkey"))
        .groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("n"), F.sum(exact("l_quantity")).cast("double").alias("quantity"))
    )
    names = t("nation").select("n_nationkey", "n_name")
    rows = J.lookup(J.lookup(rows, names, {"c_nationkey": "n_nationkey"}, "c_"), names, {"s_nationkey": "n_nationkey"}, "s_")
    return rows.select(F.col("c_n_name").alias("customer_nation"), F.col("s_n_name").alias("supplier_nation"), "n", "quantity")


_GAMES = "SELECT o_orderkey AS game, c_nationkey AS home, CAST((c_nationkey + 1 + o_orderkey % 24) % 25 AS INTEGER) AS away FROM orders JOIN customer ON o_custkey = c_custkey"


def _games(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as games of two nations, and a few rows of sacked yards for each team of each game."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    games = rows.select(F.col("o_orderkey").alias("game"), F.col("c_nationkey").alias("home"), ((F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25).cast("int").alias("away"))
    teams, yards = (("home", 7), ("home", 3), ("away", 5)), F.col("game")
    passes = F.array(*[F.struct(F.col(t).alias("team"), (yards % n).alias("yards")) for t, n in teams])
    return games, games.select("game", F.inline(passes))


@query(f"""
WITH g AS ({_GAMES}), p AS (SELECT game, home AS team, game % 7 + game % 3 AS yards FROM g UNION ALL SELECT game, away, game % 5 FROM g)
SELECT g.game, g.home AS team, p.yards FROM g JOIN p ON g.game = p.game AND g.away = p.team UNION ALL SELECT g.game, g.away, p.yards FROM g JOIN p ON g.game = p.game AND g.home = p.team
""")
def opponent_flip_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    games, passes = _games(spark, sf_dir)
    return J.opponent_values(passes, games, "game", "team", "home", "away", ["yards"])


@query(f"""
WITH g AS ({_GAMES}) SELECT least(home, away) AS low, greatest(home, away) AS high, count(*) AS n FROM g GROUP BY ALL
""")
def symmetric_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    games, _ = _games(spark, sf_dir)
    return games.groupBy(J.pair_key(F.col("home"), F.col("away")).alias("p")).agg(F.count("*").alias("n")).select("p.low", "p.high", "n")


@query("""
WITH a AS (SELECT c_nationkey AS k, count(*) AS n_customers, max(c_acctbal) AS best FROM customer GROUP BY ALL),
b AS (SELECT s_nationkey + 4 AS k, count(*) AS n_suppliers, max(s_acctbal) AS best FROM supplier GROUP BY ALL)
SELECT coalesce(a.k, b.k) AS k, n_customers, coalesce(a.best, b.best) AS best, n_suppliers FROM a FULL JOIN b ON a.k = b.k
""")
def full_outer_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by nation beside suppliers under keys moved by four, so that either side has keys of its own."""
    a = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n_customers"), F.max("c_acctbal").alias("best"))
    b = table(spark, sf_dir, "supplier").groupBy((F.col("s_nationkey") + 4).alias("k")).agg(F.count("*").alias("n_suppliers"), F.max("s_acctbal").alias("best"))
    return J.full_outer(a, b, ["k"], ["best"])


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"))
    return J.only_in(table(spark, sf_dir, "orders"), customers, ["o_custkey"]).select("o_orderkey")


@query("""
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT s_suppkey * 15 - 7 AS k FROM supplier)
SELECT k, 'missing' AS kind FROM (SELECT k FROM b EXCEPT SELECT k FROM a) UNION ALL SELECT k, 'extra' FROM (SELECT k FROM a EXCEPT SELECT k FROM b)
UNION ALL SELECT k, 'both' FROM (SELECT k FROM a INTERSECT SELECT k FROM b)
""")
def missing_extra_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders against keys made from all suppliers, of which some have no orders."""
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).distinct()
    b = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 15 - 7).alias("k"))
    parts = [(b.subtract(a), "missing"), (a.subtract(b), "extra"), (a.intersect(b), "both")]
    out = [d.select("k", F.lit(kind).alias("kind")) for d, kind in parts]
    return out[0].union(out[1]).union(out[2])


@query("""
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier
""")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return a.unionByName(b, allowMissingColumns=True)


@query("""
WITH q AS (
  SELECT n_nationkey AS qid, CASE n_nationkey % 4 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) WHEN 2 THEN 'the ' || n_name ELSE 'nowhere' END AS label FROM nation
), c AS (
  SELECT qid, n.n_nationkey AS k, 0 AS tier FROM q JOIN nation AS n ON q.label = n.n_name
  UNION ALL SELECT qid, n.n_nationkey, 1 FROM q JOIN nation AS n ON q.label = lower(n.n_name)
  UNION ALL SELECT qid, n.n_nationkey, 2 FROM q JOIN nation AS n ON list_contains(string_split(q.label, ' '), n.n_name)
)
SELECT q.qid, (SELECT arg_min(k, (tier, k)) FROM c WHERE c.qid = q.qid) AS n_nationkey, (SELECT min(tier) FROM c WHERE c.qid = q.qid) AS tier FROM q
""")
def team_lookup_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names resolved by tiers: as written, in lower case, as one of the words; the rest stays unresolved."""
    nations = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey") % 4
    label = F.when(k == 0, F.col("n_name")).when(k == 1, F.lower("n_name")).when(k == 2, F.concat(F.lit("the "), F.col("n_name"))).otherwise("nowhere")
    asked = nations.select(F.col("n_nationkey").alias("qid"), label.alias("label"))
    name, written = F.col("n_name"), F.col("label")
    tiers = [J.Tier([written], [name]), J.Tier([written], [F.lower(name)]), J.Tier([F.split(written, " ")], [name])]
    return J.tiered_match(asked, nations, "qid", "n_nationkey", tiers)


@query("""
WITH a AS (SELECT o_orderkey AS a_id, o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 2 = 0), b AS (SELECT o_orderkey AS b_id, o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 2 = 1)
SELECT a_id, b_id FROM a JOIN b ON a.o_custkey = b.o_custkey AND abs(date_diff('day', a.d, b.d)) <= 1
""")
def date_tolerant_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"))
    a = rows.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("a_id"), "o_custkey", F.col("d").alias("a_d"))
    b = rows.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("b_id"), "o_custkey", F.col("d").alias("b_d"))
    return J.date_tolerant(a, b, ["o_custkey"], "a_d", "b_d").select("a_id", "b_id")


_CARDS = """
c AS (SELECT c_custkey AS id, c_mktsegment || '-' || CAST(c_custkey % 40 AS VARCHAR) AS name, c_nationkey % 3 AS a, c_custkey % 2 AS b, c_nationkey % 2 AS c, c_custkey % 5 AS e, DATE '2000-01-01' + CAST(c_custkey % 4 AS INTEGER) AS born FROM customer)
"""


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("id"), F.concat_ws("-", "c_mktsegment", (key % 40).cast("string")).alias("name"), (nation % 3).alias("a"), (key % 2).alias("b"), (nation % 2).alias("c"), (key % 5).alias("e"),
        F.date_add(F.to_date(F.lit("2000-01-01")), (key % 4).cast("int")).alias("born"),
    )


@query(f"""
WITH RECURSIVE {_CARDS.strip()}, e AS (
  SELECT x.id AS a, y.id AS b FROM c AS x JOIN c AS y ON x.name = y.name AND x.id <> y.id
    AND CAST(x.a = y.a AS INTEGER) + CAST(x.b = y.b AS INTEGER) + CAST(x.c = y.c AS INTEGER) + CAST(x.e = y.e AS INTEGER) + CAST(abs(date_diff('day', x.born, y.born)) <= 1 AS INTEGER) >= 4
), r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a), m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT c.id, least(c.id, coalesce(m.b, c.id)) AS same_as FROM c LEFT JOIN m ON c.id = m.a
""")
def record_linkage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of records of one name that agree in four of five attributes, directly or over others."""
    return L.clusters(_cards(spark, sf_dir), "id", "name", ["a", "b", "c", "e"], ["born"])


@query("""
WITH s AS (SELECT l_orderkey AS k, l_suppkey AS cand, max(l_quantity) AS score FROM lineitem GROUP BY ALL), m AS (SELECT k, max(score) AS score FROM s GROUP BY k)
SELECT m.k, CASE WHEN count(*) = 1 THEN min(cand) END AS cand, m.score FROM m JOIN s ON m.k = s.k AND m.score = s.score GROUP BY m.k, m.score
""")
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("cand")).agg(F.max("l_quantity").alias("score"))
    return J.best_candidates(scored, "k", "cand", "score")


@query("""
SELECT CASE WHEN o_custkey % 4 = 1 THEN o_custkey - 1 ELSE o_custkey END AS o_custkey, count(*) AS n FROM orders GROUP BY 1
""")
def rekey_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers 4n+1 are duplicates of 4n: their orders move to the older key."""
    mapping = table(spark, sf_dir, "customer").where("c_custkey % 4 = 1").select(F.col("c_custkey").alias("old"), (F.col("c_custkey") - 1).alias("new"))
    return J.rekeyed(table(spark, sf_dir, "orders"), mapping, "o_custkey").groupBy("o_custkey").agg(F.count("*").alias("n"))


@query("""
WITH y AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS season FROM lineitem), w AS (SELECT s_suppkey, season, CAST(unnest(range(1, 13)) AS INTEGER) AS month FROM supplier, y),
m AS (SELECT DISTINCT l_suppkey, year(l_shipdate) AS season, month(l_shipdate) AS month FROM lineitem)
SELECT w.s_suppkey, w.season, w.month, CAST(m.month IS NOT NULL AS INTEGER) AS played FROM w LEFT JOIN m ON w.s_suppkey = m.l_suppkey AND w.season = m.season AND w.month = m.month
""")
def entity_by_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entity in every period of every season, and whether it took part."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("season"), F.month("l_shipdate").alias("month"))
    seasons = lines.agg(F.collect_set("season")).scalar()  # a few years
    grid = table(spark, sf_dir, "supplier").select("s_suppkey", seasons.alias("seasons")).select("s_suppkey", F.explode("seasons").alias("season"))
    grid = grid.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    seen = lines.distinct().withColumn("_hit", F.lit(1))
    return grid.join(seen, ["s_suppkey", "season", "month"], "left").select("s_suppkey", "season", "month", F.coalesce("_hit", F.lit(0)).alias("played"))
