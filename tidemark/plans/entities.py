"""Queries on records that are the same, replaced keys, what is left over, and names found in text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import linkage as L
from tidemark.plans.registry import query
from tidemark.plans.totals import table


@query("""
WITH r AS (SELECT c_custkey AS id, c_nationkey % 5 AS name, c_custkey // 7 % 9 AS born, CASE WHEN c_custkey % 5 = 0 THEN 'UNDRAFTED FREE AGENT' ELSE c_mktsegment END AS draft_tm FROM customer)
SELECT a.id AS old, min(b.id) AS new FROM r AS a JOIN r AS b ON a.name = b.name AND a.born = b.born AND a.draft_tm <> b.draft_tm WHERE a.draft_tm = 'UNDRAFTED FREE AGENT' GROUP BY a.id
""")
def duplicate_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a draft team, and the row of the same name and birthday that has one."""
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        key.alias("id"), (F.col("c_nationkey") % 5).alias("name"), (F.floor(key / 7) % 9).alias("born"), F.when(key % 5 == 0, "UNDRAFTED FREE AGENT").otherwise(F.col("c_mktsegment")).alias("draft_tm")
    )
    return L.duplicates(rows, "id", ["name", "born"], "draft_tm", "UNDRAFTED FREE AGENT")


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer is a duplicate of the one before, but for every sixth: chains of five steps."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(key % 6 > 0).select(key.alias("old"), (key - 1).alias("new"))


@query("SELECT c_custkey AS old, c_custkey - c_custkey % 6 AS new FROM customer WHERE c_custkey % 6 > 0")
def rekey_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of replaced keys followed to their ends."""
    return L.closure(_chains(spark, sf_dir))


@query("""
WITH o AS (SELECT o_custkey AS k, o_custkey - o_custkey % 6 AS image, CAST(o_orderdate AS DATE) AS d FROM orders), c AS (SELECT c_custkey AS k, c_custkey - c_custkey % 6 AS image, c_mktsegment AS s FROM customer)
SELECT 'orders' AS "table", CAST(image AS VARCHAR) || '|' || CAST(d AS VARCHAR) AS key, count(*) AS n_rows, count(DISTINCT k) AS n_old FROM o GROUP BY image, d HAVING count(*) > 1
UNION ALL SELECT 'customer', CAST(image AS VARCHAR) || '|' || s, count(*), count(DISTINCT k) FROM c GROUP BY image, s HAVING count(*) > 1
""")
def rekey_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that would no longer be unique if the chains were applied: orders of a customer and day, customers of a segment."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("d"))
    tables = {"orders": (orders, "o_custkey", ["o_custkey", "d"]), "customer": (table(spark, sf_dir, "customer"), "c_custkey", ["c_custkey", "c_mktsegment"])}
    return L.conflicts(tables, L.closure(_chains(spark, sf_dir)))


_MONTHS = """
s AS (SELECT o_custkey AS id, o_custkey % 50 AS name, o_custkey % 3 AS team, list(DISTINCT month(o_orderdate)) AS months FROM orders GROUP BY o_custkey),
m AS (SELECT *, CAST(list_sum(list_transform(months, lambda x: 1 << x)) AS BIGINT) AS mask FROM s)
"""


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.collect_set(F.month("o_orderdate")).alias("months"))
    return L.set_classes(rows.withColumn("name", F.col("id") % 50).withColumn("team", F.col("id") % 3), "id", "name", "team", "months")


@query("""
WITH s AS (
  SELECT o_custkey AS id, o_custkey % 50 AS name, o_custkey % 3 AS team, list(DISTINCT month(o_orderdate)) AS months FROM orders GROUP BY o_custkey
)
SELECT a.id, b.id AS other_id FROM s AS a JOIN s AS b ON a.name = b.name AND a.id < b.id AND a.team <> b.team AND NOT list_has_any(a.months, b.months)
""")
def disjoint_sets_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of customers of one name and different teams without a common month."""
    return L.disjoint_pairs(_months(spark, sf_dir), "id", "name", "team")


@query(f"""
WITH {_MONTHS}
SELECT a.name, a.team, a.mask, count(DISTINCT a.id) AS n, b.team AS other_team, b.mask AS other_mask, count(DISTINCT b.id) AS other_n
FROM m AS a JOIN m AS b ON a.name = b.name AND a.team < b.team AND NOT list_has_any(a.months, b.months) GROUP BY a.name, a.team, a.mask, b.team, b.mask
""")
def disjoint_set_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as pairs of classes with their numbers of customers; ``disjoint_set_members`` has who is in them."""
    found = L.disjoint_classes(_months(spark, sf_dir), "name", "team")
    return found.select("name", "team", "mask", "n", F.col("other_group").alias("other_team"), "other_mask", "other_n")


@query(f"WITH {_MONTHS} SELECT id, name, team, mask FROM m")
def disjoint_set_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _months(spark, sf_dir)


@query("""
WITH a AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL), b AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL)
SELECT a.k AS l_partkey, a.n AS n_left, coalesce(b.n, 0) AS n_right, a.n - coalesce(b.n, 0) AS n FROM a LEFT JOIN b ON a.k = b.k WHERE a.n > coalesce(b.n, 0)
""")
def left_over_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned items of a part beyond as many as were accepted, and how many there were of each."""
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    left, right = rows.where("l_returnflag = 'R'"), rows.where("l_returnflag = 'A'")
    found = L.left_over(left, right, ["l_partkey"], ["l_orderkey", "l_linenumber", "l_suppkey"])
    return found.groupBy("l_partkey", "n_left", "n_right").agg(F.count("*").alias("n"))


_ROSTER = """CASE s_suppkey % 4 WHEN 3 THEN {pick}(array('Al', 'Bo', 'Cy', 'Di', 'Ed'), CAST(s_suppkey % 5 + 1 AS INT)) || ' Q ' ELSE {pick}(array('Al', 'Bo', 'Cy', 'Di', 'Ed'), CAST(s_suppkey % 5 + 1 AS INT)) || ' ' END
|| {pick}(array('Smith', 'O''Neal', 'Ek', 'Jones-Lee', 'Nguyen', 'Rue', 'Watts'), CAST(s_suppkey % 7 + 1 AS INT)) || CASE WHEN s_suppkey % 11 < 8 THEN chr(CAST(97 + s_suppkey % 26 AS INT)) ELSE '' END"""
_TEXT = """{pick}(array('Al', 'Bo', 'Cy', 'Di', 'Ed', 'Yo', 'Al Q'), CAST(o_custkey % 7 + 1 AS INT)) || ' ' || {pick}(array('Smith', 'O''Neal', 'Ek', 'Jones-Lee', 'Nguyen', 'Rue', 'Watts'), CAST(o_orderkey % 7 + 1 AS INT))
|| CASE WHEN o_orderkey % 5 < 3 THEN chr(CAST(97 + o_custkey % 26 AS INT)) ELSE '' END || {pick}(array(' runs 9 yards.', ', pass to Watts (Nguyen)', ' to BO RUEC; flag', ''), CAST((o_custkey + o_orderkey) % 4 + 1 AS INT))"""


def _sql(text: str) -> str:
    return text.replace("{pick}", "list_extract").replace("array(", "list_value(")


@query(f"""
WITH r AS (SELECT s_nationkey AS team, string_split(lower({_sql(_ROSTER)}), ' ') AS w FROM supplier),
g AS (SELECT team, array_to_string(w, ' ') AS gram, 0 AS tier FROM r UNION ALL SELECT team, w[1] || ' ' || w[-1], 1 FROM r WHERE len(w) > 1 UNION ALL SELECT team, w[-1], 2 FROM r WHERE length(w[-1]) > 3),
i AS (SELECT gram, tier, min(team) AS low, max(team) AS high, count(DISTINCT team) AS n FROM g GROUP BY ALL),
p AS (SELECT o_orderkey, trim(regexp_replace(lower({_sql(_TEXT)}), '[^a-z''-]+', ' ', 'g')) AS text FROM orders),
t AS (SELECT DISTINCT text, string_split(text, ' ') AS w FROM p),
n AS (SELECT text, a.a AS place, k.k, array_to_string(w[a.a:a.a + k.k - 1], ' ') AS gram FROM t, range(1, 20) AS a(a), range(1, 5) AS k(k) WHERE a.a + k.k - 1 <= len(w)),
b AS (SELECT text, n.gram, tier, low, high, n.n AS n_groups FROM (SELECT n.*, i.tier, i.low, i.high, i.n FROM n JOIN i ON n.gram = i.gram) AS n QUALIFY row_number() OVER (PARTITION BY text ORDER BY tier, place, -k) = 1)
SELECT p.o_orderkey, CASE WHEN low = high THEN low END AS team, tier, gram, n_groups FROM p LEFT JOIN b ON p.text = b.text
""")
def play_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The team whose player a play names: by whole name, by first and last, by a last name of more than three letters; ties are reported."""
    roster = table(spark, sf_dir, "supplier").select("s_nationkey", F.expr(_ROSTER.replace("{pick}", "element_at")).alias("name"))
    plays = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_TEXT.replace("{pick}", "element_at")).alias("text"))
    found = L.attributed(plays, "o_orderkey", "text", L.name_index(roster, "name", "s_nationkey"))
    return found.withColumnRenamed("group", "team")
