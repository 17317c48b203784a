"""Queries on sources: the catalog, weeks of a season, files with two header rows, the latest files, and lookups into what was read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.functions import teams as N
from tidemark.functions.teams import TEAMS
from tidemark.operators import joins as J
from tidemark.plans.registry import query
from tidemark.plans.totals import table
from tidemark.sources import config, html, salvage, scan, sinks
from tidemark.streaming.incremental import shared_dir


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("""
SELECT 'games' AS name, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders UNION ALL SELECT 'players', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer
UNION ALL SELECT 'teams', count(*), CAST(sum(n_nationkey) AS BIGINT) FROM nation
""")
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of the three layouts, by season and week, by season, and flat, found by name in a catalog and checked before they are used."""
    root, t = _folder(spark, "catalog"), lambda n: table(spark, sf_dir, n)
    season = F.year("o_orderdate").alias("season")
    sinks.write_partitions(t("orders").select(F.col("o_orderkey").alias("key"), season, F.month("o_orderdate").alias("week")), f"{root}/games", ["season", "week"])
    sinks.write_partitions(t("customer").select(F.col("c_custkey").alias("key"), (F.col("c_custkey") % 3 + 2000).alias("season")), f"{root}/players", ["season"])
    t("nation").select(F.col("n_nationkey").cast("long").alias("key")).write.parquet(f"{root}/flat/teams")
    catalog = scan.Catalog(spark, root, {"games": "games", "players": "players", "teams": "flat/teams"})
    found = catalog.validated({"games": ["key", "season_id", "week_id"], "players": ["key", "season_id"], "teams": ["key"]})
    counts = [df.agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.sum("key").alias("keys")) for name, df in found.items()]
    return counts[0].union(counts[1]).union(counts[2])


@query("""
SELECT year(o_orderdate) AS season, month(o_orderdate) AS week, CAST(CASE WHEN month(o_orderdate) < 12 THEN month(o_orderdate) + 100 ELSE 12 END AS INTEGER) AS week_num, count(*) AS n FROM orders GROUP BY ALL
""")
def weeks_of_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games with the number of their week from a dimension, and from the partition where the dimension lacks the week."""
    path = _folder(spark, "weeks")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week"))
    sinks.write_partitions(rows, path, ["season", "week"])
    games = scan.scan_partitioned(spark, path, weeks="1-12")
    weeks = spark.range(1, 12).select(F.col("id").cast("int").alias("week_id"), (F.col("id") + 100).cast("string").alias("week_num"), F.lit(1).alias("season_id"))
    numbered = scan.with_week_numbers(games, weeks)
    return numbered.groupBy(F.col("season").cast("long").alias("season"), F.col("week").cast("long").alias("week"), "week_num").agg(F.count("*").alias("n"))


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS "Player", CAST(s_nationkey AS VARCHAR) AS "Passing_Yds", CAST(s_suppkey % 7 AS VARCHAR) AS "Rushing_Yds", CAST(s_suppkey % 5 AS VARCHAR) AS "Rushing_Yds_2" FROM supplier
""")
def two_header_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file with two header rows, which come again every fifty lines."""
    key = F.col("s_suppkey")
    line = F.concat_ws(",", key, "s_nationkey", key % 7, key % 5)
    again = F.when(key % 50 == 0, F.concat(F.lit("Unnamed: 0,Passing,Rushing,\nPlayer,Yds,Yds,Yds\n"), line)).otherwise(line)
    folder = _folder(spark, "headers")
    head = spark.createDataFrame([(-1, "Unnamed: 0,Passing,Rushing,Rushing\nPlayer,Yds,Yds,Yds")], "k long, value string")
    lines = head.union(table(spark, sf_dir, "supplier").select(key.alias("k"), again.alias("value")))
    lines.coalesce(1).sortWithinPartitions("k").select("value").write.text(folder)  # one small file, as its format has it
    return scan.scan_two_header_csv(spark, scan.latest_file(spark, folder, "part-*"))


@query("""
SELECT n_nationkey AS k, 'fastr' AS token, 'new' AS version FROM nation UNION ALL SELECT n_nationkey, 'ngs', 'new' FROM nation
""")
def latest_of_each_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest file for each of two tokens in the name, older ones beside them."""
    folder, nations = _folder(spark, "latest"), table(spark, sf_dir, "nation")
    for version in ("old", "new"):  # written one after the other
        for token in ("fastr", "ngs"):
            rows = nations.select(F.col("n_nationkey").alias("k"), F.lit(token).alias("token"), F.lit(version).alias("version"))
            rows.coalesce(1).write.option("header", "true").csv(f"{folder}/{token}/{version}")
    latest = [scan.latest_file(spark, f"{folder}/{token}", "part-*.csv") for token in ("fastr", "ngs")]
    return scan.scan_csv(spark, latest, "k int, token string, version string")


@query("""
SELECT c_custkey, md5(c_name || '_' || CAST(DATE '1990-01-01' + CAST(c_custkey % 900 AS INTEGER) AS VARCHAR) || '_' || CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment ELSE '' END) AS plyr_guid,
       CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS weight FROM customer
""")
def players_by_guid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players with what the master table has under their natural key."""
    key = F.col("c_custkey")
    born = F.date_add(F.to_date(F.lit("1990-01-01")), (key % 900).cast("int")).cast("string")
    guid = S.guid(F.col("c_name"), born, F.when(key % 4 > 0, F.col("c_mktsegment")))
    players = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", guid.alias("plyr_guid"))
    master = players.where("c_custkey % 3 > 0").select("plyr_guid", F.col("c_acctbal").alias("weight"))
    return J.lookup(players.drop("c_acctbal"), master, {"plyr_guid": "plyr_guid"}).select("c_custkey", "plyr_guid", "weight")


@query("""
SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 5 > 0 THEN s_suppkey % 7 END AS INTEGER) AS drops, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal END AS rate FROM supplier
""")
def advanced_by_player_and_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A basic row with what the advanced file has for its player and team; numbers that are none are null."""
    key = F.col("s_suppkey")
    basic = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("player"), F.col("s_nationkey").alias("tm"), F.when(key % 3 == 0, F.lit(float("nan"))).otherwise(F.col("s_acctbal")).alias("rate"))
    lines = table(spark, sf_dir, "supplier").where("s_suppkey % 5 > 0").select(F.col("s_name").alias("player"), F.explode(F.array("s_nationkey", F.col("s_nationkey") + 100)).alias("tm"), (key % 7).cast("int").alias("drops"))
    advanced = J.unique(lines.union(lines), ["player", "tm"], [F.col("drops")])
    found = S.nan_to_null(J.join_source(basic, J.FeatureSource(advanced, {"player": "player", "tm": "tm"}, ["drops"])))
    return found.select("s_suppkey", "drops", "rate")


@query("""
WITH r AS (SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'D.J. P' || c_custkey WHEN 1 THEN 'Al P' || c_custkey || ' Jr.' ELSE 'Bo P' || c_custkey END AS name, c_nationkey AS team, ['QB', 'WR'][CAST(c_custkey % 2 + 1 AS INTEGER)] AS pos FROM customer)
SELECT id AS snap, CASE WHEN id % 10 < 8 THEN id END AS roster, CAST(CASE WHEN id % 10 < 6 THEN 0 WHEN id % 10 < 8 THEN 1 END AS INTEGER) AS tier FROM r
""")
def snaps_to_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snap counts matched to a roster in two passes: by team, spelling and position, then by team and spelling alone; others stay unmatched."""
    key = F.col("c_custkey")
    text = key.cast("string")
    name = F.when(key % 3 == 0, F.concat(F.lit("D.J. P"), text)).when(key % 3 == 1, F.concat(F.lit("Al P"), text, F.lit(" Jr."))).otherwise(F.concat(F.lit("Bo P"), text))
    plain = F.when(key % 3 == 0, F.concat(F.lit("dj p"), text)).when(key % 3 == 1, F.concat(F.lit("al p"), text)).otherwise(F.concat(F.lit("bo p"), text))
    pos = F.when(key % 2 == 0, "QB").otherwise("WR")
    customers = table(spark, sf_dir, "customer")
    roster = customers.select(key.alias("roster"), name.alias("r_name"), F.col("c_nationkey").alias("r_team"), pos.alias("r_pos"))
    team = F.when(key % 10 < 8, F.col("c_nationkey")).otherwise(F.col("c_nationkey") + 50)
    snaps = customers.select(key.alias("snap"), plain.alias("s_name"), team.alias("s_team"), F.when(key % 10 < 6, pos).otherwise("TE").alias("s_pos"))
    spelling, of = F.array(F.col("s_name")), S.name_variants(F.col("r_name"))
    tiers = [J.Tier([F.col("s_team"), spelling, F.col("s_pos")], [F.col("r_team"), of, F.col("r_pos")]), J.Tier([F.col("s_team"), spelling], [F.col("r_team"), of])]
    return J.tiered_match(snaps, roster, "snap", "roster", tiers)


_NAMES = ", ".join(f"('{name}', '{code}')" for name, code in TEAMS.items())


@query(f"""
WITH t AS (SELECT name, code, CAST(row_number() OVER (ORDER BY name) AS BIGINT) - 1 AS i FROM (VALUES {_NAMES}) AS v(name, code)), o AS (SELECT o_orderkey, o_orderkey % 32 AS a, (o_orderkey * 7 + o_custkey) % 32 AS b FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 9 > 0 THEN a.name END AS first, CASE WHEN o_orderkey % 9 > 0 THEN b.code END AS second_code, CASE WHEN o_orderkey % 9 > 0 THEN split_part(b.name, ' ', -1) END AS second_nickname
FROM o JOIN t AS a ON o.a = a.i JOIN t AS b ON o.b = b.i
""")
def teams_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two teams in a file's name, of two words or three, as names, codes and nicknames; names of files without a week have none."""
    names = F.array(*[F.lit(n.replace(" ", "_")) for n in sorted(TEAMS)])
    key = F.col("o_orderkey")
    a, b = (F.get(names, (k % 32).cast("int")) for k in (key, key * 7 + F.col("o_custkey")))
    week = F.when(key % 9 > 0, F.concat(F.lit("_wk"), (key % 18).cast("string"))).otherwise("")
    prefix = F.when(key % 2 == 0, F.lit("/data_wk1/2024/cleaned_")).otherwise(F.lit(""))
    found = table(spark, sf_dir, "orders").select("o_orderkey", N.teams_in_path(F.concat(prefix, a, F.lit("_"), b, week, F.lit("_2024.csv"))).alias("_t"))
    nick = F.element_at(F.split(F.col("_t.second"), " "), -1)
    return found.select("o_orderkey", N.name_of_nickname(F.element_at(F.split(F.col("_t.first"), " "), -1)).alias("first"), N.team_code(F.col("_t.second")).alias("second_code"), nick.alias("second_nickname"))


@query("""
SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'OL' WHEN 1 THEN 'DB' WHEN 2 THEN 'LB' WHEN 3 THEN 'DL' WHEN 4 THEN 'K' WHEN 5 THEN 'TE' WHEN 6 THEN 'EDGE' END AS pos FROM part
""")
def position_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions in the spellings of several lists, as groups; an unknown one stays, null stays null."""
    spelling = F.array(*map(F.lit, ("LG/RT", "SS/FS", "RILB/LILB", "LDE/RDE", "PK", "TE/QB", "EDGE")))
    return table(spark, sf_dir, "part").select("p_partkey", N.position_group(F.get(spelling, (F.col("p_partkey") % 8).cast("int"))).alias("pos"))


_CONFIG = """
root: ${ROOT}
tables: {games: games.parquet, players: players.parquet, teams: nation.parquet, unused: none.parquet}
spine: games
columns: [game, player, season, week_id]
seasons: 1993-1996
exclude: [t_n_regionkey]
sources:
  - {table: players, keys: {player: c_custkey}, features: [c_nationkey, c_mktsegment]}
  - {table: teams, keys: {c_nationkey: n_nationkey}, features: [n_name, n_regionkey], prefix: t_}
  - {table: unused, keys: {x: y}, features: [], enabled: false}
"""


@query("""
SELECT o_orderkey AS game, o_custkey AS player, year(o_orderdate) AS season, CAST(month(o_orderdate) AS INTEGER) AS week_id, c_nationkey, c_mktsegment, n_name AS t_n_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey WHERE year(o_orderdate) BETWEEN 1993 AND 1996
""")
def configured_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset built from its configuration alone: tables by name, seasons, and sources of which one is off."""
    root, t = _folder(spark, "configured"), lambda n: table(spark, sf_dir, n)
    games = t("orders").select(F.col("o_orderkey").alias("game"), F.col("o_custkey").alias("player"), F.year("o_orderdate").cast("long").alias("season"), F.month("o_orderdate").alias("week_id"))
    games.write.parquet(f"{root}/games.parquet")
    t("customer").select("c_custkey", "c_nationkey", "c_mktsegment").write.parquet(f"{root}/players.parquet")
    t("nation").write.parquet(f"{root}/nation.parquet")
    return config.build(spark, config.Dataset.of(config.parse(_CONFIG, {"ROOT": root})))


@query("""
SELECT table_name AS "table", CAST(ordinal_position - 1 AS INTEGER) AS place, column_name AS "column", CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' ELSE 'string' END AS type
FROM information_schema.columns WHERE table_name IN ('customer', 'nation', 'part', 'region', 'supplier')
""")
def described_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of a catalog with their columns and types."""
    names = ("customer", "nation", "part", "region", "supplier")
    return config.described(scan.Catalog(spark, sf_dir, {n: f"{n}.parquet" for n in names}))


@query("""
WITH p AS (SELECT page_id AS game, CAST(page_id % 18 + 1 AS INTEGER) AS week, CAST(2020 + page_id % 5 AS INTEGER) AS year FROM pages)
SELECT game, week, year, 'snaps' AS kind, x - 1 AS "row", c AS at, CASE c WHEN 0 THEN NULL ELSE 'Off.' END AS "group", ['Player', 'Num', 'Pct'][c + 1] AS name, CASE c WHEN 0 THEN 'P' || x WHEN 1 THEN CAST(x * 10 AS VARCHAR) ELSE CAST(game % 100 AS VARCHAR) || '%' END AS value
FROM p, (SELECT CAST(unnest(range(1, 4)) AS INTEGER) AS x) AS r, (SELECT CAST(unnest(range(0, 3)) AS INTEGER) AS c) AS s
UNION ALL SELECT game, week, year, 'drives', x - 1, c, NULL, ['#', 'Result'][c + 1], CASE c WHEN 0 THEN CAST(x AS VARCHAR) ELSE 'Punt' END FROM p, (SELECT CAST(unnest(range(1, 3)) AS INTEGER) AS x) AS r, (SELECT CAST(unnest(range(0, 2)) AS INTEGER) AS c) AS s
""")
def game_page_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snap counts and drives of every game's page, with its week, year and game."""
    key = F.col("page_id")
    snaps = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda x: F.concat(F.lit("<tr><th>P"), x, F.lit("</th><td>"), x * 10, F.lit("</td><td>"), key % 100, F.lit("%</td></tr>")))
    drives = F.transform(F.sequence(F.lit(1), F.lit(2)), lambda x: F.concat(F.lit("<tr><td>"), x, F.lit("</td><td>Punt</td></tr>")))
    page = F.concat(
        F.lit("<div><table id='home_snap_counts'><tr><th rowspan=2>Player</th><th colspan=2>Off.</th></tr><tr><th>Num</th><th>Pct</th></tr>"), F.array_join(snaps, ""),
        F.lit("</table><p>x</p><table id='home_drives'><tr><th>#</th><th>Result</th></tr>"), F.array_join(drives, ""), F.lit("</table></div>"), F.coalesce("html", F.lit("")),
    )
    pages = table(spark, sf_dir, "pages").select(key.alias("game"), (key % 18 + 1).cast("int").alias("week"), (key % 5 + 2020).cast("int").alias("year"), page.alias("html"))
    return html.page_tables(pages, "html", {"snaps": "home_snap_counts", "drives": "home_drives"}, ["game", "week", "year"])


@query("""
SELECT page_id AS game_id, '2024-01-0' || (page_id % 9 + 1) || 'T' || lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS time, CASE WHEN h % 5 > 0 THEN (page_id % 40 - h) / 2.0::DOUBLE END AS temperature_2m, CASE WHEN h < 20 THEN h * 1.5::DOUBLE END AS rain
FROM pages, range(0, 24) AS r(h) WHERE page_id % 7 > 0
""")
def weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly series of a service's answers as rows; one series is shorter, some values and some answers are missing."""
    key, hours = F.col("page_id"), F.sequence(F.lit(0), F.lit(23))
    time = F.transform(hours, lambda h: F.concat(F.lit("2024-01-0"), key % 9 + 1, F.lit("T"), F.lpad(h.cast("string"), 2, "0"), F.lit(":00")))
    warm = F.transform(hours, lambda h: F.when(h % 5 > 0, (key % 40 - h) / 2))
    rain = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda h: h * 1.5)
    answer = F.to_json(F.struct(F.lit(40.7).alias("latitude"), F.struct(time.alias("time"), warm.alias("temperature_2m"), rain.alias("rain")).alias("hourly")))
    answers = table(spark, sf_dir, "pages").select(key.alias("game_id"), F.when(key % 7 == 0, F.lit('{"error": true}')).otherwise(answer).alias("answer"))
    return scan.column_arrays(answers, "answer", "$.hourly", {"time": "string", "temperature_2m": "double", "rain": "double"})


@query("SELECT count(*) AS n_rows, 1 AS n_groups_lost, 1 AS n_files_lost, true AS some_lost FROM orders")
def salvaged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose first file has one damaged row group: the rows that are read and those counted as lost add up; a file that is none is reported."""
    folder = _folder(spark, "damaged")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    rows.repartition(3, "o_orderkey").write.option("parquet.block.size", "16384").option("parquet.page.row.count.limit", "500").option("parquet.enable.dictionary", "false").parquet(folder)
    files = salvage.binary_files(spark, folder)
    first = files.agg(F.min("path")).scalar()
    broken = F.concat(F.substring("content", 1, 200), F.unhex(F.lit("FFFFFFFF")), F.expr("substring(content, 205)"))  # within the first row group
    files = files.withColumn("_first", first).select("path", F.when(F.col("path") == F.col("_first"), broken).otherwise(F.col("content")).alias("content"))
    none = spark.range(1).select(F.lit("none").alias("path"), F.lit("no file").cast("binary").alias("content"))
    good, lost = salvage.salvage(files.union(none), "o_orderkey long, o_totalprice double")
    counts = lost.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("lost"), F.count("group").cast("int").alias("n_groups_lost"), F.count_if(F.col("group").isNull()).cast("int").alias("n_files_lost"))
    right = good.join(rows, ["o_orderkey", "o_totalprice"], "left_semi").agg(F.count("*")).scalar()  # what is read is as it was
    return counts.select((right + F.col("lost")).alias("n_rows"), "n_groups_lost", "n_files_lost", (F.col("lost") > 0).alias("some_lost"))
