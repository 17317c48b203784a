"""Queries on records as they are loaded: parsing, projections, filters, lookups, a loader from end to end, tables written and read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import filters as P
from tidemark.functions import scalar as S
from tidemark.operators import aggregates as A
from tidemark.operators import joins as J
from tidemark.operators import quality as Q
from tidemark.operators import windows as W
from tidemark.plans.registry import query
from tidemark.plans.series import _ORDER, _purchases
from tidemark.plans.totals import table
from tidemark.sources import scan, sinks
from tidemark.streaming.incremental import shared_dir


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# parsing


@query("""
SELECT p_partkey, 'TM' || CAST(p_size AS VARCHAR) AS team, CAST(1 + p_partkey % 7 AS INTEGER) AS round, CAST(p_size AS INTEGER) AS pick, CAST(2000 + p_partkey % 25 AS INTEGER) AS year,
       CAST(2000 + p_partkey % 25 AS INTEGER) AS file_year FROM part
""")
def draft_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draft entries in their long and their short form, and the year in a file's name."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    round_, year = (1 + key % 7).cast("string"), (2000 + key % 25).cast("string")
    long = F.concat(year, F.lit(": Rd "), round_, F.lit(", Pk "), size, F.lit(" (TM"), size, F.lit(")"))
    short = F.concat(F.lit("TM"), size, F.lit(" / "), round_, F.lit("th / "), size, F.lit("th pick / "), year)
    found = S.draft(F.when(key % 2 == 0, long).otherwise(short))
    file = S.year_in(F.concat(F.lit("/raw/x1/stats_"), year, F.lit("_week_3.csv")))
    return table(spark, sf_dir, "part").select("p_partkey", *[found[c].alias(c) for c in ("team", "round", "pick", "year")], file.alias("file_year"))


@query("""
SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 2 = 0 THEN -1 ELSE 1 END * (s_suppkey % 90) AS DOUBLE) + CASE WHEN s_suppkey % 2 = 0 THEN -0.25::DOUBLE ELSE 0.25::DOUBLE END AS degrees, ['N', 'S', 'E', 'W'][s_suppkey % 4 + 1] AS direction,
       'name ' || CAST(s_suppkey AS VARCHAR) AS stripped, '46.' || CAST(s_suppkey % 10 AS VARCHAR) AS line, CASE WHEN s_suppkey % 3 > 0 THEN 'over' END AS remark, CAST(length(CAST(s_suppkey AS VARCHAR)) AS INTEGER) AS places,
       coalesce(['one', 'two'][s_suppkey % 3 + 1], CAST(s_suppkey % 3 AS VARCHAR)) AS mapped, CASE WHEN s_suppkey % 5 = 0 THEN 'text' WHEN s_suppkey % 5 = 1 THEN 'integer' WHEN s_suppkey % 5 = 2 THEN 'decimal' WHEN s_suppkey % 5 = 3 THEN 'date' END AS kind
FROM supplier
""")
def marks_and_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates, playoff marks, remarks in brackets, decimal places, small maps and kinds of text."""
    key = F.col("s_suppkey")
    text, sign = key.cast("string"), F.when(key % 2 == 0, "-").otherwise("")
    place = S.coordinate(F.concat(sign, (key % 90).cast("string"), F.lit(".25° "), F.element_at(F.array(*map(F.lit, "nsEW")), (key % 4 + 1).cast("int"))))
    remark = S.with_remark(F.concat(F.lit("46."), (key % 10).cast("string"), F.when(key % 3 > 0, " (over)").otherwise("")))
    kind = F.element_at(F.array(*map(F.lit, ("x1", "-12", "3.50", "2024-01-02", " "))), (key % 5 + 1).cast("int"))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", place["value"].alias("degrees"), place["direction"].alias("direction"), S.strip_marks(F.concat(F.lit("name "), text, F.lit("*+ "))).alias("stripped"),
        remark["value"].alias("line"), remark["remark"].alias("remark"), S.decimal_places(F.concat(F.lit("-3."), F.repeat(F.lit("7"), F.length(text)), F.lit("000"))).alias("places"),
        S.mapped((key % 3).cast("string"), {"0": "one", "1": "two"}).alias("mapped"), S.kind_of_text(kind).alias("kind"),
    )


@query("""
SELECT o_orderkey, strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL (o_orderkey % 13 + 9) HOUR, '%Y-%m-%d %H:%M') AS eastern FROM orders
""")
def zone_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pacific wall clock times as Eastern ones; both change to summer time in the same night, at hours that are left out here."""
    day = F.date_trunc("day", F.col("o_orderdate")).cast("timestamp_ntz")
    local = day + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 13 + 6).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(S.to_zone(local, "America/Los_Angeles"), "yyyy-MM-dd HH:mm").alias("eastern"))


@query("""
SELECT n_nationkey, n_nationkey % 4 < 3 AS same FROM nation
""")
def college_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colleges that are the same by normal name, by containment or by an alias."""
    k, name = F.col("n_nationkey") % 4, F.lower("n_name")
    other = F.when(k == 0, F.concat(F.lit("University of "), name)).when(k == 1, F.concat(name, F.lit(" Tech."))).when(k == 2, F.lit("old school")).otherwise("elsewhere")
    first = F.when(k == 2, F.lit("New  School")).otherwise(F.concat(F.col("n_name"), F.lit(" Univ.")))
    return table(spark, sf_dir, "nation").select("n_nationkey", S.same_college(first, other, {"old school": "new school"}).alias("same"))


_SUBJECTS = ("Al Smith-Jones III", "C.Santos", "Bo Ja'Neal", "Éric Dumont Jr.", "J. J. Watt", "Timeout", "(Cy Young)", "la Rue", "Ann", "Ö.Ek")
_ACTIONS = (" pass complete  short right to ", " kicks 40 yards to ", " pass incomplete intended for ", " right end for ", " pass back to the line, for ", " passed to ")
_OBJECTS = ("Bo Ja'Neal", "A. B.Cole Sr.", "12 yards", "Zoë O’Hara Van Dyk, out of bounds", "pit", "C.Santos (tackle by Cy Young)", "P.", "Éric Dumont Jr.")


def _plays(text: str) -> str:
    """SQL of a play for each order, from its keys."""
    pick = lambda parts, k: f"element_at({text.format(', '.join(chr(39) + p.replace(chr(39), chr(39) * 2) + chr(39) for p in parts))}, CAST({k} % {len(parts)} + 1 AS INT))"
    return f"concat({pick(_SUBJECTS, 'o_orderkey')}, {pick(_ACTIONS, 'o_custkey')}, {pick(_OBJECTS, '(o_orderkey + o_custkey)')})"


@query(rf"""
WITH p AS (SELECT o_orderkey, replace(trim(regexp_replace(regexp_replace({_plays("[{}]").replace("element_at", "list_extract")}, '\([^)]*\)', ' ', 'g'), '\s+', ' ', 'g')), ',', ' ,') AS play FROM orders),
t AS (SELECT o_orderkey, string_split(regexp_replace(play, '(\p{{Lu}}\.)(\p{{Lu}})', '\1 \2', 'g'), ' ') AS words, string_split(play, ' ') AS raw FROM p),
k AS (
  SELECT o_orderkey, words, array_to_string(list_transform(words, lambda x: CASE WHEN regexp_full_match(x, '\p{{Lu}}\.') THEN 'i' WHEN regexp_full_match(x, '[JS]r\.') THEN 's'
    WHEN regexp_full_match(x, '\p{{Lu}}\p{{L}}*([''’-]\p{{L}}+)*') THEN 'w' WHEN x = 'pass' THEN 'p' WHEN x IN ('to', 'for') THEN 't' ELSE '.' END), '') AS shape FROM t
), r AS (
  SELECT o_orderkey, words, length(regexp_extract(shape, '^(i+w|ww)w*s?')) AS first,
         length(regexp_extract(shape, '^[^p]*p.*?t(i+w|ww)')) - length(regexp_extract(shape, '^[^p]*p.*?t(i+w|ww)', 1)) AS before, shape FROM k
), n AS (
  SELECT o_orderkey, words[1:first] AS a, words[before + 1:before + length(regexp_extract(substr(shape, CAST(before AS BIGINT) + 1), '^(i+w|ww)w*s?'))] AS b, before FROM r
), j AS (
  SELECT o_orderkey, array_to_string(a, ' ') AS a, CASE WHEN before > 0 THEN array_to_string(b, ' ') ELSE '' END AS b FROM n
)
SELECT o_orderkey, replace(array_to_string(list_filter(CASE WHEN a = b THEN [a] ELSE [a, b] END, lambda x: x <> ''), '|'), '. ', '.') AS names FROM j
""")
def play_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players named in a play: full names, initials, and the target of a pass; brackets do not count. Blanks after a point are left out."""
    names = F.array_join(S.players_in_play(F.expr(_plays("array({})"))), "|")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.replace(names, F.lit(". "), F.lit(".")).alias("names"))


@query("""
WITH w AS (SELECT p_partkey, list_distinct([p_size % 9, 3, 7]) AS a, list_distinct([p_size % 7, 7]) AS b FROM part)
SELECT p_partkey, array_to_string(list_sort(list_distinct(list_concat(a, b))), ',') AS "both", array_to_string(list_sort(list_intersect(a, b)), ',') AS common,
       array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ',') AS only_first FROM w
""")
def week_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union, intersection and difference of weeks given as text."""
    a = F.concat_ws(", ", (F.col("p_size") % 9).cast("string"), F.lit("7"), F.lit("3"))
    b = F.concat_ws(",", (F.col("p_size") % 7).cast("string"), F.lit("7"), F.lit("x"))
    found = S.week_algebra(a, b)
    return table(spark, sf_dir, "part").select("p_partkey", *[found[c].alias(c) for c in ("both", "common", "only_first")])


@query("""
WITH r AS (
  SELECT o_orderkey, o_orderkey % 18 + 1 AS week, CASE WHEN o_custkey % 4 > 0 THEN 'F' END AS former, CASE WHEN o_custkey % 4 = 3 THEN 'A' END AS first,
         CASE WHEN o_custkey % 5 > 0 THEN o_custkey % 9 END AS ff, CASE WHEN o_custkey % 7 > 0 THEN 9 + o_custkey % 6 END AS fl, CASE WHEN o_custkey % 3 > 0 THEN o_custkey % 8 END AS al FROM orders
)
SELECT o_orderkey, CASE WHEN former IS NULL THEN 'C' WHEN first IS NULL THEN CASE WHEN (coalesce(ff, 1) = 1 AND week <= coalesce(fl, 18)) OR (week >= coalesce(ff, 1) AND week <= coalesce(fl, 18)) THEN former ELSE 'C' END
  WHEN week <= coalesce(al, 6) THEN first WHEN week <= coalesce(fl, 12) THEN former ELSE 'C' END AS team FROM r
""")
def team_of_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who a player played for in a week, from current, former and first team and the weeks that are known."""
    c = F.col("o_custkey")
    spans = {
        "former_first": F.when(c % 5 > 0, c % 9), "former_last": F.when(c % 7 > 0, 9 + c % 6), "first_last": F.when(c % 3 > 0, c % 8), "played_first": F.lit(1),
    }
    former, first = F.when(c % 4 > 0, "F").otherwise(" "), F.when(c % 4 == 3, "A")
    return table(spark, sf_dir, "orders").select("o_orderkey", S.team_of_week(F.col("o_orderkey") % 18 + 1, F.lit("C"), former, first, spans).alias("team"))


# projections and filters


@query("""
SELECT c_nationkey AS tm_nationkey, c_custkey AS tm_custkey, c_mktsegment AS tm_mktsegment, CAST(NULL AS DOUBLE) AS tm_epa, c_acctbal AS tm_acctbal FROM customer
""")
def projected_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by name where they are there, renamed by prefix, some left out, one made of nulls, and in an order."""
    rows = P.without(P.project(table(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_absent", "c_nationkey", "c_mktsegment", "c_acctbal"]), ["c_name", "c_other"])
    return P.order_columns(P.ensure_columns(P.rename_prefix(rows, "c_", "tm_"), {"tm_epa": "double", "tm_custkey": "long"}), ["tm_nationkey"], ["tm_epa", "tm_acctbal"])


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'b' ELSE 'a' END AS home, CASE WHEN o_orderkey % 3 = 0 THEN 'a' ELSE 'b' END AS away, o_custkey % 7 IN (2, 3) AS wide, o_orderkey % 5 <> 4 AS defends
FROM orders WHERE o_orderkey % 21 BETWEEN 1 AND 18 AND o_custkey % 7 <> 0 AND o_custkey % 7 <> 6 AND o_custkey % 11 > 0 AND o_orderkey % 13 > 1
""")
def row_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated headers and totals, weeks outside the season, rows without required cells, positions, and home sides."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    position = F.when(c % 7 == 0, "Pos").when(c % 7 == 2, "WR").when(c % 7 == 6, "Total 3").otherwise("TE")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", position.alias("pos"), F.when(c % 7 == 3, "WR").alias("alt_pos"), (k % 21).alias("week"), F.when(c % 11 > 0, "x").otherwise(" ").alias("cell"), F.lit("a").alias("winner"), F.lit("b").alias("loser"),
        F.when(k % 3 == 0, " @").alias("mark"), F.when(k % 13 > 0, F.when(k % 13 == 1, " ").otherwise("70")).alias("height"), F.lit("").alias("weight"), F.when(k % 5 == 4, "QB").when(k % 5 > 0, "CB").alias("plays"),
    )
    rows = P.drop_header_rows(rows, "pos", "Pos", "^Total").where(P.week_in_season(F.col("week")))
    rows = P.informed(P.with_cells(rows, ["cell"]), ["pos"], ["height", "weight"])
    home, away = P.home_away(F.col("winner"), F.col("loser"), F.col("mark"))
    return rows.select("o_orderkey", home.alias("home"), away.alias("away"), P.either(["pos", "alt_pos"], "WR").alias("wide"), P.not_among(F.col("plays"), ["QB", "RB", "WR", "TE", "OL"]).alias("defends"))


@query("""
SELECT c_custkey, 'Thursday' AS game_day, 'M' || CAST(c_custkey AS VARCHAR) AS wed_practice_status, CASE WHEN c_custkey % 2 = 0 THEN 'No_Designation' END AS thurs_practice_status, CAST(NULL AS VARCHAR) AS fri_practice_status, CAST(NULL AS VARCHAR) AS sat_practice_status FROM customer
""")
def practice_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The game day is told by the weekdays that a report lists, and they become its practice columns."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("M"), F.col("c_custkey").cast("string")).alias("Mon"), F.when(F.col("c_custkey") % 2 == 0, "(-)").otherwise(" ").alias("Tue"))
    return P.practice_columns(rows)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 40 OFFSET 10")
def page_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows 11 to 50 by price."""
    return P.page(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), "o_orderkey"], 40, 10)


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 50")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.hash_sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 50, 42)


# joins


@query("""
WITH m AS (SELECT o_custkey AS cust, year(o_orderdate) * 12 + month(o_orderdate) AS month, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS spend FROM orders GROUP BY ALL)
SELECT a.cust, CAST(a.month AS INTEGER) AS month, a.n, coalesce(b.n, 0) AS tm_n, b.spend AS tm_spend FROM m AS a LEFT JOIN m AS b ON a.cust = b.cust AND a.month = b.month + 1
""")
def shifted_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each month of a customer beside the figures of the month before: a source that is moved on by one period."""
    month = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("month")
    months = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("cust"), month).agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double").alias("spend"))
    source = J.FeatureSource(months, {"cust": "cust", "month": "month"}, ["n", "spend"], "tm_", 1, "month", {"n": 0})
    return J.join_source(months.select("cust", "month", "n"), source)


@query("""
WITH v AS (SELECT user_id, ts, event_id, lead(event_id, 1) OVER w AS e1, lead(event_id, 2) OVER w AS e2, lead(event_id, 3) OVER w AS e3 FROM events WHERE event_type = 'view' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT b.event_id, f.e AS view_id, f.e1 AS view_id_1, f.e2 AS view_id_2, f.e3 AS view_id_3 FROM events AS b
LEFT JOIN LATERAL (SELECT v.event_id AS e, e1, e2, e3 FROM v WHERE v.user_id = b.user_id ORDER BY abs(epoch_us(v.ts) - epoch_us(b.ts)), epoch_us(v.ts), v.event_id LIMIT 1) AS f ON true WHERE b.event_type = 'purchase'
""")
def nearest_and_following(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view nearest to each purchase and the three views after that one."""
    buys, views = _purchases(spark, sf_dir)
    found = J.with_following(buys, views.drop("view_value"), ["user_id"], "ts", "view_ts", ["view_id"])
    return found.select("event_id", "view_id", *[f"view_id_{n}" for n in (1, 2, 3)])


@query("""
SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS week_num, h.n_name AS home_name, a.n_name AS away_name FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation AS h ON c_nationkey = h.n_nationkey JOIN nation AS a ON (c_nationkey + 1) % 25 = a.n_nationkey WHERE year(o_orderdate) BETWEEN 1993 AND 1996
""")
def game_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games with seasons, weeks and one team table in two roles, over a range of seasons."""
    games = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("home")), "o_custkey")
    seeds = scan.season_weeks(spark, range(1993, 1997), 12)
    season, week = F.year("o_orderdate") - 1992, F.month("o_orderdate")
    games = games.select("o_orderkey", season.alias("season_id"), ((season - 1) * 12 + week).alias("week_id"), "home", ((F.col("home") + 1) % 25).alias("away"))
    games = scan.with_dimensions(games.where("season_id BETWEEN 1 AND 4"), seeds.select("season_id", "year").distinct(), seeds)
    names = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("name"))
    games = J.lookup(J.lookup(games, names, {"home": "n_nationkey"}, "home_"), names, {"away": "n_nationkey"}, "away_")
    return games.select("o_orderkey", F.col("year").cast("long").alias("year"), F.col("week_num").cast("long").alias("week_num"), "home_name", "away_name")


@query("""
WITH g AS (SELECT o_orderkey AS game, c_nationkey AS home, (c_nationkey + 3) % 25 AS away, o_custkey FROM orders JOIN customer ON o_custkey = c_custkey),
p AS (SELECT c_custkey AS plyr, (c_nationkey + 1) % 25 AS team FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P'))
SELECT plyr, team, count(*) AS games FROM p JOIN g ON team IN (home, away) GROUP BY ALL
""")
def active_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players who are in no report, with the games of their team on either side."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    games = orders.join(customers, F.expr("o_custkey = c_custkey")).select(F.col("o_orderkey").alias("game"), F.col("c_nationkey").alias("home"), ((F.col("c_nationkey") + 3) % 25).alias("away"))
    players = customers.select(F.col("c_custkey").alias("plyr"), ((F.col("c_nationkey") + 1) % 25).alias("team"))
    reported = orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("plyr"))
    per_team = J.both_sides(games, "game", "home", "away").groupBy("team").agg(F.count("*").alias("games"))
    return J.only_in(players, reported, ["plyr"]).join(per_team, "team").select("plyr", "team", "games")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 4 > 0 THEN c_mktsegment WHEN c_custkey % 3 = 0 THEN 'UNDRAFTED FREE AGENT' ELSE 'new' END AS draft_tm FROM customer
""")
def protected_draft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored draft team is kept where the incoming row has none."""
    rows = table(spark, sf_dir, "customer")
    stored = rows.where("c_custkey % 4 > 0").select("c_custkey", F.col("c_mktsegment").alias("draft_tm"))
    incoming = rows.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "UNDRAFTED FREE AGENT").otherwise("new").alias("draft_tm"))
    return J.protected(stored, incoming, ["c_custkey"], "draft_tm", "UNDRAFTED FREE AGENT")


@query("""
WITH s AS (SELECT l_suppkey AS k, l_linenumber % 2 AS side, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT s_suppkey, coalesce((SELECT CAST(sum(n) AS BIGINT) FROM s WHERE k = s_suppkey), 0) AS starts FROM supplier
""")
def starts_by_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts are listed under several spellings of a name; a player's are the sum over all of them."""
    key, line = F.col("l_suppkey").cast("string"), F.col("l_linenumber") % 2
    listed = table(spark, sf_dir, "lineitem").groupBy(F.when(line == 0, F.concat(F.lit("dj s"), key)).otherwise(F.concat(F.lit("d.j. s"), key)).alias("spelling")).agg(F.count("*").alias("n"))
    name = F.concat(F.lit("DJ S"), F.col("s_suppkey").cast("string"), F.lit(" Jr."))
    players = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(S.name_variants(name)).alias("spelling"))
    return players.join(listed, "spelling", "left").groupBy("s_suppkey").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("starts"))


@query("""
WITH f AS (SELECT n_nationkey AS tm, n_name FROM nation), c AS (SELECT c_nationkey AS tm, count(*) AS customers FROM customer GROUP BY ALL), s AS (SELECT s_nationkey AS tm, count(*) AS suppliers FROM supplier GROUP BY ALL),
o AS (SELECT c_nationkey AS tm, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL), y AS (SELECT s_nationkey % 20 AS tm, count(*) AS sacks FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
SELECT f.tm, n_name, customers, suppliers, orders, coalesce(sacks, 0) AS sacks FROM f JOIN c USING (tm) JOIN s USING (tm) JOIN o USING (tm) LEFT JOIN y USING (tm)
""")
def team_files_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several files of one team each, joined one after the other; missing sacks count as none."""
    t = lambda n: table(spark, sf_dir, n)
    files = [
        t("customer").groupBy(F.col("c_nationkey").alias("tm")).agg(F.count("*").alias("customers")), t("supplier").groupBy(F.col("s_nationkey").alias("tm")).agg(F.count("*").alias("suppliers")),
        t("orders").join(t("customer"), F.expr("o_custkey = c_custkey")).groupBy(F.col("c_nationkey").alias("tm")).agg(F.count("*").alias("orders")),
    ]
    out = t("nation").select(F.col("n_nationkey").alias("tm"), "n_name")
    for file in files:
        out = out.join(file, "tm")
    sacks = t("lineitem").join(t("supplier"), F.expr("l_suppkey = s_suppkey")).groupBy((F.col("s_nationkey") % 20).alias("tm")).agg(F.count("*").alias("sacks"))
    return J.join_source(out, J.FeatureSource(sacks, {"tm": "tm"}, ["sacks"], fill={"sacks": 0}))


# aggregates and reports


@query("""
WITH r AS (SELECT o_custkey AS plyr, o_orderkey % 3 AS team, ['WR', 'TE', 'RB'][o_orderkey % 3 + 1] AS pos, CAST(o_orderdate AS DATE) AS born, CAST(month(o_orderdate) AS INTEGER) AS week FROM orders),
p AS (SELECT plyr, pos, count(*) AS n, min(born) AS born FROM r GROUP BY ALL), t AS (SELECT plyr, team, min(week) AS a, max(week) AS b FROM r GROUP BY ALL)
SELECT plyr, CAST(sum(n) AS BIGINT) AS games, arg_min(pos, (-n, pos)) AS pos, array_to_string(list_sort(list_filter(list(pos), lambda x: x <> arg_min(pos, (-n, pos)))), ',') AS alt_positions, min(born) AS born,
       (SELECT string_agg(CAST(team AS VARCHAR) || ':' || CAST(a AS VARCHAR) || ':' || CAST(b AS VARCHAR), ',' ORDER BY a, b, team) FROM t WHERE t.plyr = p.plyr) AS groups FROM p GROUP BY plyr
""".replace("list_filter(list(pos), lambda x: x <> arg_min(pos, (-n, pos)))", "list(pos ORDER BY n DESC, pos)[2:]"))
def consolidated_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players of several teams as one row: games, positions, earliest birth date, and the weeks with each team."""
    k = F.col("o_orderkey") % 3
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("plyr"), k.alias("team"), F.element_at(F.array(*map(F.lit, ("WR", "TE", "RB"))), (k + 1).cast("int")).alias("pos"), F.col("o_orderdate").cast("date").alias("born"),
        F.month("o_orderdate").alias("week"), F.lit(1).cast("long").alias("games"),
    )
    return A.consolidated(rows, "plyr", "team", "games", "pos", "born", "week")


@query("""
WITH v AS (SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'x' WHEN o_orderkey % 4 < 3 THEN '12' END AS a, CASE WHEN o_orderkey % 2 = 0 THEN '1.5' ELSE '2024-02-03' END AS b FROM orders)
SELECT 'a' AS "column", CASE a WHEN 'x' THEN 'text' ELSE 'integer' END AS kind, count(*) AS n FROM v WHERE a IS NOT NULL GROUP BY ALL UNION ALL SELECT 'b', CASE b WHEN '1.5' THEN 'decimal' ELSE 'date' END, count(*) FROM v GROUP BY ALL
""")
def type_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values of a text column look like which type."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.when(k % 4 == 0, "x").when(k % 4 < 3, " 12 ").otherwise(" ").alias("a"), F.when(k % 2 == 0, "1.5").otherwise("2024-02-03").alias("b"))
    return A.text_kinds(rows, ["a", "b"])


@query("""
SELECT 'prior' AS kind, 0 AS n UNION ALL SELECT 'own', count(*) FROM (
  SELECT abs(avg(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) - avg(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)) < 1e-9::DOUBLE AS same,
         count(*) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE n = 0 OR NOT same
""")
def leakage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling means of the rows before have no leak; means that take in their own row are found out."""
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    fair = W.rolling_means(rows, ["user_id"], _ORDER, ["value"], [3])
    own = rows.withColumn("roll_3g_value", F.expr("avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"))
    count = lambda df, kind: Q.leaks(df, ["user_id"], _ORDER, "value", "roll_3g_value", 3).agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    return count(fair, "prior").union(count(own, "own"))


# loaders, scans and sinks


@query("""
WITH stored AS (SELECT s_suppkey AS plyr_id, CAST(s_suppkey AS DOUBLE) AS catch_pct, CAST(9 AS INTEGER) AS rec FROM supplier WHERE s_suppkey % 2 = 0),
file AS (SELECT s_suppkey AS plyr_id, CASE WHEN s_suppkey % 3 > 0 THEN CAST(s_suppkey % 100 AS DOUBLE) / 100 END AS catch_pct, CASE WHEN s_suppkey % 5 > 0 THEN CAST(s_suppkey % 40 AS INTEGER) END AS rec FROM supplier WHERE s_suppkey % 7 > 0)
SELECT coalesce(s.plyr_id, f.plyr_id) AS plyr_id, coalesce(f.catch_pct, s.catch_pct) AS catch_pct, coalesce(f.rec, s.rec) AS rec FROM stored AS s FULL JOIN file AS f ON s.plyr_id = f.plyr_id
""")
def loader_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load from end to end: names resolved by tiers, columns renamed and coerced, rows merged into what is stored.

    The file has a repeated header, names in three spellings, and rows whose player nobody knows.
    """
    key = F.col("s_suppkey")
    players = table(spark, sf_dir, "supplier").select(key.alias("plyr_id"), F.concat(F.lit("dj s"), key.cast("string")).alias("plyr_name"))
    name = F.when(key % 3 == 0, F.concat(F.lit("DJ S"), key.cast("string"))).when(key % 3 == 1, F.concat(F.lit("D.J. S"), key.cast("string"), F.lit(" Jr.*"))).otherwise(F.concat(F.lit("dj s"), key.cast("string")))
    file = table(spark, sf_dir, "supplier").select(
        key.alias("row"), F.when(key % 7 == 0, "Nobody Known").otherwise(name).alias("Player"), F.when(key % 3 > 0, F.concat((key % 100).cast("string"), F.lit("%"))).otherwise("").alias("Ctch%"),
        F.when(key % 5 > 0, F.concat((key % 40).cast("string"), F.lit(".0"))).otherwise("n/a").alias("Rec"),
    )
    file = file.union(file.select(-F.col("row"), F.lit("Player"), F.lit("Ctch%"), F.lit("Rec")))
    file = S.clean_columns(P.drop_header_rows(file, "Player", "Player"))
    tiers = [J.Tier([F.col("player")], [F.col("plyr_name")]), J.Tier([F.lower("player")], [F.col("plyr_name")]), J.Tier([S.name_variants(F.col("player"))], [F.col("plyr_name")])]
    found = J.tiered_match(file, players, "row", "plyr_id", tiers).where("plyr_id IS NOT NULL")
    rows = file.join(found, "row").select("plyr_id", S.percent_always(F.col("ctch")).alias("catch_pct"), S.whole(F.col("rec")).alias("rec"))
    stored = players.where("plyr_id % 2 = 0").select("plyr_id", F.col("plyr_id").cast("double").alias("catch_pct"), F.lit(9).alias("rec"))
    return sinks.merge(stored, rows, ["plyr_id"], keep_old=True)


@query("""
SELECT year(o_orderdate) AS season, month(o_orderdate) AS week, count(*) AS n, CAST(sum(CASE WHEN month(o_orderdate) = 2 THEN 1 ELSE 0 END) AS BIGINT) AS replaced FROM orders GROUP BY ALL
""")
def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by season and week is written, the partitions of one week are replaced, all copied by a period filter, and the copy is read back."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.lit(0).alias("replaced"), F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week"))
    raw, clean = _folder(spark, "raw"), _folder(spark, "clean")
    sinks.write_partitions(rows, raw, ["season", "week"])
    sinks.write_partitions(rows.where("week = 2").withColumn("replaced", F.lit(1)), raw, ["season", "week"])
    sinks.copy_periods(spark, raw, clean, "1990-2010", "1-12")
    found = scan.scan_partitioned(spark, clean, weeks="1-12")
    return found.groupBy(F.col("season").cast("long").alias("season"), F.col("week").cast("long").alias("week")).agg(F.count("*").alias("n"), F.sum("replaced").alias("replaced"))


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal > 0 AS rich, CAST(count(*) OVER () AS BIGINT) AS n_rows FROM customer")
def written_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows go out as CSV, as a dataset with its lineage record, and as a backup, and come back through the scans."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_acctbal") > 0).alias("rich"))
    folder = _folder(spark, "files")
    csv = sinks.stamped(folder, "csv")
    sinks.write_csv(rows, csv)
    back = scan.scan_csv(spark, csv, "id long, name string, rich boolean")
    counted = sinks.write_dataset(back, f"{folder}/set", ["id"])
    sinks.backup(spark.read.parquet(f"{folder}/set"), f"{folder}/backup")
    return spark.read.parquet(f"{folder}/backup").withColumn("n_rows", F.lit(counted["n_rows"]).cast("long"))


@query("""
SELECT page_id, length(html) AS size, CAST(page_id % 3 AS BIGINT) AS n, CAST(x AS BIGINT) AS x FROM pages, range(0, 3) AS r(x) WHERE x < page_id % 3
""")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over several lines, with lists within, written as text and read with a stated schema; fields that it lacks are left out."""
    list_ = F.transform(F.filter(F.array(*map(F.lit, range(3))), lambda x: x < F.col("page_id") % 3), lambda x: F.struct(x.alias("x"), F.lit("other").alias("y")))
    one = F.to_json(F.struct("page_id", F.length("html").alias("size"), (F.col("page_id") % 3).alias("n"), list_.alias("items"), F.lit("a\nb").alias("more")), {"pretty": "true"})
    folder = _folder(spark, "json")
    pages = table(spark, sf_dir, "pages").select(one.alias("value"), F.floor(F.col("page_id") / 50).alias("_p"))  # 50 to a file
    documents = pages.groupBy("_p").agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ",\n"), F.lit("]")).alias("value"))  # a file is an array of documents
    documents.write.partitionBy("_p").text(folder)
    found = scan.scan_json(spark, folder, "page_id long, size int, n long, items array<struct<x: long>>")
    return found.select("page_id", F.col("size").cast("long").alias("size"), "n", F.explode("items.x").alias("x"))
