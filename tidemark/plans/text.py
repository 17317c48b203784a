"""Queries on scalar functions: text, dates, numbers, arrays, JSON and HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.plans.registry import query
from tidemark.plans.totals import table
from tidemark.sources.scan import html_cells, html_links, html_rows


@query("SELECT c_custkey, md5(coalesce(c_name, '') || '_' || coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END, '') || '_' || CAST(c_nationkey AS VARCHAR)) AS guid FROM customer")
def md5_guid(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", S.guid(F.col("c_name"), segment, F.col("c_nationkey")).alias("guid"))


@query("""
SELECT event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY ALL
""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    return table(spark, sf_dir, "events").groupBy("event_type", k.alias("k")).agg(F.count("*").alias("n"))


@query("""
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || CASE WHEN l_orderkey % 2 = 0 THEN '-' || CAST(l_suppkey AS VARCHAR) ELSE '' END AS x FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(split_part(x, '-', 1) AS INTEGER) AS win, CAST(split_part(x, '-', 2) AS INTEGER) AS loss, TRY_CAST(nullif(split_part(x, '-', 3), '') AS INTEGER) AS tie FROM d
""")
def parse_dash_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.concat_ws("-", F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber").cast("string"), F.when(F.col("l_orderkey") % 2 == 0, F.col("l_suppkey").cast("string")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.split_numbers(x, 3).alias("n"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.col("n")[0].alias("win"), F.col("n")[1].alias("loss"), F.col("n")[2].alias("tie"))


@query("""
WITH d AS (SELECT l_orderkey, l_partkey, l_linenumber, CAST(CAST(l_discount * 100 AS INTEGER) AS VARCHAR) AS n FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, round(CAST(n AS DOUBLE) / 100, 4) AS always, CASE WHEN l_orderkey % 2 = 0 THEN CAST(n AS DOUBLE) / 100 ELSE CAST(n AS DOUBLE) END AS marked,
       CASE WHEN l_orderkey % 2 = 0 OR CAST(n AS DOUBLE) > 1 THEN CAST(n AS DOUBLE) / 100 ELSE CAST(n AS DOUBLE) END AS guessed FROM d
""")
def percent_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.when(F.col("l_orderkey") % 2 == 0, "%").otherwise(""))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", x.alias("x"))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", *[f(F.col("x")).alias(n) for n, f in (("always", S.percent_always), ("marked", S.percent_marked), ("guessed", S.percent_guessed))])


@query("""
SELECT o_orderkey, o_orderkey % 60 * 60 + o_custkey % 60 AS secs, lpad(CAST((o_orderkey % 12 + CASE WHEN o_custkey % 2 = 0 THEN 12 ELSE 0 END) AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0') || ':00' AS clock FROM orders
""")
def clock_and_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    minute, hour = F.lpad((F.col("o_custkey") % 60).cast("string"), 2, "0"), F.col("o_orderkey") % 12
    duration = F.concat(F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0"), F.lit(":"), minute)
    clock = F.concat(F.when(hour == 0, 12).otherwise(hour).cast("string"), F.lit(":"), minute, F.when(F.col("o_custkey") % 2 == 0, "PM").otherwise("AM"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.seconds(duration).cast("long").alias("secs"), S.clock_24h(clock).alias("clock"))


@query("""
SELECT p_partkey, CAST(5 + p_size % 3 AS INTEGER) * 12 + CAST(p_size % 12 AS INTEGER) AS inches, CASE WHEN p_size % 5 = 0 THEN 0 ELSE CAST(p_size AS INTEGER) END AS years,
       CASE WHEN p_size % 7 > 0 THEN CAST(p_size AS INTEGER) END AS whole_number, least(round(p_retailprice * p_size, 4), 999.9999::DOUBLE) AS clamped FROM part
""")
def number_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    height = F.concat((5 + size % 3).cast("string"), F.when(size % 2 == 0, "-").otherwise("' "), (size % 12).cast("string"), F.when(size % 2 == 0, "").otherwise('"'))
    years = F.when(size % 5 == 0, "Rook").otherwise(F.concat(size.cast("string"), F.lit(" years")))
    text = F.when(size % 7 == 0, "n/a").otherwise(F.concat(size.cast("string"), F.lit(".0")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", S.height_inches(height).alias("inches"), S.leading_number(years).alias("years"), S.whole(text).alias("whole_number"),
        S.decimal_7_4(F.col("p_retailprice") * size).cast("double").alias("clamped"),
    )


@query("""
WITH n AS (SELECT s_suppkey, 's' || CAST(s_suppkey AS VARCHAR) || CASE WHEN s_suppkey % 3 = 0 THEN '-x' ELSE '' END AS last, ['jr.', 'iii', ''][s_suppkey % 3 + 1] AS suffix FROM supplier)
SELECT s_suppkey, array_to_string(list_sort(list_distinct([
  trim('dj ' || last || ' ' || suffix), 'dj ' || last, 'd.j. ' || last, 'dj ' || replace(last, '-', ' '), 'dj ' || regexp_replace(last, '-.*', '')])), '|') AS variants FROM n
""")
def name_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of names that differ in surname, hyphen and suffix; marks and a reserve tag are no part of them."""
    key = F.col("s_suppkey")
    last = F.concat(F.lit("S"), key.cast("string"), F.when(key % 3 == 0, "-X").otherwise(""))
    suffix = F.when(key % 3 == 0, "  Jr.*").when(key % 3 == 1, " III").otherwise("")
    name = F.concat(F.lit("DJ "), last, suffix, F.when(key % 2 == 0, " (IR)").otherwise(""))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(S.name_variants(name), "|").alias("variants"))


@query("""
SELECT p_partkey, array_to_string(list_sort(list_distinct([CAST(p_size AS INTEGER), CAST(p_size % 7 AS INTEGER), 3])), ',') AS weeks FROM part
""")
def array_set_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws(",", F.col("p_size").cast("string"), (F.col("p_size") % 7).cast("string"), F.lit("3, x"))
    return table(spark, sf_dir, "part").select("p_partkey", S.week_text(S.week_set(text)).alias("weeks"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS swapped, CAST(o_orderdate AS DATE) AS parsed, CAST(o_orderkey % 3 <= 1 AS BOOLEAN) AS near FROM orders
""")
def date_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", S.swap_day_month(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("swapped"), S.date_of(F.date_format("o_orderdate", "M/d/yyyy")).alias("parsed"),
        S.days_apart(day, F.date_add(day, (F.col("o_orderkey") % 3).cast("int"))).alias("near"),
    )


@query("""
SELECT p_partkey, 'PIT' AS side, CAST(p_size AS DOUBLE) AS yard, CASE WHEN p_size > 25 THEN 5 ELSE CAST(least(p_size, 5) AS INTEGER) END AS quarter, 'Fumble' AS first_result, CASE WHEN p_size % 2 = 0 THEN 'Safety' END AS second_result,
       'Team' AS favourite, CAST(-p_size AS DOUBLE) - 0.5::DOUBLE AS line, CAST(p_size % 2 = 0 AS INTEGER) AS is_flag FROM part
""")
def play_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    text = size.cast("string")
    position = S.field_position(F.concat(F.lit("PIT "), text))
    result = S.primary_secondary(F.concat(F.lit("Fumble"), F.when(size % 2 == 0, ", Safety").otherwise("")))
    line = S.betting_line(F.concat(F.lit("Team -"), text, F.lit(".5")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", position["side"].alias("side"), position["yard"].alias("yard"), S.quarter(F.when(size > 25, "OT2").otherwise(text)).alias("quarter"),
        result["primary"].alias("first_result"), result["secondary"].alias("second_result"), line["name"].alias("favourite"), line["value"].alias("line"),
        S.flag(F.when(size % 2 == 0, " YES ").otherwise("no")).alias("is_flag"),
    )


@query("""
SELECT page_id, len(regexp_extract_all(html, '(?is)<a\\b[^>]*\\bhref\\s*=\\s*["'']([^"'']*)["'']')) AS n_links,
       coalesce(regexp_extract_all(html, '(?is)<a\\b[^>]*\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1)[1], '') AS first_link FROM pages
""")
def html_link_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "pages").select("page_id", html_links(F.col("html")).alias("l"))
    return links.select("page_id", F.size("l").cast("long").alias("n_links"), F.coalesce(F.get("l", F.lit(0)), F.lit("")).alias("first_link"))


@query("""
SELECT page_id, CAST(page_id % 5 AS BIGINT) AS n_rows, CASE WHEN page_id % 5 > 0 THEN 'p' || CAST(page_id AS VARCHAR) || '|' || CAST(page_id % 5 - 1 AS VARCHAR) END AS last_cells FROM pages
""")
def html_drop_header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table appended to each page: header rows, by class or by their cells, are dropped, and markup is stripped."""
    n = F.col("page_id") % 5
    body = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.when(i < n, F.concat(
        F.lit("<tr data-i='1'><td><b>p"), F.col("page_id").cast("string"), F.lit("</b></td>\n<td class=x> "), i.cast("string"), F.lit(" </td></tr><TR class='thead'><td>p</td></TR>"))).otherwise(""))
    html = F.concat(F.coalesce("html", F.lit("")), F.lit("<table><tr><th>name</th></tr>"), F.array_join(body, ""), F.lit("</table>"))
    rows = html_rows(html)
    return table(spark, sf_dir, "pages").select("page_id", F.size(rows).cast("long").alias("n_rows"), F.array_join(html_cells(F.element_at(F.when(F.size(rows) > 0, rows), -1)), "|").alias("last_cells"))
