"""URL filter with redirect equivalence.

Rules name a host and the start of a path; they are a table, of any size, that is joined on the
endings of a host and the beginnings of a path which some rule has. A page that no rule fits takes the decision of its
aliases: pages are connected by redirects (HTTP records, or a page's meta refreshes) and by canonical
links, and a component with an explicitly allowed URL is allowed, else one with a blocked URL is
blocked. URLs that are only the end of an edge count too, whether or not they were crawled.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, cut, table

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?is)<link\b(?=[^>]*\brel\s*=\s*(?:\"(?:[^\">]*\s)?|'(?:[^'>]*\s)?)?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] | DataFrame = RULES) -> DataFrame:
    """Rules as a table (verdict, of, start), one for each host and path; of several verdicts on one, allow holds."""
    if not isinstance(rules, DataFrame):
        listed = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
        rules = spark.range(1).select(F.inline(F.array(*listed))) if listed else spark.sql("SELECT '' AS verdict, '' AS host, '' AS path LIMIT 0")
    known = rules.where("verdict IS NOT NULL AND host IS NOT NULL AND path IS NOT NULL")
    return known.groupBy(F.col("host").alias("of"), F.col("path").alias("start")).agg(F.min("verdict").alias("verdict"))  # allow sorts before block


def decide(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, own): the rule and verdict that fit each host and path of ``urls``, if any does.

    The longest rule wins, by the characters of host and path together; of equally long ones that
    with the longer host. A host is joined by those of its endings that are no longer than the
    longest of a rule, and a path by as many of its beginnings as its rules have lengths: no
    number of rules makes a URL meet them one by one. Repeated rows of ``urls`` are judged once; a
    null host or path has no rule. No rows or no rules give no rows.
    """
    hosts = cut(rules.groupBy("of").agg(F.collect_set(F.length("start")).alias("lengths")), "hosts")
    most = hosts.agg(F.max(F.length("of"))).first()[0] or 0
    distinct = urls.select("host", "path").where("host IS NOT NULL AND path IS NOT NULL").distinct()
    # A dot before the host, so that it is an ending of its own; only what follows a dot is one.
    tail = F.right(F.concat(F.lit("."), "host"), F.lit(most + 1))
    places = F.filter(F.sequence(F.lit(1), F.length("tail")), lambda i: F.substring(F.col("tail"), i, F.lit(1)) == ".")
    ends = distinct.select("host").distinct().withColumn("tail", tail).select("host", F.explode(F.transform(places, lambda i: F.substring(F.col("tail"), i + 1, F.lit(most)))).alias("of"))
    fitting = ends.join(hosts, "of")
    begun = distinct.join(fitting.hint("merge"), "host").select("host", "path", "of", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n"))
    begun = begun.select("host", "path", "of", F.substring(F.col("path"), F.lit(1), F.col("n")).alias("start"))
    size = F.struct(F.length("of") + F.length("start"), F.length("of"))
    value = F.struct(F.concat("of", "start").alias("rule"), "verdict")
    return begun.join(rules, ["of", "start"]).groupBy("host", "path").agg(F.max_by(value, size).alias("own"))


def node(url: Column) -> Column:
    """A URL as a node: host, path (at least ``/``) and query, without scheme and fragment; null without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(url.contains("://"), F.concat(host(url), rest))


def resolve(target: Column, base: Column) -> Column:
    """``target`` as an absolute URL; null stays null, as does an empty target."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(path(base), r"(?s)^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(F.coalesce(target, F.lit("")) == "", F.lit(None).cast("string"))
        .when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(F.concat(site, folder, target))
    )


def alias_edges(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) between nodes: each page's canonical links and meta refreshes, and rows (from_url, to_url)."""
    url, html = F.col("url").cast("string"), F.col("html").cast("string")
    linked = pages.where(url.contains("://") & html.rlike("(?i)canonical|refresh"))
    targets = F.concat(F.regexp_extract_all(html, F.lit(_LINK), 1), F.regexp_extract_all(html, F.lit(_REFRESH), 1))
    edges = linked.select(url.alias("url"), F.explode(targets).alias("target")).select(
        node(F.col("url")).alias("a"), node(resolve(F.col("target"), F.col("url"))).alias("b")
    )
    if redirects is not None:
        edges = edges.union(redirects.select(node(F.col("from_url")), node(resolve(F.col("to_url"), F.col("from_url")))))
    return edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")


def judge(pages: DataFrame, redirects: DataFrame | None = None, rules: tuple[tuple[str, str, str], ...] | DataFrame = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url, html).

    ``rules`` are rows (verdict, host, path), as a table if there are many. A page's own rule
    decides, the longest that fits; else its component's, with an allowed URL before a blocked one;
    else it is allowed. A url that is null or has no ``://`` has an empty host and path, which no
    rule of a host fits, and no aliases. Null or empty html has no links; html of any length is
    searched whole. Repeated rows are each judged; several pages of one URL are one node and share
    their links. Other columns, also such as host, rule or verdict, are ignored. No pages give no rows.
    """
    known = cut(rule_table(pages.sparkSession, rules), "rules")
    parts = connected_components(alias_edges(pages, redirects))
    h, p = F.regexp_extract("node", "(?s)^([^/]*)", 1), F.regexp_extract("node", r"(?s)^[^/]*([^?]*)", 1)
    nodes = parts.select("node", "component", h.alias("host"), p.alias("path"))
    explicit = nodes.join(decide(nodes, known), ["host", "path"]).select("component", F.col("own.verdict").alias("own"))
    verdicts = explicit.groupBy("component").agg(F.min("own").alias("found"))  # allow sorts before block
    aliases = cut(parts.join(verdicts, "component").select("node", "found"), "aliases")
    url = F.col("url").cast("string")
    judged = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), node(url).alias("node"))
    # Both tables grow with the pages; written small, they would be taken for small enough to broadcast.
    judged = judged.join(cut(decide(judged, known), "decided").hint("merge"), ["host", "path"], "left").join(aliases.hint("merge"), "node", "left")
    return judged.select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"), F.coalesce("own.verdict", "found", F.lit("allow")).alias("verdict")
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page."""
    return judge(table(spark, sf_dir, "pages"))


OP7_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), t AS (
  SELECT url, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*'), lambda x: regexp_matches(x, '(?is)\brel\s*=\s*(?:"(?:[^">]*\s)?|''(?:[^''>]*\s)?)?canonical\b')),
                   lambda x: regexp_extract(x, '(?is)^<link\b[^>]*\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
    list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*'), lambda x: regexp_matches(x, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')),
                   lambda x: regexp_extract(x, '(?is)^<meta\b[^>]*\burl\s*=\s*["'']?([^"''\s>;]+)', 1)))) AS target
  FROM pages WHERE contains(url, '://')
), u AS (
  SELECT url, CASE WHEN contains(target, '://') THEN target
    WHEN starts_with(target, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || target
    WHEN starts_with(target, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || target
    ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1)
         || coalesce(nullif(regexp_extract(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '(?s)^(.*/)', 1), ''), '/') || target END AS target
  FROM t WHERE target <> ''
), n AS (
  SELECT url, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      || CASE WHEN starts_with(regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1), '/') THEN '' ELSE '/' END
      || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS node
  FROM (SELECT url FROM pages UNION SELECT target FROM u) WHERE contains(url, '://')
), e AS (
  SELECT a.node AS a, b.node AS b FROM u JOIN n AS a ON u.url = a.url JOIN n AS b ON u.target = b.url WHERE a.node <> b.node
), pairs AS (SELECT a, b FROM e UNION SELECT b, a FROM e
), reach(a, b) AS (
  SELECT a, b FROM pairs UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a
), rules(verdict, h, s) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), v AS (
  SELECT DISTINCT node, (SELECT arg_max(verdict, length(h || s)) FROM rules
    WHERE (split_part(node, '/', 1) = h OR ends_with(split_part(node, '/', 1), '.' || h))
      AND starts_with(regexp_extract(node, '(?s)^[^/]*([^?]*)', 1), s)) AS verdict
  FROM n
), found AS (
  SELECT reach.a AS node, min(v.verdict) AS verdict FROM reach JOIN v ON reach.b = v.node GROUP BY reach.a
), j AS (
  SELECT page_id, url, host, path, (SELECT arg_max(struct_pack(rule := h || s, verdict := verdict), length(h || s)) FROM rules
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)) AS own
  FROM p
)
SELECT page_id, host, path, own.rule AS rule, coalesce(own.verdict, found.verdict, 'allow') AS verdict
FROM j LEFT JOIN n ON j.url = n.url LEFT JOIN found ON n.node = found.node
"""
