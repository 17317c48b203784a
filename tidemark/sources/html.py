"""HTML tables with spanned headers, as cells with the path of their column's header.

Everything is an expression on the page's text: no parser leaves the JVM, and a page is one row until
its cells are exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A span beyond this counts as one, as HTML has it for columns.
MOST = 1000
_NONE = "array<struct<path: array<string>, left: int>>"


def tables(html: Column, attribute: str = "") -> Column:
    """Array of a page's tables; with ``attribute`` those whose opening tag matches that pattern."""
    found = F.regexp_extract_all(html, F.lit(r"(?is)<table\b[^>]*>.*?</table>"), F.lit(0))
    return F.filter(found, lambda t: F.regexp_extract(t, r"(?is)^<table\b([^>]*)>", 1).rlike(f"(?i){attribute}")) if attribute else found


def rows(table: Column) -> Column:
    return F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>.*?</tr>"), F.lit(0))


def _text(cell: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(cell, r"(?s)<[^>]*>", " "), r"\s+", " "))


def _span(cell: Column, name: str) -> Column:
    n = F.regexp_extract(cell, rf"(?is)^<t[dh]\b[^>]*\b{name}\s*=\s*[\"']?(\d+)", 1).try_cast("int")
    return F.coalesce(F.get(F.filter(F.array(n), lambda v: v.between(1, MOST)), F.lit(0)), F.lit(1))  # read once, compared twice


def _cells(row: Column) -> Column:
    return F.regexp_extract_all(row, F.lit(r"(?is)<t[dh]\b[^>]*>.*?</t[dh]>"), F.lit(0))


def cells(row: Column) -> Column:
    """Array of (text, cols, rows): the cells of a table row with their spans, 1 where none or no sensible one is stated."""
    return F.transform(_cells(row), lambda c: F.struct(_text(c).alias("text"), _span(c, "colspan").alias("cols"), _span(c, "rowspan").alias("rows")))


def spread(row: Column) -> Column:
    """The cells of a row, each repeated over the columns that it spans."""
    return F.flatten(F.transform(cells(row), lambda c: F.array_repeat(c, c["cols"])))


def values(row: Column) -> Column:
    """The texts of ``spread`` alone; spans over rows are not read."""
    return F.flatten(F.transform(_cells(row), lambda c: F.array_repeat(_text(c), _span(c, "colspan"))))


def header_grid(header: Column) -> Column:
    """Array with the header path of each column, from an array of header rows.

    A cell covers the columns and rows that it spans; cells of a later row fill the columns that no cell
    from above still covers, from the left, as a browser lays them out. Empty texts add nothing to a path.
    """
    held = lambda s: s["left"] > 0

    def lay(state: Column, new: Column) -> Column:
        width = F.greatest(F.size(state), F.size(new) + F.size(F.filter(state, held)))

        def column(i: Column) -> Column:
            above = F.get(state, i)
            cell = F.get(new, i - F.size(F.filter(F.slice(state, F.lit(1), i), held)))
            own = F.filter(F.array(cell["text"]), lambda t: F.coalesce(t, F.lit("")) != "")
            path = F.concat(F.coalesce(above["path"], F.array().cast("array<string>")), own)
            return F.when(F.coalesce(above["left"], F.lit(0)) > 0, F.struct(above["path"].alias("path"), (above["left"] - 1).alias("left"))).otherwise(
                F.struct(path.alias("path"), (F.coalesce(cell["rows"], F.lit(1)) - 1).alias("left"))
            )

        return F.when(width > 0, F.transform(F.sequence(F.lit(0), width - 1), column)).otherwise(F.array().cast(_NONE))

    # The rows are parsed before they are laid out: within it they would be parsed for every column.
    grid = F.aggregate(F.transform(header, spread), F.array().cast(_NONE), lay)
    return F.transform(grid, lambda g: g["path"])


def spanned_cells(pages: DataFrame, key: str, html: str, attribute: str = "") -> DataFrame:
    """(key, table, row, at, group, name, value) for every body cell of every table of every page.

    Header rows are those without a ``td`` before the first that has one; a later row without is a repeated
    header and is left out. ``group`` is the first part of the column's header path, ``name`` the rest
    joined by ``_``; a path of one part has no group, a column without a header neither. ``at`` counts
    columns from 0, so spans may differ from page to page. A body cell that spans columns is its value in
    each. Null pages and pages without tables give nothing.
    """
    one = pages.select(key, F.posexplode(tables(F.col(html), attribute)).alias("table", "_t")).withColumn("_rows", rows(F.col("_t")))
    body = F.transform("_rows", lambda r: r.rlike(r"(?is)<td\b"))
    first = F.array_position(body, True).cast("int")
    one = one.where(first > 0).select(key, "table", header_grid(F.slice("_rows", F.lit(1), first - 1)).alias("_grid"), F.filter("_rows", lambda r: r.rlike(r"(?is)<td\b")).alias("_body"))
    one = one.select(key, "table", "_grid", F.posexplode("_body").alias("row", "_tr"))
    one = one.select(key, "table", "row", "_grid", F.posexplode(values(F.col("_tr"))).alias("at", "value"))
    path = F.get("_grid", F.col("at"))
    group = F.when(F.size(path) > 1, path[0])
    name = F.when(F.size(path) > 1, F.array_join(F.slice(path, F.lit(2), F.size(path) - 1), "_")).when(F.size(path) == 1, path[0])
    return one.select(key, "table", "row", "at", group.alias("group"), name.alias("name"), "value")


def by_group(found: DataFrame, key: str) -> DataFrame:
    """(key, table, row, group, values): one row for each header group of a table row, its values by name in a map.

    Of columns with the same name the first counts. This splits a wide table into as many as its header
    has groups, whatever columns they span.
    """
    first = found.groupBy(key, "table", "row", "group", "name").agg(F.min_by("value", "at").alias("value")).where("name IS NOT NULL")
    return first.groupBy(key, "table", "row", "group").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("values"))


def page_tables(pages: DataFrame, html: str, wanted: dict[str, str], tags: list[str]) -> DataFrame:
    """Cells of several tables of each page, by the pattern of their opening tags: name -> pattern, with the page's ``tags``.

    ``tags`` are columns of ``pages``, such as week, year and game, that every cell of a page carries.
    """
    found = []
    for name, pattern in wanted.items():
        keyed = pages.select(F.struct(*tags).alias("_tags"), html)
        cells = spanned_cells(keyed, "_tags", html, pattern)
        found.append(cells.select("_tags.*", F.lit(name).alias("kind"), "row", "at", "group", "name", "value"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out
