"""Sources: partitioned Parquet, CSV with one or two header rows, JSON, JDBC, HTML tables and seed dimensions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.filters import ensure_columns, in_periods


class Catalog:
    """Tables by name below one root; ValueError for a name that is not listed."""

    def __init__(self, spark: SparkSession, root: str, paths: Mapping[str, str]) -> None:
        self.spark, self.root, self.paths = spark, root.rstrip("/"), dict(paths)

    def path(self, name: str) -> str:
        if name not in self.paths:
            raise ValueError(f"no table {name!r}; known: {sorted(self.paths)}")
        return f"{self.root}/{self.paths[name]}"

    def table(self, name: str, seasons: str | None = None, weeks: str | None = None) -> DataFrame:
        return scan_partitioned(self.spark, self.path(name), seasons, weeks)

    def tables(self, names: Sequence[str], seasons: str | None = None, weeks: str | None = None) -> dict[str, DataFrame]:
        """Frames by name; nothing is read yet."""
        return {n: self.table(n, seasons, weeks) for n in names}


    def validated(self, columns: Mapping[str, Sequence[str]], seasons: str | None = None, weeks: str | None = None) -> dict[str, DataFrame]:
        """Frames by name; ValueError, before anything is read, that names every table without a column it must have or without a file."""
        found, wrong = {}, []
        for name, needed in columns.items():
            try:
                found[name] = self.table(name, seasons, weeks)
            except AnalysisException as error:
                wrong.append(f"{name}: {error.getCondition()}")
                continue
            if missing := {*needed} - {*found[name].columns}:
                wrong.append(f"{name}: no {sorted(missing)}")
        if wrong:
            raise ValueError("; ".join(wrong))
        return found


def scan_partitioned(
    spark: SparkSession, path: str, seasons: str | None = None, weeks: str | None = None, tolerant: bool = False, schema: str | None = None, merge_schema: bool = False
) -> DataFrame:
    """A Parquet table that is partitioned by season and week, by season alone, or not at all.

    The period filters are predicates on the partition columns, so files of other periods are not
    read. ``season_id`` and ``week_id`` are added from the partition where the files lack them.
    With ``tolerant`` unreadable files are skipped. Where files differ in their columns state a
    ``schema``; ``merge_schema`` finds it instead, at the cost of reading every file's footer.
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", merge_schema)
    if tolerant:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    df = reader.parquet(path)
    for column, spec in (("season", seasons), ("week", weeks)):
        if column in df.columns:
            df = df.where(in_periods(F.col(column), spec))
        kind = {f"{column}_id": "int"}
        df = df.withColumn(f"{column}_id", F.col(column).cast("int")) if column in df.columns and f"{column}_id" not in df.columns else ensure_columns(df, kind)
    return df


def week_dimension(weeks: DataFrame) -> DataFrame:
    """(week_id, week_num int, season_id), each week once; ValueError if a column is absent."""
    if missing := {"week_id", "week_num", "season_id"} - {*weeks.columns}:
        raise ValueError(f"absent: {sorted(missing)}")
    return weeks.select("week_id", F.col("week_num").try_cast("int").alias("week_num"), "season_id").distinct()


def with_week_numbers(games: DataFrame, weeks: DataFrame) -> DataFrame:
    """``games`` with week_num by week_id; where the dimension lacks the week, that of the partition."""
    numbers = week_dimension(weeks).groupBy("week_id").agg(F.min("week_num").alias("_num"))
    own = F.col("week").cast("int") if "week" in games.columns else F.lit(None).cast("int")
    return games.join(numbers, "week_id", "left").withColumn("week_num", F.coalesce("_num", own)).drop("_num")


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: str | None = None) -> DataFrame:
    """CSV with a header row; without a schema all columns are text, so nothing depends on a guess."""
    reader = spark.read.option("header", "true").option("enforceSchema", "false")
    path = path if isinstance(path, str) else list(path)
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def merged_header(groups: Sequence[str | None], names: Sequence[str | None]) -> list[str]:
    """One name for each column of two header rows: a group holds until the next; repeated names are numbered."""
    found: list[str] = []
    for group, name in zip(groups, names, strict=True):
        bits = [b.strip() for b in (group or "", name or "") if b and b.strip() and not b.startswith("Unnamed")]
        label = "_".join(bits) or f"column_{len(found) + 1}"
        n = sum(re.fullmatch(re.escape(label) + r"(_\d+)?", x) is not None for x in found)
        found.append(f"{label}_{n + 1}" if n else label)
    return found


def scan_two_header_csv(spark: SparkSession, path: str) -> DataFrame:
    """One CSV file whose first two rows together name the columns; later repeats of either are dropped.

    ValueError for several files: which of them has the header is not defined.
    """
    raw = spark.read.option("header", "false").csv(path)
    if len(raw.inputFiles()) > 1:
        raise ValueError(f"{path} is more than one file")
    head = raw.limit(2).collect()
    if len(head) < 2:
        raise ValueError("two header rows are needed")
    named = raw.toDF(*merged_header(*head))
    first = named.columns[0]
    return named.where(~F.coalesce(F.col(f"`{first}`").isin(*[h[0] for h in head if h[0]]), F.lit(False)))


def latest_file(spark: SparkSession, folder: str, pattern: str = "*.csv") -> str | None:
    """The path of the file that was modified last, of equals the last by name; null if there is none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    row = files.select("path", "modificationTime").agg(F.max_by("path", F.struct("modificationTime", "path"))).first()
    return row[0] if row else None


def latest_in(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """Of several files the one that was modified last, of equals the last by name."""
    row = spark.read.format("binaryFile").load(list(paths)).agg(F.max_by("path", F.struct("modificationTime", "path"))).first()
    return row[0] if row else None


def week_of(weeks: DataFrame, week_id: int) -> tuple[int, int] | None:
    """(season_id, week_num) of a week, null if the dimension lacks it."""
    row = week_dimension(weeks).where(F.col("week_id") == week_id).agg(F.min(F.struct("season_id", "week_num"))).first()
    return tuple(row[0]) if row and row[0] else None


def latest_pair(spark: SparkSession, folder: str, tokens: Sequence[str]) -> dict[str, str | None]:
    """The latest file for each token in the name."""
    return {t: latest_file(spark, folder, f"*{t}*") for t in tokens}


def scan_jdbc(spark: SparkSession, url: str, name: str, column: str, bounds: tuple[int, int], parts: int, properties: Mapping[str, str]) -> DataFrame:
    """A database table read in ``parts`` ranges of an integer column."""
    return spark.read.jdbc(url, name, column=column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts, properties=dict(properties))


def with_dimensions(df: DataFrame, seasons: DataFrame, weeks: DataFrame) -> DataFrame:
    """``df`` with year and week_num where it has season_id and week_id. The dimensions are unique by id."""
    if "season_id" in df.columns:
        df = df.join(seasons.select("season_id", "year"), "season_id", "left")
    if "week_id" in df.columns:
        df = df.join(week_dimension(weeks).select("week_id", "week_num"), "week_id", "left")
    return df


def scan_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Whole-file JSON documents, of a stated schema if there is one."""
    reader = spark.read.option("multiLine", "true")
    return reader.schema(schema).json(path) if schema else reader.json(path)


def column_arrays(df: DataFrame, json: str, path: str, columns: Mapping[str, str]) -> DataFrame:
    """``df`` without the text ``json`` and with a row for each place of the arrays at ``path`` in it: column -> type.

    This is how services send series: one object whose fields are arrays of equal length. Shorter arrays
    end in nulls; where the object is absent or no JSON there are no rows.
    """
    fields = ", ".join(f"`{c}`: array<{kind}>" for c, kind in columns.items())
    found = F.from_json(F.get_json_object(F.col(json), path), f"struct<{fields}>")
    rest = [c for c in df.columns if c != json]
    return df.select(*rest, found.alias("_s")).select(*rest, F.inline(F.arrays_zip(*[F.col(f"_s.`{c}`").alias(c) for c in columns]))).toDF(*rest, *columns)


def hourly(df: DataFrame, start: str, end: str, name: str = "hour") -> DataFrame:
    """A row for each full hour between two timestamps."""
    return df.withColumn(name, F.explode(F.sequence(F.date_trunc("hour", F.col(start)), F.col(end), F.expr("INTERVAL 1 HOUR"))))


def season_weeks(spark: SparkSession, years: Sequence[int], weeks: int = 18) -> DataFrame:
    """(season_id, year, week_id, week_num): the seed dimensions, numbered in order."""
    seasons = spark.createDataFrame([(i + 1, y) for i, y in enumerate(sorted(years))], "season_id int, year int")
    rows = seasons.select("*", F.explode(F.sequence(F.lit(1), F.lit(weeks))).alias("week_num"))
    return rows.select("season_id", "year", ((F.col("season_id") - 1) * weeks + F.col("week_num")).alias("week_id"), "week_num")


def html_rows(html: Column) -> Column:
    """Array of the table rows of a page that are not header rows."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>.*?</tr>"), F.lit(0))
    return F.filter(rows, lambda r: ~r.rlike(r"(?is)^<tr\b[^>]*\bthead\b") & r.rlike(r"(?i)<td\b"))


def html_cells(row: Column) -> Column:
    """Array of the cell texts of a table row, without markup."""
    cells = F.regexp_extract_all(row, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1))
    return F.transform(cells, lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]*>", ""), r"\s+", " ")))


def html_links(html: Column) -> Column:
    """Array of all link targets, in order."""
    return F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*\bhref\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1))


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, row, cells, links) for each row of each page's tables."""
    rows = pages.select(key, F.posexplode(html_rows(F.col(html))).alias("row", "_tr"))
    return rows.select(key, "row", html_cells(F.col("_tr")).alias("cells"), html_links(F.col("_tr")).alias("links"))


def column_ranges(df: DataFrame, keys: Sequence[str], ranges: Mapping[str, tuple[int, int]]) -> dict[str, DataFrame]:
    """One wide table as several by column position: name -> (first, end)."""
    return {n: df.select(*keys, *[F.col(f"`{c}`") for c in df.columns[a:b] if c not in keys]) for n, (a, b) in ranges.items()}
