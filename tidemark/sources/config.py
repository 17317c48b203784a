"""A dataset stated as configuration: where its tables are, which seasons it covers, and which sources join its spine."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.filters import in_periods
from tidemark.operators.joins import FeatureSource, join_source
from tidemark.sources.scan import Catalog


def parse(text: str, variables: Mapping[str, str] | None = None) -> dict:
    """JSON, or YAML where that can be read, with ``${NAME}`` replaced from ``variables`` or the environment.

    ValueError if a name has no value or the text is no mapping.
    """
    known = os.environ if variables is None else variables

    def value(found: re.Match) -> str:
        if found[1] not in known:
            raise ValueError(f"no value for {found[0]}")
        return known[found[1]]

    text = re.sub(r"\$\{(\w+)\}", value, text)
    try:
        out = json.loads(text)
    except json.JSONDecodeError:
        try:
            import yaml
        except ImportError as error:
            raise ValueError("the text is no JSON, and YAML cannot be read here") from error
        out = yaml.safe_load(text)
    if not isinstance(out, dict):
        raise ValueError("a configuration is a mapping")
    return out


@dataclass(frozen=True)
class Source:
    """What is joined: the table, spine column -> its column, features, and how; see ``FeatureSource``."""

    table: str
    keys: Mapping[str, str]
    features: list[str]
    prefix: str = ""
    shift: int = 0
    period: str = "week_id"
    fill: Mapping[str, object] = field(default_factory=dict)
    enabled: bool = True


@dataclass(frozen=True)
class Dataset:
    """A whole configuration, checked: unknown names in it are an error."""

    root: str
    tables: Mapping[str, str]
    spine: str
    columns: list[str]
    seasons: str | None = None
    weeks: str | None = None
    exclude: list[str] = field(default_factory=list)
    sources: list[Source] = field(default_factory=list)

    @classmethod
    def of(cls, config: Mapping) -> Dataset:
        """ValueError if a name is unknown, one that is needed is absent, or a source's table is not listed."""
        try:
            found = cls(**{**config, "sources": [Source(**s) for s in config.get("sources", [])]})
        except TypeError as error:
            raise ValueError(str(error)) from error
        if unknown := {found.spine, *(s.table for s in found.sources)} - {*found.tables}:
            raise ValueError(f"tables that are not listed: {sorted(unknown)}")
        return found


def build(spark: SparkSession, config: Dataset) -> DataFrame:
    """The spine's columns for the seasons and weeks wanted, joined to each enabled source in turn, without the excluded columns.

    Sources are joined on unique keys; nothing is read until the result is.
    """
    catalog = Catalog(spark, config.root, config.tables)
    spine = catalog.table(config.spine)
    for column, spec in (("season", config.seasons), ("week", config.weeks)):
        if column in spine.columns:
            spine = spine.where(in_periods(F.col(column), spec))
    out = spine.select(*config.columns)
    for s in config.sources:
        if s.enabled:
            out = join_source(out, FeatureSource(catalog.table(s.table), s.keys, s.features, s.prefix, s.shift, s.period, s.fill))
    return out.drop(*config.exclude)


def described(catalog: Catalog) -> DataFrame:
    """(table, place, column, type) for every column of every table of a catalog, from the tables' schemas alone."""
    rows = [(name, i, c, t) for name in sorted(catalog.paths) for i, (c, t) in enumerate(catalog.spark.read.parquet(catalog.path(name)).dtypes)]
    return catalog.spark.createDataFrame(rows, "table string, place int, column string, type string")
