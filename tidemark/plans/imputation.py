"""A query for each imputation table, over orders as rows with some nulls and zeros in every column that the table names.

For the tables in ``imputation_sql`` the SQL is written by hand. For the others it is made from the
declared rules and states their meaning anew: a chain of subqueries, one for each rule, each replacing
columns by what the ones before left.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import impute as I
from tidemark.plans.imputation_sql import BY_HAND, COLUMNS
from tidemark.plans.registry import query
from tidemark.plans.totals import table

#: Columns of text; all others are whole numbers.
_TEXT = {"tm_gm_dr_strt_fld_pos", "tm_gm_dr_res_secondary"}


def _columns(rules: I.Table) -> list[str]:
    """The columns that the rules read or fill, in the order in which they are named."""
    named = [c for r in rules.rules for c in (*r.needs, *r.columns, *re.findall(r"\b[a-z]\w*_\w+\b", r.mask))]
    return [c for c in dict.fromkeys(named) if c not in rules.indicators]


def _given(i: int, column: str) -> str:
    """SQL of a column's value before imputation: null in a quarter of the rows, else -1, 0, 1 or 2."""
    value = f"(o_orderkey + o_custkey * 3 + {i} * {i}) % 4 - 1"
    value = f"CAST({value} AS STRING)" if column in _TEXT else f"CAST({value} AS INT)"
    return f"CASE WHEN (o_orderkey * 7 + o_custkey * 13 + {i} * 5 + (o_orderkey - o_orderkey % 64) / 64 * {i}) % 4 > 0 THEN {value} END"


def _sql(rules: I.Table) -> str:
    columns = _columns(rules)
    known = ["o_orderkey", *columns]
    start = ", ".join(f"{_given(i, c)} AS {c}" for i, c in enumerate(columns))
    steps = [f"r0 AS (SELECT o_orderkey, {start}{''.join(f', 0 AS {c}' for c in rules.indicators)} FROM orders)"]
    for rule in rules.rules:
        if not {*rule.needs} <= {*known}:
            continue
        own = [c for c in (rule.columns or known) if c in known]
        nulls = [f"{c} IS NULL" for c in own]
        mask = {"": "true", "all null": " AND ".join(nulls), "any null": " OR ".join(nulls)}.get(rule.mask, f"coalesce({rule.mask}, false)")
        hits = [f"({mask})" if rule.overwrite else f"(({mask}) AND {c} IS NULL)" for c in own]
        fill = f"'{rule.fill}'" if isinstance(rule.fill, str) else str(rule.fill)
        new = [f"CASE WHEN {h} THEN {f'CAST({fill} AS VARCHAR)' if c in _TEXT else fill} ELSE {c} END AS {c}" for c, h in zip(own, hits, strict=True) if c != "o_orderkey"]
        if rule.indicator:
            new.append(f"CASE WHEN {f'({mask})' if rule.when == I.MASKED else ' OR '.join(hits)} THEN 1 ELSE {rule.indicator} END AS {rule.indicator}")
        steps.append(f"r{len(steps)} AS (SELECT * REPLACE ({', '.join(new)}) FROM r{len(steps) - 1})")
    return f"WITH {', '.join(steps)} SELECT * FROM r{len(steps) - 1}"


def _by_hand(name: str) -> str:
    start = ", ".join(f"{_given(i, c)} AS {c}" for i, c in enumerate(COLUMNS[name]))
    return f"WITH given AS (SELECT o_orderkey, {start} FROM orders) {BY_HAND[name]}"


def _register(name: str, rules: I.Table) -> None:
    columns = COLUMNS.get(name) or _columns(rules)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, "orders").select("o_orderkey", *[F.expr(_given(i, c)).alias(c) for i, c in enumerate(columns)])
        return I.impute(rows, rules)

    query(_by_hand(name) if name in BY_HAND else _sql(rules), f"impute_{name}")(run)


for _name, _rules in I.TABLES.items():
    _register(_name, _rules)
