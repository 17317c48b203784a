"""Every query of the catalog against its SQL, and the driver's contract."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from tidemark.plans import registry

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, sf, oracle, same, name):
    same(registry.queries()[name](spark, sf), oracle(registry.oracle_sql()[name]))


def test_queries_without_sql_have_rows(spark, sf):
    for name in registry.queries().keys() - registry.oracle_sql().keys():
        assert registry.queries()[name](spark, sf).count() > 0, name


def test_entry(spark):
    import __spark_entry__ as entry

    found = entry.entry(spark)
    assert {"l_suppkey", "season", "month", "price_per_unit"} <= {*found.columns}
    assert found.limit(1).count() == 1
    assert {*entry.oracle_sql()} <= {*entry.queries()}


def test_nothing_outside_imports_the_training_data_operators():
    for path in (ROOT / "tidemark").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"tidemark\.llm|from tidemark import .*llm", path.read_text()), path


def test_a_name_is_registered_once():
    with pytest.raises(ValueError, match="twice"):
        registry.query(name="cumulative_all_months")(lambda spark, sf: None)


def test_filter_and_columns_reach_the_scan(spark, sf):
    plan = registry.queries()["cumulative_supplier_month"](spark, sf)._jdf.queryExecution().toString()
    scan = re.findall(r"ReadSchema: (\S+)", plan)[-1]
    assert "l_shipdate" in scan and "l_tax" not in scan and "l_partkey" not in scan
