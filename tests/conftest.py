from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    session = local_session(4, 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return SF


@pytest.fixture(scope="session")
def oracle():
    """DuckDB over the small tables; ``oracle(sql)`` gives rows as dicts."""
    import duckdb

    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")

    def run(sql: str) -> list[dict]:
        found = con.execute(sql)
        names = [d[0] for d in found.description]
        return [dict(zip(names, row, strict=True)) for row in found.fetchall()]

    return run


def plain(rows: list[dict]) -> list[tuple]:
    """Rows as sorted tuples of text, columns by name; doubles to nine digits."""

    def text(x: object) -> str:
        return "null" if x is None else f"{x:.9g}" if isinstance(x, float) else str(x)

    return sorted(tuple(text(r[k]) for k in sorted(r)) for r in rows)


@pytest.fixture(scope="session")
def same():
    def check(df, expected: list[dict]) -> None:
        got = [r.asDict() for r in df.collect()]
        if expected:
            assert sorted(df.columns) == sorted(expected[0])
        assert plain(got) == plain(expected)

    return check
