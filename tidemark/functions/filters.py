"""Row filters, projections and the grammar of period filters."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar


def periods(spec: str | None) -> list[int] | None:
    """``2024``, ``2022,2024`` or ``2022-2024``, also mixed, as sorted numbers; nothing means all.

    Raises ValueError for anything else, and for a range that runs backwards.
    """
    if spec is None or not spec.strip():
        return None
    found: set[int] = set()
    for item in spec.split(","):
        bounds = re.fullmatch(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?", item)
        if not bounds:
            raise ValueError(f"not a period or range: {item!r}")
        first, last = int(bounds[1]), int(bounds[2] or bounds[1])
        if last < first:
            raise ValueError(f"the range {item!r} runs backwards")
        found.update(range(first, last + 1))
    return sorted(found)


def in_periods(x: Column, spec: str | None) -> Column:
    """The predicate of a period filter; consecutive numbers become one range, which reaches the scan."""
    wanted = periods(spec)
    if wanted is None:
        return F.lit(True)
    x = x.cast("int")
    return x.between(wanted[0], wanted[-1]) if len(wanted) == wanted[-1] - wanted[0] + 1 else x.isin(wanted)


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of ``names`` that ``df`` has, in their order."""
    return [c for c in names if c in df.columns]


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns by name; absent ones are skipped."""
    return df.select(*[F.col(f"`{c}`") for c in present(df, names)])


def ensure_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """``df`` with typed nulls for the columns that it lacks."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items() if c not in df.columns})


def rename_prefix(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnsRenamed({c: new + c[len(old) :] for c in df.columns if c.startswith(old)})


def order_columns(df: DataFrame, first: Sequence[str], last: Sequence[str] = ()) -> DataFrame:
    """Named columns at the front and the end, the others between as they were."""
    ends = {*first, *last}
    return project(df, [*first, *[c for c in df.columns if c not in ends], *last])


def choose(cases: Sequence[tuple[Column, Column]], default: Column | None = None) -> Column:
    """The value of the first case whose condition is true."""
    out = F.when(cases[0][0], cases[0][1])
    for condition, value in cases[1:]:
        out = out.when(condition, value)
    return out if default is None else out.otherwise(default)


def either(names: Sequence[str], value: str) -> Column:
    """Whether one of several columns has a value; nulls are no match."""
    return F.coalesce(F.array_contains(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in names]), value), F.lit(False))


def drop_header_rows(df: DataFrame, column: str, header: str, pattern: str | None = None) -> DataFrame:
    """Rows without repeated headers, totals that fit ``pattern``, and rows with nothing in them."""
    value = F.coalesce(F.trim(F.col(column).cast("string")), F.lit(""))
    df = df.where(value != header)
    return (df.where(~value.rlike(pattern)) if pattern else df).dropna(how="all")


def not_among(x: Column, values: Sequence[str]) -> Column:
    """True for values outside the list, and for null."""
    return F.coalesce(~x.isin(*values), F.lit(True))


def result_label(home: Column, away: Column) -> Column:
    """home_win, away_win, tie, or null while a score is missing."""
    return choose([(home > away, F.lit("home_win")), (away > home, F.lit("away_win")), (home == away, F.lit("tie"))])


def home_away(winner: Column, loser: Column, mark: Column) -> tuple[Column, Column]:
    """(home, away) of a game in a winner-loser list in which ``@`` marks a win away from home."""
    away_win = F.coalesce(F.trim(mark) == "@", F.lit(False))
    return F.when(away_win, loser).otherwise(winner), F.when(away_win, winner).otherwise(loser)


def week_in_season(x: Column, last: int = 18) -> Column:
    """A regular week; 0 stands for the whole season and later ones for the playoffs."""
    return F.coalesce(scalar.whole(x.cast("string")).between(1, last), F.lit(False))


def split_by_years(df: DataFrame, column: str, train: Sequence[int], test: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Rows to learn from and rows to test on; ValueError if a year is in both."""
    if both := {*train} & {*test}:
        raise ValueError(f"in both parts: {sorted(both)}")
    return df.where(F.col(column).isin(*train)), df.where(F.col(column).isin(*test))


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """All columns but those named; absent ones are skipped."""
    return df.drop(*present(df, names))


def with_cells(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is null or blank."""
    filled = [scalar.text(F.col(c).cast("string")).isNotNull() for c in names]
    return df.where(F.forall(F.array(*filled), lambda x: x)) if filled else df


def informed(df: DataFrame, required: Sequence[str], one_of: Sequence[str]) -> DataFrame:
    """Rows with all of the ``required`` cells and at least one of the others."""
    some = F.exists(F.array(*[scalar.text(F.col(c).cast("string")).isNotNull() for c in one_of]), lambda x: x)
    return with_cells(df, required).where(some)


def page(df: DataFrame, order: Sequence[Column | str], size: int, offset: int = 0) -> DataFrame:
    """``size`` rows after the first ``offset`` in a total order; every partition passes on no more than both together."""
    return df.orderBy(*order).offset(offset).limit(size)


def hash_sample(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """``size`` rows by the least digests of seed and key: the same rows on every run, however the table is laid out."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(size)


#: For each game day the weekdays whose columns give the practice reports, by the report's own column.
PRACTICE = {
    "Thursday": {"wed": "Mon", "thurs": "Tue", "fri": "Wed"},
    "Sunday": {"wed": "Wed", "thurs": "Thu", "fri": "Fri"},
    "Monday": {"thurs": "Thu", "fri": "Fri", "sat": "Sat"},
}


def game_day(columns: Sequence[str]) -> str:
    """The game day of a report by the weekdays that it lists."""
    if {"Mon", "Tue"} <= {*columns}:
        return "Thursday"
    return "Monday" if "Sat" in columns else "Sunday"


def practice_columns(df: DataFrame) -> DataFrame:
    """``df`` with game_day and {wed,thurs,fri,sat}_practice_status instead of its weekday columns.

    A dash in brackets means that a player has no designation; blanks and absent days are null.
    """
    day = game_day(df.columns)
    found = {}
    for slot in ("wed", "thurs", "fri", "sat"):
        source = PRACTICE[day].get(slot)
        value = scalar.text(F.col(source)) if source in df.columns else F.lit(None).cast("string")
        found[f"{slot}_practice_status"] = F.when(value == "(-)", "No_Designation").otherwise(value)
    return without(df.withColumns({**found, "game_day": F.lit(day)}), ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat"])
