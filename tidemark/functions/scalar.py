"""Scalar functions on columns: text, dates, durations, numbers and arrays. All stay in the JVM; bad input gives null."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTINEL = -999
SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")


def text(x: Column | str) -> Column:
    """A trimmed string, null if blank."""
    x = (F.col(x) if isinstance(x, str) else x).cast("string")
    return F.nullif(F.trim(x), F.lit(""))


def part(x: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


def number(x: Column) -> Column:
    """A double from text with thousands separators, null if it is none; never NaN or infinite."""
    value = F.regexp_replace(text(x), ",", "").try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def whole(x: Column) -> Column:
    """An integer from text such as ``3`` or ``3.0``, cut towards zero."""
    value = number(x)
    return F.when(F.abs(value) < 2.0**31, value.cast("int"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating columns with null for NaN."""
    kinds = {n for n, t in df.dtypes if t in ("double", "float")}
    return df.select(*[F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def clean_name(name: str) -> str:
    """A column name in lower case with ``_`` for blanks and nothing but letters, digits and ``_``."""
    return re.sub(r"[^a-z0-9_]", "", re.sub(r"\s+", "_", name.strip().lower()))


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(clean_name, df.columns))


def year_in(x: Column) -> Column:
    """The first year from 2000 to 2099 in a text or path."""
    return part(x, r"(20\d{2})").cast("int")


def mapped(x: Column, table: Mapping[str, str], keep: bool = True) -> Column:
    """``x`` replaced by a small fixed table; what the table lacks stays, or becomes null."""
    if not table:
        return x if keep else F.lit(None).cast("string")
    found = F.create_map(*[F.lit(v) for pair in table.items() for v in pair])[x]
    return F.coalesce(found, x) if keep else found


def guid(*parts: Column) -> Column:
    """MD5 of the parts joined by ``_``; a null part is empty."""
    return F.md5(F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def plain_name(x: Column) -> Column:
    """A name in lower case without brackets, periods, marks and generational suffix."""
    x = F.regexp_replace(F.lower(text(x)), r"\([^)]*\)|[*+.]", "")
    return text(F.regexp_replace(F.regexp_replace(x, rf"[\s,]+({'|'.join(SUFFIXES)})\s*$", ""), r"\s+", " "))


def name_variants(x: Column) -> Column:
    """The spellings under which a name may be listed, sorted: with and without suffix, periods and hyphens."""
    low = F.lower(F.regexp_replace(text(x), r"\([^)]*\)|[*+]", ""))
    low = text(F.regexp_replace(low, r"\s+", " "))
    base = plain_name(x)
    first = F.regexp_replace(base, r"^(\w)(\w) ", "$1.$2. ")
    found = F.array(low, base, first, F.regexp_replace(base, "-", " "), F.regexp_replace(base, r"-\S+", ""))
    return F.array_sort(F.array_distinct(F.array_compact(found)))


def on_reserve(x: Column) -> Column:
    """1 if a name carries the mark of the injured reserve, else 0."""
    return F.when(F.coalesce(x, F.lit("")).rlike(r"(?i)\(?\bIR\b\)?\s*$"), 1).otherwise(0)


def height_inches(x: Column) -> Column:
    """``6-2`` or ``6' 2"`` in inches."""
    pattern = r"(\d+)\s*['-]\s*(\d+)"
    return part(x, pattern, 1).cast("int") * 12 + part(x, pattern, 2).cast("int")


def leading_number(x: Column) -> Column:
    """The first digits of a text, as of ``300 lbs`` or ``5th season``; a rookie has 0."""
    return F.when(F.lower(text(x)).startswith("r"), F.lit(0)).otherwise(part(x, r"(\d+)").try_cast("int"))


def draft(x: Column) -> Column:
    """Struct (team, round, pick, year) of ``Team / 1st / 5th pick / 2020`` or ``2020: Rd 1, Pk 5 (ABC)``."""
    slots, pattern = F.split(x, r"\s*/\s*"), r"(\d{4}): Rd (\d+), Pk (\d+) \((\w+)\)"
    long = x.contains("Rd")

    def digits(i: int) -> Column:
        return part(F.get(slots, F.lit(i)), r"(\d+)").try_cast("int")

    return F.struct(
        F.when(long, part(x, pattern, 4)).otherwise(text(F.get(slots, F.lit(0)))).alias("team"),
        F.when(long, part(x, pattern, 2).cast("int")).otherwise(digits(1)).alias("round"),
        F.when(long, part(x, pattern, 3).cast("int")).otherwise(digits(2)).alias("pick"),
        F.when(long, part(x, pattern, 1).cast("int")).otherwise(digits(3)).alias("year"),
    )


def date_of(x: Column, *formats: str) -> Column:
    """A date by the first format that fits."""
    return F.coalesce(*[F.try_to_timestamp(text(x), F.lit(f)).cast("date") for f in formats or ("M/d/yyyy", "yyyy-MM-dd")])


def swap_day_month(x: Column) -> Column:
    """``d/m/y`` as ``m/d/y``."""
    return F.when(x.rlike(r"^\d+/\d+/\d+$"), F.regexp_replace(x, r"^(\d+)/(\d+)/", "$2/$1/"))


def days_apart(a: Column, b: Column, most: int = 1) -> Column:
    """Whether two dates are at most so many days apart; false if either is null."""
    return F.coalesce(F.abs(F.datediff(a, b)) <= most, F.lit(False))


def clock_24h(x: Column) -> Column:
    """``8:20PM`` or ``8PM`` as ``HH:mm:ss``."""
    hour, minute = part(x, r"^\s*(\d{1,2})").cast("int"), F.coalesce(part(x, r":(\d{2})"), F.lit("00"))
    late = F.upper(x).contains("PM")
    return F.when(hour.between(1, 12), F.concat(F.lpad((hour % 12 + F.when(late, 12).otherwise(0)).cast("string"), 2, "0"), F.lit(":"), minute, F.lit(":00")))


def seconds(x: Column) -> Column:
    """``MM:SS`` or ``H:MM:SS`` as seconds."""
    bits = F.transform(F.split(x, ":"), lambda b: b.try_cast("int"))
    fits = F.size(bits).between(2, 3) & F.forall(bits, lambda b: b.isNotNull())
    return F.when(fits, F.aggregate(bits, F.lit(0), lambda s, b: s * 60 + b))


def to_zone(ts: Column, source: Column | str, target: str = "America/New_York") -> Column:
    """A wall clock time of one zone as that of another."""
    return F.convert_timezone(F.lit(source) if isinstance(source, str) else source, F.lit(target), ts)


def split_numbers(x: Column, n: int, sep: str = "-") -> Column:
    """The first ``n`` numbers of ``12-3-1``; missing and bad ones are null."""
    bits = F.split(x, sep)
    return F.array(*[F.get(bits, F.lit(i)).try_cast("int") for i in range(n)])


def field_position(x: Column) -> Column:
    """Struct (side, yard) of ``PIT 35``."""
    return F.struct(part(x, r"^\s*([A-Za-z]+)").alias("side"), part(x, r"(\d+(?:\.\d+)?)\s*$").try_cast("double").alias("yard"))


def primary_secondary(x: Column) -> Column:
    """Struct (primary, secondary) of a list such as ``Fumble, Safety``."""
    bits = F.split(x, r"\s*,\s*")
    return F.struct(text(F.get(bits, F.lit(0))).alias("primary"), text(F.get(bits, F.lit(1))).alias("secondary"))


def quarter(x: Column) -> Column:
    """1 to 5; overtime, however long, is 5."""
    n = F.when(F.upper(text(x)).startswith("OT"), F.lit(5)).otherwise(whole(x))
    return F.least(n, F.lit(5))


def betting_line(x: Column) -> Column:
    """Struct (name, value) of ``Team -3.5``; a pick'em has the value 0."""
    value = F.when(F.lower(x).contains("pick"), F.lit(0.0)).otherwise(part(x, r"(-?\d+(?:\.\d+)?)\s*$").try_cast("double"))
    return F.struct(text(F.regexp_replace(x, r"\s*-?\d+(?:\.\d+)?\s*$", "")).alias("name"), value.alias("value"))


def with_remark(x: Column) -> Column:
    """Struct (value, remark) of ``46.5 (over)`` or ``Team (deferred)``."""
    return F.struct(text(F.regexp_replace(x, r"\([^)]*\)", "")).alias("value"), part(x, r"\(([^)]*)\)").alias("remark"))


def percent_always(x: Column) -> Column:
    """Any number as hundredths, to four places."""
    return F.round(number(F.regexp_replace(x, "%", "")) / 100, 4)


def percent_marked(x: Column) -> Column:
    """Hundredths only with a percent sign."""
    return F.when(x.contains("%"), number(F.regexp_replace(x, "%", "")) / 100).otherwise(number(x))


def percent_guessed(x: Column) -> Column:
    """Hundredths with a percent sign or above 1."""
    value = number(F.regexp_replace(x, "%", ""))
    return F.when(x.contains("%") | (value > 1), value / 100).otherwise(value)


def decimal_7_4(x: Column) -> Column:
    """DECIMAL(7,4); larger numbers become the largest, those too small become null."""
    return F.least(F.round(x.cast("double"), 4), F.lit(999.9999)).try_cast("decimal(7,4)")


def coordinate(x: Column) -> Column:
    """Struct (value, direction) of ``-84.4° W``."""
    return F.struct(part(x, r"(-?\d+(?:\.\d+)?)").try_cast("double").alias("value"), F.upper(part(x, r"([NSEWnsew])\s*$")).alias("direction"))


def flag(x: Column, yes: Iterable[str] = ("1", "true", "yes", "ir")) -> Column:
    """1 for a word that means yes, else 0."""
    return F.when(F.lower(F.trim(x.cast("string"))).isin(*yes), 1).otherwise(0)


def strip_marks(x: Column, marks: str = "*+") -> Column:
    """``x`` without such characters at its end."""
    return F.regexp_replace(x, f"[{re.escape(marks)}\\s]+$", "")


def week_set(x: Column) -> Column:
    """Sorted distinct integers of ``3,1,2``; null and empty give an empty array."""
    bits = F.transform(F.split(F.coalesce(x, F.lit("")), ","), lambda b: F.trim(b).try_cast("int"))
    return F.array_sort(F.array_distinct(F.array_compact(bits)))


def week_text(x: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(x), lambda w: w.cast("string")), ",")


def decimal_places(x: Column) -> Column:
    """Digits after the point of a number in text, without trailing zeros."""
    return F.length(F.regexp_replace(F.regexp_extract(x, r"^-?\d*\.(\d+)$", 1), "0+$", ""))


def all_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in names])


def any_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in names])


def normal_college(x: Column) -> Column:
    """A college's name without case, punctuation and the words that only some lists carry."""
    x = F.regexp_replace(F.lower(text(x)), r"[^a-z ]", " ")
    x = F.regexp_replace(x, r"\b(university|univ|college|of|the|at)\b", " ")
    return text(F.regexp_replace(x, r"\s+", " "))


def same_college(a: Column, b: Column, aliases: Mapping[str, str] | None = None) -> Column:
    """Equal by normal name or alias, or one within the other."""
    a, b = (mapped(normal_college(c), aliases or {}) for c in (a, b))
    return F.coalesce((a == b) | a.contains(b) | b.contains(a), F.lit(False))


def week_algebra(a: Column, b: Column) -> Column:
    """Struct (both, common, only_first) of two texts of weeks, as sorted texts: union, intersection and difference."""
    a, b = week_set(a), week_set(b)
    return F.struct(
        week_text(F.array_union(a, b)).alias("both"), week_text(F.array_intersect(a, b)).alias("common"), week_text(F.array_except(a, b)).alias("only_first")
    )


def kind_of_text(x: Column) -> Column:
    """``integer``, ``decimal``, ``date``, ``text`` or null: what a text looks like."""
    x = text(x)
    return (
        F.when(x.rlike(r"^[+-]?\d+$"), "integer").when(x.rlike(r"^[+-]?\d*\.\d+$"), "decimal").when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), "date").when(x.isNotNull(), "text")
    )


#: A word of a name in any script: a capital, letters, and parts joined by an apostrophe or a hyphen. Nothing taken is given back.
_NAME_WORD = r"\p{Lu}\p{L}*+(?:['’-]\p{L}++)*+"
#: A name: initials and a word, or two words; further words; a suffix with a point.
_NAME = rf"(?:(?:\p{{Lu}}\. ?)+{_NAME_WORD}|{_NAME_WORD} {_NAME_WORD})(?: (?![JS]r\.){_NAME_WORD})*+(?: [JS]r\.)?"


def players_in_play(x: Column) -> Column:
    """Array of the players that a play's text names: who begins it, and who a pass goes to or is meant for, each once.

    A name is one or more initials and a capitalised word, or two such words, with any that follow and
    ``Jr.`` or ``Sr.``; a pass goes to the name after the first ``to`` or ``for`` behind ``pass`` that has
    one. Letters are those of any script, runs of blanks are one, and what stands in brackets does not
    count. Null and texts without names give an empty array.
    """
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r"\([^)]*\)", " "), r"\s+", " "))
    return F.array_distinct(F.regexp_extract_all(clean, F.lit(rf"(?:^|\bpass\b.*?\b(?:to|for) )({_NAME})"), F.lit(1)))


def team_of_week(week: Column, current: Column, former: Column, first: Column, spans: Mapping[str, Column]) -> Column:
    """The team of a player in a week, from the teams of a season and the weeks between which they held.

    ``spans`` has former_first, former_last, first_last and played_first (the first week played); a
    missing bound is week 1, 18, or with a first team 12, and 6. A player who began with the former
    team was there from the start.
    """
    former, first = text(former), text(first)
    start, end = F.coalesce(spans["former_first"], F.lit(1)), F.coalesce(spans["former_last"], F.lit(18))
    two = F.when((start == spans["played_first"]) & (week <= end), former).when(week.between(start, end), former).otherwise(current)
    early, middle = F.coalesce(spans["first_last"], F.lit(6)), F.coalesce(spans["former_last"], F.lit(12))
    three = F.when(week <= early, first).when(week <= middle, former).otherwise(current)
    return F.when(former.isNull(), current).when(first.isNull(), two).otherwise(three)
