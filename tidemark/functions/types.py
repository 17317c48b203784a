"""What type a column of text holds, and what a declared type allows.

The types found form a lattice: whole numbers within decimals, decimals and dates within text. All that
is needed to place a column are maxima and counts, so columns are judged by aggregates that merge.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds of declared types by their first word, and digits that whole numbers of a type hold for sure.
KINDS = {
    "tinyint": "integer", "smallint": "integer", "mediumint": "integer", "int": "integer", "integer": "integer", "bigint": "integer", "decimal": "decimal", "numeric": "decimal",
    "float": "float", "double": "float", "real": "float", "date": "date", "datetime": "time", "timestamp": "time", "time": "time", "varchar": "text", "char": "text", "text": "text", "enum": "text",
}
DIGITS = {"tinyint": 2, "smallint": 4, "mediumint": 6, "int": 9, "integer": 9, "bigint": 18}


@dataclass(frozen=True)
class Declared:
    """A declared type: its kind, the digits before and after the point that it holds, and the length of its texts; null is no bound."""

    kind: str
    digits: int | None = None
    scale: int | None = None
    length: int | None = None


def declared(ddl: str) -> Declared:
    """``DECIMAL(7,4)``, ``FLOAT(7,4)``, ``INT UNSIGNED``, ``VARCHAR(50)``, ``ENUM('a','b')`` and the like; ValueError for others."""
    found = re.match(r"\s*([a-z]+)\s*(?:\(([^)]*)\))?", ddl.lower())
    if not found or found[1] not in KINDS:
        raise ValueError(f"no type {ddl!r}")
    word, inside = found[1], found[2] or ""
    kind = KINDS[word]
    numbers = [int(x) for x in re.findall(r"\d+", inside)] if word != "enum" else []
    if kind == "integer":
        return Declared(kind, DIGITS[word], 0)
    if kind in ("decimal", "float") and numbers:
        scale = numbers[1] if len(numbers) > 1 else 0
        return Declared(kind, numbers[0] - scale, scale)
    if kind == "decimal":
        return Declared(kind, 10, 0)
    if word == "enum":
        return Declared(kind, length=max((len(x) for x in re.findall(r"'([^']*)'", inside)), default=0))
    return Declared(kind, length=numbers[0] if numbers and kind == "text" else None)


_WHOLE, _POINT, _DATE = r"^[+-]?\d+$", r"^[+-]?\d*\.\d+$", r"^\d{4}-\d{2}-\d{2}$"


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n, n_integer, n_decimal, n_date, digits, scale, length) of columns as text, in one pass.

    Blank texts are missing and count nowhere. ``digits`` are those before the point without leading
    zeros, ``scale`` those after it without trailing ones, over all numbers; ``length`` is over all texts.
    """
    aggregates, rows = [], []
    for i, c in enumerate(columns):
        x = F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit(""))
        before = F.length(F.regexp_replace(F.regexp_extract(x, r"^[+-]?(\d*)", 1), "^0+", ""))
        after = F.length(F.regexp_replace(F.regexp_extract(x, r"\.(\d+)$", 1), "0+$", ""))
        number = x.rlike(_WHOLE) | x.rlike(_POINT)
        own = {
            "n": F.count(x), "n_integer": F.count_if(x.rlike(_WHOLE)), "n_decimal": F.count_if(x.rlike(_POINT)), "n_date": F.count_if(x.rlike(_DATE)),
            "digits": F.max(F.when(number, before)), "scale": F.max(F.when(number, after)), "length": F.max(F.length(x)),
        }
        aggregates += [v.alias(f"{i}_{k}") for k, v in own.items()]
        rows.append(F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{k}").alias(k) for k in own]))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def recommended(found: DataFrame) -> DataFrame:
    """``found`` of ``profile`` with the narrowest type that holds all values: kind and recommended; both null without values.

    Decimals that need more than 38 digits are DOUBLE, whole numbers of more than 18 digits decimals.
    """
    n, digits, scale = F.col("n"), F.greatest(F.coalesce("digits", F.lit(0)), F.lit(1)), F.coalesce("scale", F.lit(0))
    numbers = F.col("n_integer") + F.col("n_decimal")
    kind = F.when(n == 0, None).when((numbers == n) & (scale == 0), "integer").when(numbers == n, "decimal").when(F.col("n_date") == n, "date").otherwise("text")
    whole = F.when(digits <= 9, "INT").when(digits <= 18, "BIGINT").when(digits <= 38, F.concat(F.lit("DECIMAL("), digits, F.lit(",0)"))).otherwise("DOUBLE")
    point = F.when(digits + scale <= 38, F.concat(F.lit("DECIMAL("), digits + scale, F.lit(","), scale, F.lit(")"))).otherwise("DOUBLE")
    ddl = F.when(kind == "integer", whole).when(kind == "decimal", point).when(kind == "date", "DATE").when(kind == "text", F.concat(F.lit("VARCHAR("), F.col("length"), F.lit(")")))
    return found.withColumn("kind", kind).withColumn("recommended", ddl)


def compared(found: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """(column, declared, kind, recommended, verdict) for the columns of ``found`` that ``types`` declares.

    ``ok``, ``too narrow`` if values lose digits or are cut, ``other kind`` if they do not belong to it at
    all, ``no values``. A decimal column may hold whole numbers, a text column anything.
    """
    out = []
    for column, ddl in types.items():
        d = declared(ddl)
        fits = {"integer": ["integer"], "decimal": ["integer", "decimal"], "float": ["integer", "decimal"], "date": ["date"], "time": ["date"], "text": ["integer", "decimal", "date", "text"]}[d.kind]
        narrow = [F.coalesce(F.col(name), F.lit(0)) > most for name, most in (("digits", d.digits), ("scale", d.scale), ("length", d.length)) if most is not None]
        short = narrow[0] if narrow else F.lit(False)
        for more in narrow[1:]:
            short = short | more
        verdict = F.when(F.col("kind").isNull(), "no values").when(~F.col("kind").isin(fits), "other kind").when(short, "too narrow").otherwise("ok")
        out.append(F.when(F.col("column") == column, F.struct(F.lit(ddl).alias("declared"), verdict.alias("verdict"))))
    both = F.coalesce(*out)
    return found.where(F.col("column").isin(list(types))).select("column", both["declared"].alias("declared"), "kind", "recommended", both["verdict"].alias("verdict"))
