"""Rates and ratings recomputed from totals; a zero or null denominator gives null.

A pack is an ordered mapping of column name to expression. ``with_metrics`` adds its columns one
after another, so that an expression may use the columns before it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Pack = Mapping[str, Column]


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(top: Column | str, bottom: Column | str, default: float | None = None) -> Column:
    """``top / bottom`` in double precision, ``default`` where either is null or the bottom is zero."""
    value = F.try_divide(_col(top).cast("double"), _col(bottom).cast("double"))
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def clipped(x: Column, low: float, high: float) -> Column:
    """``x`` within bounds; null stays null."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high))))


def passer_rating(completed: Column | str, attempts: Column | str, yards: Column | str, scores: Column | str, lost: Column | str) -> Column:
    """The passer rating, 0 to 158.3; null without attempts. The coefficients are fixed values of the public formula."""
    per = {k: ratio(v, attempts) for k, v in (("completed", completed), ("yards", yards), ("scores", scores), ("lost", lost))}
    parts = [
        (per["completed"] - 0.3) * 5,
        (per["yards"] - 3) * 0.25,
        per["scores"] * 20,
        2.375 - per["lost"] * 25,
    ]
    total = sum((clipped(p, 0, 2.375) for p in parts[1:]), clipped(parts[0], 0, 2.375))
    return F.when(_col(attempts) > 0, total / 6 * 100)


def receiving_pack(p: str = "rec_", games: str = "game_count") -> dict[str, Column]:
    """Rates of receivers from total columns named with the prefix ``p``."""
    return {
        f"{p}adot": ratio(f"{p}air_yds", f"{p}tgt"),
        f"{p}catch_pct": ratio(f"{p}rec", f"{p}tgt"),
        f"{p}yds_rec": ratio(f"{p}yds", f"{p}rec"),
        f"{p}yds_tgt": ratio(f"{p}yds", f"{p}tgt"),
        f"{p}ypg": ratio(f"{p}yds", games),
        f"{p}air_yds_rec": ratio(f"{p}air_yds", f"{p}rec"),
        f"{p}yac_rec": ratio(f"{p}yac", f"{p}rec"),
        f"{p}brkn_tkl_rec": ratio(f"{p}brkn_tkl", f"{p}rec"),
        f"{p}drp_pct": ratio(f"{p}drp", f"{p}tgt"),
        f"{p}pass_rtg": passer_rating(f"{p}rec", f"{p}tgt", f"{p}yds", f"{p}td", f"{p}int"),
    }


def defence_pack(p: str = "def_", games: str = "game_count") -> dict[str, Column]:
    """Rates of a defence; its sack rate is sacks by pressures."""
    return {
        f"{p}cmp_pct": ratio(f"{p}cmp", f"{p}tgt"),
        f"{p}yds_cmp": ratio(f"{p}yds", f"{p}cmp"),
        f"{p}yds_tgt": ratio(f"{p}yds", f"{p}tgt"),
        f"{p}adot": ratio(f"{p}air_yds", f"{p}tgt"),
        f"{p}yac_cmp": ratio(f"{p}yac", f"{p}cmp"),
        f"{p}mtkl_pct": ratio(f"{p}mtkl", F.col(f"{p}comb_tkl") + F.col(f"{p}mtkl")),
        f"{p}sk_pct": ratio(f"{p}sk", f"{p}prss"),
        f"{p}int_pct": ratio(f"{p}int", f"{p}tgt"),
        f"{p}tkl_pg": ratio(f"{p}comb_tkl", games),
        f"{p}sk_pg": ratio(f"{p}sk", games),
        f"{p}prss_pg": ratio(f"{p}prss", games),
        f"{p}to": F.coalesce(F.col(f"{p}int"), F.lit(0)) + F.coalesce(F.col(f"{p}fmbl_rec"), F.lit(0)),
        f"{p}to_pg": ratio(f"{p}to", games),
        f"{p}pass_rtg": passer_rating(f"{p}cmp", f"{p}tgt", f"{p}yds", f"{p}td", f"{p}int"),
    }


def pass_defence_pack(p: str = "pass_", games: str = "game_count") -> dict[str, Column]:
    """Rates of a pass defence; its sack rate is sacks by dropbacks."""
    dropbacks = F.col(f"{p}att") + F.col(f"{p}sk")
    net = F.col(f"{p}yds") - F.col(f"{p}sk_yds")
    bonus = F.col(f"{p}td") * 20 - F.col(f"{p}int") * 45
    return {
        f"{p}cmp_pct": ratio(f"{p}cmp", f"{p}att"),
        f"{p}td_pct": ratio(f"{p}td", f"{p}att"),
        f"{p}int_pct": ratio(f"{p}int", f"{p}att"),
        f"{p}yds_att": ratio(f"{p}yds", f"{p}att"),
        f"{p}adj_yds_att": ratio(F.col(f"{p}yds") + bonus, f"{p}att"),
        f"{p}yds_cmp": ratio(f"{p}yds", f"{p}cmp"),
        f"{p}ypg": ratio(f"{p}yds", games),
        f"{p}sk_pct": ratio(f"{p}sk", dropbacks),
        f"{p}net_yds_att": ratio(net, dropbacks),
        f"{p}adj_net_yds_att": ratio(net + bonus, dropbacks),
        f"{p}rtg": passer_rating(f"{p}cmp", f"{p}att", f"{p}yds", f"{p}td", f"{p}int"),
    }


def per_game(names: Mapping[str, tuple[str, str]], places: int = 4) -> dict[str, Column]:
    """Rounded ratios of single games in which a missing number counts as zero: name -> (top, bottom)."""
    return {k: F.round(ratio(F.coalesce(F.col(a), F.lit(0)), F.coalesce(F.col(b), F.lit(0))), places) for k, (a, b) in names.items()}


def game_passing_pack(p: str = "plyr_gm_pass_", places: int = 4) -> Pack:
    """The nine passing rates of a single game, a missing number counting as zero; null where there is nothing to divide by."""
    cmp, att, yds, td, intercepted, sacks, lost = (F.coalesce(F.col(f"{p}{c}"), F.lit(0)) for c in ("cmp", "att", "yds", "td", "int", "sk", "sk_yds"))
    dropbacks, bonus = att + sacks, 20 * td - 45 * intercepted
    parts = {
        "cmp_pct": (cmp, att), "td_pct": (td, att), "int_pct": (intercepted, att), "yds_att": (yds, att), "adj_yds_att": (yds + bonus, att), "yds_cmp": (yds, cmp),
        "sk_pct": (sacks, dropbacks), "net_yds_att": (yds - lost, dropbacks), "adj_net_yds_att": (yds - lost + bonus, dropbacks),
    }
    return {f"{p}{name}": F.round(F.when(bottom > 0, ratio(top, bottom)), places) for name, (top, bottom) in parts.items()}


def with_metrics(df: DataFrame, pack: Pack) -> DataFrame:
    """``df`` with the columns of ``pack``, each able to use those before it."""
    for name, expr in pack.items():
        df = df.withColumn(name, expr)
    return df


def regression_metrics(actual: Column | str, predicted: Column | str) -> dict[str, Column]:
    """mae, rmse, r2 and mape (denominator at least 1) as aggregates over rows where both are known."""
    y, p = _col(actual).cast("double"), _col(predicted).cast("double")
    y, p = F.when(p.isNotNull(), y), F.when(y.isNotNull(), p)
    return {
        "mae": F.avg(F.abs(y - p)),
        "rmse": F.sqrt(F.avg((y - p) * (y - p))),
        "r2": 1 - F.try_divide(F.avg((y - p) * (y - p)), F.var_pop(y)),
        "mape": F.avg(F.abs(y - p) / F.greatest(y, F.lit(1.0))) * 100,
    }
