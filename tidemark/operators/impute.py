"""Declarative null handling: ordered rules of mask, columns, fill value and indicator.

A rule looks at the columns as the rules before it have left them. Columns that a table lacks are
skipped, and a rule whose mask needs an absent column does nothing. Everything is row-local: no
shuffle, and one projection for each rule, which the optimizer joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import SENTINEL, all_null, any_null

#: When the indicator is set: where a value was filled, or wherever the mask holds.
FILLED, MASKED = "filled", "masked"


@dataclass(frozen=True)
class Rule:
    """``mask`` is SQL over the table's columns, or ``all null`` / ``any null`` of ``columns`` themselves.

    With ``overwrite`` the columns are set wherever the mask holds, null or not. No ``columns``
    means every column but the indicators; no ``mask`` means every row. ``filled`` may name fewer
    columns than the mask looks at. ``needs`` are the columns without which the rule is skipped.
    """

    columns: Sequence[str] = ()
    mask: str = ""
    indicator: str = ""
    needs: Sequence[str] = ()
    fill: object = SENTINEL
    when: str = FILLED
    overwrite: bool = False


@dataclass(frozen=True)
class Table:
    indicators: Sequence[str]
    rules: Sequence[Rule]


def impute(df: DataFrame, table: Table) -> DataFrame:
    """``df`` with the rules of ``table`` applied in order and its indicators as 0 or 1; an indicator stays 1 once set."""
    df = df.withColumns({c: F.lit(0) for c in table.indicators})
    for rule in table.rules:
        if {*rule.needs} <= {*df.columns}:
            df = _apply(df, rule, table.indicators)
    return df


def _apply(df: DataFrame, rule: Rule, indicators: Sequence[str]) -> DataFrame:
    wanted = rule.columns or [c for c in df.columns if c not in indicators]
    columns = [c for c in wanted if c in df.columns]
    if not columns and rule.when == FILLED:
        return df
    mask = _mask(rule.mask, columns)
    hit = {c: mask if rule.overwrite else mask & F.col(c).isNull() for c in columns}
    kinds = dict(df.dtypes)
    new = {c: F.when(h, F.lit(rule.fill).cast(kinds[c])).otherwise(F.col(c)) for c, h in hit.items()}
    if rule.indicator:
        some = mask if rule.when == MASKED else _any(list(hit.values()))
        new[rule.indicator] = F.when(some, 1).otherwise(F.col(rule.indicator))
    return df.withColumns(new)


def _mask(mask: str, columns: Sequence[str]) -> Column:
    if mask in ("", "all null", "any null"):
        return {"": lambda: F.lit(True), "all null": lambda: all_null(columns), "any null": lambda: any_null(columns)}[mask]()
    return F.coalesce(F.expr(mask), F.lit(False))


def _any(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def audit(df: DataFrame) -> DataFrame:
    """(column, n_null, n_sentinel) of every column, in one pass."""
    columns = df.columns
    wide = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{i}n") for i, c in enumerate(columns)],
        *[F.count_if(F.col(c).cast("string").isin(str(SENTINEL), f"{SENTINEL}.0")).alias(f"{i}s") for i, c in enumerate(columns)],
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{i}n").alias("n_null"), F.col(f"{i}s").alias("n_sentinel")) for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows)))


def _nonzero(of: str) -> str:
    """A count that is not zero, a missing one included: what is not known to be zero counts as such."""
    return f"({of} <> 0 OR {of} IS NULL)"


def _zero(of: str, columns: Sequence[str], indicator: str, **more: object) -> Rule:
    """Nulls that follow from a count of zero."""
    return Rule(columns, f"{of} = 0", indicator, (of,), **more)


_ACTIVE = "plyr_gm_def_tgt <> 0 AND plyr_gm_def_cmp <> 0"

#: The columns, masks and fills of each table, in the order in which they apply.
TABLES: dict[str, Table] = {
    "nfl_fastr_wr": Table(
        ["nfl_fastr_missing_nextgen", "nfl_fastr_missing_fastr", "nfl_fastr_wr_no_yac", "nfl_fastr_did_not_qualify"],
        [
            Rule(
                [
                    "plyr_gm_rec_avg_cushion", "plyr_gm_rec_avg_separation", "plyr_gm_rec_avg_yac",
                    "plyr_gm_rec_avg_expected_yac", "plyr_gm_rec_avg_yac_above_expectation",
                    "plyr_gm_rec_pct_share_of_intended_ay",
                ],
                "all null", "nfl_fastr_missing_nextgen",
            ),
            Rule(["plyr_gm_rec_tgt_share", "plyr_gm_rec_epa", "plyr_gm_rec_ay_share", "plyr_gm_rec_wopr", "plyr_gm_rec_racr"], "all null", "nfl_fastr_missing_fastr"),
            Rule(["plyr_gm_rec_avg_expected_yac", "plyr_gm_rec_avg_yac", "plyr_gm_rec_avg_yac_above_expectation"], "", "nfl_fastr_wr_no_yac"),
            Rule(["plyr_gm_rec_epa", "plyr_gm_rec_racr"], "any null", "nfl_fastr_did_not_qualify"),
        ],
    ),
    "plyr_gm_rec": Table(
        ["plyr_gm_rec_no_catches", "plyr_gm_rec_no_brkn_tkl", "plyr_gm_rec_no_drops", "plyr_gm_rec_no_first_dwn"],
        [
            _zero("plyr_gm_rec", ["plyr_gm_rec_first_dwn", "plyr_gm_rec_aybc_route", "plyr_gm_rec_yac_route"], "plyr_gm_rec_no_catches"),
            _zero("plyr_gm_rec_brkn_tkl", ["plyr_gm_rec_brkn_tkl_rec"], "plyr_gm_rec_no_brkn_tkl"),
            Rule(["plyr_gm_rec_first_dwn"], _nonzero("plyr_gm_rec"), "plyr_gm_rec_no_first_dwn", ["plyr_gm_rec"]),
        ],
    ),
    "plyr_rec": Table(
        ["plyr_rec_no_targets", "plyr_rec_no_catches", "plyr_rec_no_brkn_tkl", "plyr_rec_no_positive_yds"],
        [
            _zero(
                "plyr_rec_tgt",
                [
                    "plyr_rec_catch_pct", "plyr_rec_yds_rec", "plyr_rec_succ_rt", "plyr_rec_lng", "plyr_rec_yds_tgt",
                    "plyr_rec_aybc", "plyr_rec_aybc_rec", "plyr_rec_yac", "plyr_rec_yac_rec", "plyr_rec_adot",
                    "plyr_rec_brkn_tkl", "plyr_rec_brkn_tkl_rec", "plyr_rec_drp", "plyr_rec_drp_pct", "plyr_rec_int",
                    "plyr_rec_pass_rtg",
                ],
                "plyr_rec_no_targets",
            ),
            _zero("plyr_rec", ["plyr_rec_yds_rec", "plyr_rec_lng", "plyr_rec_aybc_rec", "plyr_rec_yac_rec", "plyr_rec_brkn_tkl_rec"], "plyr_rec_no_catches"),
            _zero("plyr_rec_brkn_tkl", ["plyr_rec_brkn_tkl_rec"], "plyr_rec_no_brkn_tkl"),
            Rule(["plyr_rec_lng"], f"{_nonzero('plyr_rec')} AND {_nonzero('plyr_rec_tgt')}", "plyr_rec_no_positive_yds", ["plyr_rec", "plyr_rec_tgt"]),
        ],
    ),
    "plyr_gm_def": Table(
        [
            "plyr_gm_def_no_targets", "plyr_gm_def_missing_stats", "plyr_gm_def_no_mtkl", "plyr_gm_def_no_cmp",
            "plyr_gm_def_no_pass_yds",
        ],
        [
            _zero(
                "plyr_gm_def_tgt", [
                    "plyr_gm_def_cmp_pct", "plyr_gm_def_pass_yds", "plyr_gm_def_pass_yds_cmp", "plyr_gm_def_pass_yds_tgt",
                    "plyr_gm_def_pass_td", "plyr_gm_def_pass_rtg", "plyr_gm_def_adot", "plyr_gm_def_ay", "plyr_gm_def_yac",
                ],
                "plyr_gm_def_no_targets", when=MASKED,
            ),
            Rule(
                ["plyr_gm_def_pass_yds_tgt"], "plyr_gm_def_tgt = 0 AND plyr_gm_def_pass_yds_tgt = 0", "",
                ["plyr_gm_def_tgt", "plyr_gm_def_pass_yds_tgt"], overwrite=True,
            ),
            Rule(
                [
                    "plyr_gm_def_tgt", "plyr_gm_def_cmp", "plyr_gm_def_cmp_pct", "plyr_gm_def_pass_yds",
                    "plyr_gm_def_pass_yds_cmp", "plyr_gm_def_pass_yds_tgt", "plyr_gm_def_pass_td", "plyr_gm_def_pass_rtg",
                    "plyr_gm_def_adot", "plyr_gm_def_ay", "plyr_gm_def_yac", "plyr_gm_def_bltz", "plyr_gm_def_hrry",
                    "plyr_gm_def_qbkd", "plyr_gm_def_prss", "plyr_gm_def_mtkl", "plyr_gm_def_mtkl_pct",
                ],
                "plyr_gm_def_tgt IS NULL", "plyr_gm_def_missing_stats", ["plyr_gm_def_tgt"], when=MASKED,
            ),
            _zero("plyr_gm_def_cmp", [
                "plyr_gm_def_pass_yds", "plyr_gm_def_pass_yds_cmp", "plyr_gm_def_ay", "plyr_gm_def_yac", "plyr_gm_def_cmp",
                "plyr_gm_def_pass_td",
            ], "plyr_gm_def_no_cmp", when=MASKED),
            _zero("plyr_gm_def_mtkl", ["plyr_gm_def_mtkl_pct"], "plyr_gm_def_no_mtkl"),
            Rule(
                [
                    "plyr_gm_def_pass_yds", "plyr_gm_def_pass_yds_cmp", "plyr_gm_def_pass_yds_tgt", "plyr_gm_def_ay",
                    "plyr_gm_def_yac",
                ], f"{_ACTIVE} AND plyr_gm_def_pass_yds IS NULL",
                "plyr_gm_def_no_pass_yds", ["plyr_gm_def_tgt", "plyr_gm_def_cmp", "plyr_gm_def_pass_yds"], when=MASKED,
            ),
            Rule(
                ["plyr_gm_def_pass_td", "plyr_gm_def_adot"], f"{_ACTIVE} AND plyr_gm_def_pass_td IS NULL",
                "plyr_gm_def_missing_stats", ["plyr_gm_def_tgt", "plyr_gm_def_cmp", "plyr_gm_def_pass_td"], when=MASKED,
            ),
            Rule(indicator="plyr_gm_def_missing_stats"),
        ],
    ),
    "plyr_def": Table(
        ["plyr_def_no_targets", "plyr_def_missing_stats", "plyr_def_no_mtkl", "plyr_def_no_completions"],
        [
            _zero("plyr_def_tgt", ["plyr_def_cmp_pct", "plyr_def_pass_yds_cmp", "plyr_def_pass_yds_tgt", "plyr_def_pass_rtg", "plyr_def_adot"], "plyr_def_no_targets", when=MASKED),
            Rule(
                [
                    "plyr_def_tgt", "plyr_def_cmp", "plyr_def_cmp_pct", "plyr_def_pass_yds", "plyr_def_pass_yds_cmp",
                    "plyr_def_pass_yds_tgt", "plyr_def_pass_td", "plyr_def_pass_rtg", "plyr_def_adot", "plyr_def_ay",
                    "plyr_def_yac", "plyr_def_bltz", "plyr_def_hrry", "plyr_def_qbkd", "plyr_def_sk", "plyr_def_prss",
                    "plyr_def_comb_tkl", "plyr_def_mtkl", "plyr_def_mtkl_pct",
                ],
                "plyr_def_tgt IS NULL", "plyr_def_missing_stats", ["plyr_def_tgt"], when=MASKED,
            ),
            Rule(
                [
                    "plyr_def_int", "plyr_def_int_yds", "plyr_def_int_td", "plyr_def_int_lng", "plyr_pass_def",
                    "plyr_def_force_fmbl", "plyr_def_fmbl_rec", "plyr_def_fmbl_rec_yds", "plyr_def_fmbl_rec_td",
                    "plyr_def_solo_tkl", "plyr_def_tkl_assist", "plyr_def_tfl", "plyr_def_qb_hit", "plyr_def_sfty",
                ],
                "plyr_def_int IS NULL", "plyr_def_missing_stats", ["plyr_def_int"], when=MASKED,
            ),
            _zero("plyr_def_mtkl", ["plyr_def_mtkl_pct"], "plyr_def_no_mtkl", when=MASKED),
            _zero("plyr_def_cmp", ["plyr_def_pass_yds_cmp"], "plyr_def_no_completions"),
        ],
    ),
    "plyr_pass": Table(
        ["plyr_pass_did_not_qualify", "plyr_pass_no_att", "plyr_pass_no_cmp", "plyr_pass_no_scrmbl", "plyr_pass_missing_stats"],
        [
            Rule(["qb_win", "qb_loss", "qb_tie"], "all null", "plyr_pass_did_not_qualify", ["qb_win", "qb_loss", "qb_tie"]),
            Rule(["plyr_pass_succ_rt"], _nonzero("plyr_pass_att"), "plyr_pass_did_not_qualify", ["plyr_pass_att"]),
            _zero(
                "plyr_pass_att",
                [
                    "plyr_pass_cmp_pct", "plyr_pass_td_pct", "plyr_pass_int_pct", "plyr_pass_succ_rt", "plyr_pass_lng",
                    "plyr_pass_yds_att", "plyr_pass_adj_yds_att", "plyr_pass_yds_cmp", "plyr_pass_rtg", "plyr_pass_adv_yds",
                    "plyr_pass_iay", "plyr_pass_iay_att", "plyr_pass_cmp_ay", "plyr_pass_cay_cmp", "plyr_pass_cay_att",
                    "plyr_pass_yac", "plyr_pass_yac_cmp",
                    "plyr_rpo_play", "plyr_rpo_yds", "plyr_rpo_pass_att", "plyr_rpo_pass_yds", "plyr_rpo_rush_att",
                    "plyr_rpo_rush_yds", "plyr_pa_att", "plyr_pa_yds",
                    "plyr_pass_pkt_time", "plyr_pass_bltz", "plyr_pass_hrry", "plyr_pass_hit", "plyr_pass_prss",
                    "plyr_pass_prss_pct", "plyr_pass_scrmbl", "plyr_pass_yds_scrmbl", "plyr_qbr",
                ],
                "plyr_pass_no_att",
            ),
            _zero("plyr_pass_cmp", ["plyr_pass_lng", "plyr_pass_cay_cmp"], "plyr_pass_no_cmp"),
            Rule(["plyr_pass_lng", "plyr_pass_cay_cmp"], "plyr_pass_yds < 0", "plyr_pass_no_cmp", ["plyr_pass_cmp", "plyr_pass_yds"]),
            Rule(["plyr_pass_yds_cmp", "plyr_pass_yac_cmp"], f"plyr_pass_cmp = 0 AND {_nonzero('plyr_pass_att')}", "plyr_pass_no_cmp", ["plyr_pass_cmp", "plyr_pass_att"]),
            _zero("plyr_pass_scrmbl", ["plyr_pass_yds_scrmbl"], "plyr_pass_no_scrmbl"),
            Rule(indicator="plyr_pass_missing_stats"),
        ],
    ),
    "plyr_gm_pass": Table(
        [
            "plyr_gm_pass_no_cmp", "plyr_gm_pass_no_scrmbl", "plyr_gm_pass_no_first_dwn", "plyr_gm_pass_no_td",
            "plyr_gm_pass_no_int", "plyr_gm_pass_no_prss", "plyr_gm_pass_no_sk",
        ],
        [
            _zero("plyr_gm_pass_cmp", [
                "plyr_gm_pass_cay_cmp", "plyr_gm_pass_yac_cmp", "plyr_gm_pass_yds_cmp", "plyr_gm_pass_first_dwn",
                "plyr_gm_pass_first_dwn_pct",
            ], "plyr_gm_pass_no_cmp"),
            _zero("plyr_gm_pass_scrmbl_tgt", ["plyr_gm_pass_yds_scrmbl"], "plyr_gm_pass_no_scrmbl", fill=-1),
            Rule(
                ["plyr_gm_pass_first_dwn_pct"], f"{_nonzero('plyr_gm_pass_cmp')} AND plyr_gm_pass_first_dwn IS NULL",
                "plyr_gm_pass_no_first_dwn", ["plyr_gm_pass_cmp", "plyr_gm_pass_first_dwn"],
            ),
            Rule(["plyr_gm_pass_first_dwn"], _nonzero("plyr_gm_pass_cmp"), "", ["plyr_gm_pass_cmp", "plyr_gm_pass_first_dwn_pct"], fill=0),
        ],
    ),
    "plyr_gm_rush": Table(
        ["plyr_gm_rush_no_rushes", "plyr_gm_rush_no_brkn_tkl", "plyr_gm_rush_no_first_dwn"],
        [
            _zero("plyr_gm_rush_att", ["plyr_gm_rush_yds_att", "plyr_gm_rush_ybc_att", "plyr_gm_rush_yac_att", "plyr_gm_rush_brkn_tkl_att"], "plyr_gm_rush_no_rushes"),
            _zero("plyr_gm_rush_brkn_tkl", ["plyr_gm_rush_brkn_tkl_att"], "plyr_gm_rush_no_brkn_tkl"),
            Rule(["plyr_gm_rush_first_dwn"], "", "plyr_gm_rush_no_first_dwn"),
        ],
    ),
    "plyr_rush": Table(
        ["plyr_rush_no_att", "plyr_rush_no_brkn_tkl", "plyr_rush_no_positive_yds"],
        [
            _zero("plyr_rush_att", [
                "plyr_rush_succ_rt", "plyr_rush_lng", "plyr_rush_yds_att", "plyr_rush_ybc", "plyr_rush_ybc_att", "plyr_rush_yac",
                "plyr_rush_yac_att", "plyr_rush_brkn_tkl", "plyr_rush_brkn_tkl_att",
            ], "plyr_rush_no_att"),
            _zero("plyr_rush_brkn_tkl", ["plyr_rush_brkn_tkl_att"], "plyr_rush_no_brkn_tkl"),
            Rule(["plyr_rush_lng"], f"{_nonzero('plyr_rush_att')} AND plyr_rush_yds <= 0", "plyr_rush_no_positive_yds", ["plyr_rush_att", "plyr_rush_yds"]),
        ],
    ),
    "plyr_rz_pass": Table(["plyr_rz_pass_no_tz_att"], [_zero("plyr_pass_tz_att", ["plyr_pass_tz_cmp_pct"], "plyr_rz_pass_no_tz_att")]),
    "plyr_rz_rec": Table(
        ["plyr_rz_rec_missing_stats", "plyr_rz_rec_tz_no_targets"],
        [
            *[
                Rule([f"plyr_rec_{z}_tgt_pct"], _nonzero(f"plyr_rec_{z}_tgt"), "plyr_rz_rec_missing_stats", [f"plyr_rec_{z}_tgt"])
                for z in ("rz", "tz")
            ],
            _zero("plyr_rec_tz_tgt", ["plyr_rec_tz_catch_pct", "plyr_rec_tz_tgt_pct"], "plyr_rz_rec_tz_no_targets"),
        ],
    ),
    "plyr_rz_rush": Table(
        ["plyr_rz_rush_missing_stats", "plyr_rz_rush_fz_no_att", "plyr_rz_rush_tz_no_att", "plyr_rz_rush_no_att"],
        [
            rule
            for zone, name in (("fz", "fz_no_att"), ("tz", "tz_no_att"), ("rz", "no_att"))
            for rule in (
                Rule(
                    [f"plyr_rush_{zone}_usage"], _nonzero(f"plyr_rush_{zone}_att"),
                    "plyr_rz_rush_missing_stats", [f"plyr_rush_{zone}_att"],
                ),
                _zero(f"plyr_rush_{zone}_att", [f"plyr_rush_{zone}_usage"], f"plyr_rz_rush_{name}"),
            )
        ],
    ),
    "tm_conv": Table(["tm_conv_no_fourth_dwn_att"], [_zero("tm_fourth_dwn_att", ["tm_fourth_dwn_conv_pct"], "tm_conv_no_fourth_dwn_att")]),
    "tm_def_conv": Table(["tm_def_no_fourth_dwn_att"], [_zero("tm_def_fourth_dwn_att", ["tm_def_fourth_dwn_conv_pct"], "tm_def_no_fourth_dwn_att")]),
    "tm_def": Table([], [Rule(["tm_def_penalty_first_dwn", "tm_def_tkawy"], fill=0)]),
    "tm_def_pass": Table(
        ["tm_def_no_int", "tm_def_no_pass_td", "tm_def_no_sk", "missing_stats"],
        [
            Rule(["tm_def_int", "tm_def_sk"], fill=0),
            _zero("tm_def_int", ["tm_def_int_pct"], "tm_def_no_int"),
            _zero("tm_def_pass_td", ["tm_def_pass_td_pct"], "tm_def_no_pass_td"),
            _zero("tm_def_sk", ["tm_def_sk_pct", "tm_def_sk_yds"], "tm_def_no_sk"),
            Rule(["tm_def_pass_exp"], "", "missing_stats"),
        ],
    ),
    "tm_gm_drive": Table(
        ["tm_gm_drive_missing_stats", "tm_gm_dr_no_secondary_res"],
        [
            Rule(["tm_gm_dr_strt_fld_pos"], "", "tm_gm_drive_missing_stats"),
            Rule(["tm_gm_dr_res_secondary"], "", "tm_gm_dr_no_secondary_res", fill="UNKNOWN"),
        ],
    ),
    "tm_pass": Table(
        ["tm_pass_no_int", "tm_pass_no_sk", "tm_pass_no_scrmbl", "tm_pass_no_td"],
        [
            Rule(["tm_fqc", "tm_gwd", "tm_pass_int", "tm_pass_sk"], fill=0),
            _zero("tm_pass_int", ["tm_pass_int_pct"], "tm_pass_no_int", overwrite=True),
            _zero("tm_pass_sk", ["tm_pass_sack_yds", "tm_pass_sk_pct"], "tm_pass_no_sk", overwrite=True),
            _zero("tm_pass_scrmbl", ["tm_pass_yds_scrmbl"], "tm_pass_no_scrmbl", overwrite=True),
            Rule(["tm_pass_td_pct"], "coalesce(tm_pass_td, 0) = 0", "tm_pass_no_td", ["tm_pass_td"], overwrite=True),
        ],
    ),
    "tm_rec": Table(["tm_rec_no_brkn_tkl"], [_zero("tm_rec_brkn_tkl", ["tm_rec_brkn_tkl_rec"], "tm_rec_no_brkn_tkl")]),
    "tm_rush": Table(["tm_rush_no_brkn_tkl"], [_zero("tm_rush_brkn_tkl", ["tm_rush_att_brkn_tkl"], "tm_rush_no_brkn_tkl", overwrite=True)]),
    "dataset_fastr": Table(
        ["nfl_fastr_missing_stats"], [Rule(["plyr_gm_rec_tgt_share", "plyr_gm_rec_epa", "plyr_gm_rec_ay_share", "plyr_gm_rec_wopr", "plyr_gm_rec_racr"], "all null", "nfl_fastr_missing_stats")]
    ),
}
