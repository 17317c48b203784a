"""SQL by hand for imputation tables: what each column and indicator must be in the end, in terms of the values that came.

Nothing here is made from the declared rules; columns and conditions are stated anew, and rules that
see what others filled are resolved into conditions on the input. A comparison with a missing number
is false, but ``x`` differs from zero where it is missing: that is IS DISTINCT FROM 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

#: The columns of each table, in the order in which their input is made.
COLUMNS: dict[str, list[str]] = {
    "nfl_fastr_wr": [
        "plyr_gm_rec_avg_cushion", "plyr_gm_rec_avg_separation", "plyr_gm_rec_avg_yac", "plyr_gm_rec_avg_expected_yac", "plyr_gm_rec_avg_yac_above_expectation",
        "plyr_gm_rec_pct_share_of_intended_ay", "plyr_gm_rec_tgt_share", "plyr_gm_rec_epa", "plyr_gm_rec_ay_share", "plyr_gm_rec_wopr", "plyr_gm_rec_racr",
    ],
    "plyr_gm_rec": ["plyr_gm_rec", "plyr_gm_rec_first_dwn", "plyr_gm_rec_aybc_route", "plyr_gm_rec_yac_route", "plyr_gm_rec_brkn_tkl", "plyr_gm_rec_brkn_tkl_rec"],
    "plyr_rec": [
        "plyr_rec_tgt", "plyr_rec", "plyr_rec_catch_pct", "plyr_rec_yds_rec", "plyr_rec_succ_rt", "plyr_rec_lng", "plyr_rec_yds_tgt", "plyr_rec_aybc", "plyr_rec_aybc_rec", "plyr_rec_yac",
        "plyr_rec_yac_rec", "plyr_rec_adot", "plyr_rec_brkn_tkl", "plyr_rec_brkn_tkl_rec", "plyr_rec_drp", "plyr_rec_drp_pct", "plyr_rec_int", "plyr_rec_pass_rtg",
    ],
    "plyr_gm_def": [
        "plyr_gm_def_tgt", "plyr_gm_def_cmp", "plyr_gm_def_cmp_pct", "plyr_gm_def_pass_yds", "plyr_gm_def_pass_yds_cmp", "plyr_gm_def_pass_yds_tgt", "plyr_gm_def_pass_td", "plyr_gm_def_pass_rtg",
        "plyr_gm_def_adot", "plyr_gm_def_ay", "plyr_gm_def_yac", "plyr_gm_def_bltz", "plyr_gm_def_hrry", "plyr_gm_def_qbkd", "plyr_gm_def_prss", "plyr_gm_def_mtkl", "plyr_gm_def_mtkl_pct",
    ],
    "plyr_pass": [
        "qb_win", "qb_loss", "qb_tie", "plyr_pass_att", "plyr_pass_cmp", "plyr_pass_yds", "plyr_pass_succ_rt", "plyr_pass_cmp_pct", "plyr_pass_td_pct", "plyr_pass_int_pct", "plyr_pass_lng",
        "plyr_pass_yds_att", "plyr_pass_adj_yds_att", "plyr_pass_yds_cmp", "plyr_pass_rtg", "plyr_pass_adv_yds", "plyr_pass_iay", "plyr_pass_iay_att", "plyr_pass_cmp_ay", "plyr_pass_cay_cmp",
        "plyr_pass_cay_att", "plyr_pass_yac", "plyr_pass_yac_cmp", "plyr_rpo_play", "plyr_rpo_yds", "plyr_rpo_pass_att", "plyr_rpo_pass_yds", "plyr_rpo_rush_att", "plyr_rpo_rush_yds",
        "plyr_pa_att", "plyr_pa_yds", "plyr_pass_pkt_time", "plyr_pass_bltz", "plyr_pass_hrry", "plyr_pass_hit", "plyr_pass_prss", "plyr_pass_prss_pct", "plyr_pass_scrmbl", "plyr_pass_yds_scrmbl",
        "plyr_qbr",
    ],
    "plyr_gm_pass": [
        "plyr_gm_pass_cmp", "plyr_gm_pass_cay_cmp", "plyr_gm_pass_yac_cmp", "plyr_gm_pass_yds_cmp", "plyr_gm_pass_first_dwn", "plyr_gm_pass_first_dwn_pct", "plyr_gm_pass_scrmbl_tgt",
        "plyr_gm_pass_yds_scrmbl",
    ],
    "plyr_rush": [
        "plyr_rush_att", "plyr_rush_yds", "plyr_rush_succ_rt", "plyr_rush_lng", "plyr_rush_yds_att", "plyr_rush_ybc", "plyr_rush_ybc_att", "plyr_rush_yac", "plyr_rush_yac_att",
        "plyr_rush_brkn_tkl", "plyr_rush_brkn_tkl_att",
    ],
    "tm_def_pass": ["tm_def_int", "tm_def_sk", "tm_def_int_pct", "tm_def_pass_td", "tm_def_pass_td_pct", "tm_def_sk_pct", "tm_def_sk_yds", "tm_def_pass_exp"],
    "tm_pass": [
        "tm_fqc", "tm_gwd", "tm_pass_int", "tm_pass_sk", "tm_pass_int_pct", "tm_pass_sack_yds", "tm_pass_sk_pct", "tm_pass_scrmbl", "tm_pass_yds_scrmbl", "tm_pass_td", "tm_pass_td_pct",
    ],
}


def _nulls(columns: Sequence[str], how: str = "OR") -> str:
    return "(" + f" {how} ".join(f"{c} IS NULL" for c in columns) + ")"


def _statement(table: str, values: Mapping[str, str], indicators: Mapping[str, str]) -> str:
    """``values`` give a new value for a column where it is not as it came; ``indicators`` are conditions, a missing one counting as false."""
    held = [f"{values[c]} AS {c}" if c in values else c for c in COLUMNS[table]]
    flags = [f"CAST(coalesce({v}, false) AS INTEGER) AS {k}" for k, v in indicators.items()]
    return f"SELECT o_orderkey, {', '.join([*held, *flags])} FROM given"


def _where(columns: Sequence[str], condition: str, fill: str = "-999") -> dict[str, str]:
    return {c: f"coalesce({c}, CASE WHEN {condition} THEN {fill} END)" for c in columns}


def _always(columns: Sequence[str], fill: str = "-999") -> dict[str, str]:
    return {c: f"coalesce({c}, {fill})" for c in columns}


def _nfl_fastr_wr() -> str:
    tracked, play = COLUMNS["nfl_fastr_wr"][:6], COLUMNS["nfl_fastr_wr"][6:]
    after_catch, value = tracked[2:5], ["plyr_gm_rec_epa", "plyr_gm_rec_racr"]
    return _statement(
        "nfl_fastr_wr",
        _where(tracked, _nulls(tracked, "AND")) | _where(play, _nulls(play, "AND")) | _always(after_catch) | _always(value),
        {
            "nfl_fastr_missing_nextgen": _nulls(tracked, "AND"), "nfl_fastr_missing_fastr": _nulls(play, "AND"),
            "nfl_fastr_wr_no_yac": f"NOT {_nulls(tracked, 'AND')} AND {_nulls(after_catch)}", "nfl_fastr_did_not_qualify": f"NOT {_nulls(play, 'AND')} AND {_nulls(value)}",
        },
    )


def _plyr_gm_rec() -> str:
    return _statement(
        "plyr_gm_rec",
        _always(["plyr_gm_rec_first_dwn"]) | _where(["plyr_gm_rec_aybc_route", "plyr_gm_rec_yac_route"], "plyr_gm_rec = 0") | _where(["plyr_gm_rec_brkn_tkl_rec"], "plyr_gm_rec_brkn_tkl = 0"),
        {
            "plyr_gm_rec_no_catches": "plyr_gm_rec = 0 AND (plyr_gm_rec_first_dwn IS NULL OR plyr_gm_rec_aybc_route IS NULL OR plyr_gm_rec_yac_route IS NULL)",
            "plyr_gm_rec_no_brkn_tkl": "plyr_gm_rec_brkn_tkl = 0 AND plyr_gm_rec_brkn_tkl_rec IS NULL",
            "plyr_gm_rec_no_drops": "false",
            "plyr_gm_rec_no_first_dwn": "plyr_gm_rec IS DISTINCT FROM 0 AND plyr_gm_rec_first_dwn IS NULL",
        },
    )


def _plyr_rec() -> str:
    of_target = COLUMNS["plyr_rec"][2:]
    of_catch = ["plyr_rec_yds_rec", "plyr_rec_lng", "plyr_rec_aybc_rec", "plyr_rec_yac_rec", "plyr_rec_brkn_tkl_rec"]
    return _statement(
        "plyr_rec",
        _where(of_target, "plyr_rec_tgt = 0") | _where(of_catch, "plyr_rec_tgt = 0 OR plyr_rec = 0") | _where(["plyr_rec_brkn_tkl_rec"], "plyr_rec_tgt = 0 OR plyr_rec = 0 OR plyr_rec_brkn_tkl = 0") | _always(["plyr_rec_lng"]),
        {
            "plyr_rec_no_targets": f"plyr_rec_tgt = 0 AND {_nulls(of_target)}",
            "plyr_rec_no_catches": f"plyr_rec = 0 AND plyr_rec_tgt IS DISTINCT FROM 0 AND {_nulls(of_catch)}",
            "plyr_rec_no_brkn_tkl": "plyr_rec_brkn_tkl = 0 AND plyr_rec_brkn_tkl_rec IS NULL AND plyr_rec_tgt IS DISTINCT FROM 0 AND plyr_rec IS DISTINCT FROM 0",
            "plyr_rec_no_positive_yds": "plyr_rec_lng IS NULL AND plyr_rec_tgt IS DISTINCT FROM 0 AND plyr_rec IS DISTINCT FROM 0",
        },
    )


def _plyr_gm_def() -> str:
    every = COLUMNS["plyr_gm_def"]
    rest = ["plyr_gm_def_cmp", "plyr_gm_def_bltz", "plyr_gm_def_hrry", "plyr_gm_def_qbkd", "plyr_gm_def_prss", "plyr_gm_def_mtkl"]
    pct = "(plyr_gm_def_mtkl_pct IS NULL AND plyr_gm_def_mtkl IS DISTINCT FROM 0)"
    aimed = "plyr_gm_def_tgt <> 0"
    left = [
        _nulls(["plyr_gm_def_cmp_pct", "plyr_gm_def_pass_rtg", "plyr_gm_def_adot"]),
        "(plyr_gm_def_cmp <> 0 AND plyr_gm_def_pass_td IS NULL)",
        "(plyr_gm_def_cmp <> 0 AND plyr_gm_def_pass_yds IS NOT NULL AND " + _nulls(["plyr_gm_def_pass_yds_cmp", "plyr_gm_def_ay", "plyr_gm_def_yac"]) + ")",
        "(plyr_gm_def_pass_yds_tgt IS NULL AND NOT coalesce(plyr_gm_def_cmp <> 0 AND plyr_gm_def_pass_yds IS NULL, false))",
    ]
    return _statement(
        "plyr_gm_def",
        _always(every) | {"plyr_gm_def_pass_yds_tgt": "CASE WHEN plyr_gm_def_tgt = 0 AND plyr_gm_def_pass_yds_tgt = 0 THEN -999 ELSE coalesce(plyr_gm_def_pass_yds_tgt, -999) END"},
        {
            "plyr_gm_def_no_targets": "plyr_gm_def_tgt = 0",
            "plyr_gm_def_missing_stats": f"plyr_gm_def_tgt IS NULL OR {_nulls(rest)} OR {pct} OR coalesce({aimed} AND ({' OR '.join(left)}), false)",
            "plyr_gm_def_no_mtkl": "plyr_gm_def_mtkl = 0 AND plyr_gm_def_mtkl_pct IS NULL AND plyr_gm_def_tgt IS NOT NULL",
            "plyr_gm_def_no_cmp": "plyr_gm_def_cmp = 0",
            "plyr_gm_def_no_pass_yds": f"{aimed} AND plyr_gm_def_cmp <> 0 AND plyr_gm_def_pass_yds IS NULL",
        },
    )


def _plyr_pass() -> str:
    record, of_attempt = COLUMNS["plyr_pass"][:3], COLUMNS["plyr_pass"][6:]
    own = ["plyr_pass_succ_rt", "plyr_pass_lng", "plyr_pass_cay_cmp", "plyr_pass_yds_cmp", "plyr_pass_yac_cmp", "plyr_pass_yds_scrmbl"]
    other = [c for c in of_attempt if c not in own]
    none = "coalesce(plyr_pass_cmp = 0, false)"
    short = "coalesce(plyr_pass_cmp = 0 OR plyr_pass_yds < 0, false)"
    long_, average = _nulls(["plyr_pass_lng", "plyr_pass_cay_cmp"]), _nulls(["plyr_pass_yds_cmp", "plyr_pass_yac_cmp"])
    tried = "plyr_pass_att IS DISTINCT FROM 0"
    still = f"{_nulls(other)} OR ({long_} AND NOT {short}) OR ({average} AND NOT {none}) OR (plyr_pass_yds_scrmbl IS NULL AND plyr_pass_scrmbl IS DISTINCT FROM 0)"
    return _statement(
        "plyr_pass",
        _always(COLUMNS["plyr_pass"]),
        {
            "plyr_pass_did_not_qualify": f"{_nulls(record, 'AND')} OR (plyr_pass_succ_rt IS NULL AND {tried})",
            "plyr_pass_no_att": f"plyr_pass_att = 0 AND {_nulls(of_attempt)}",
            "plyr_pass_no_cmp": f"{tried} AND (({short} AND {long_}) OR ({none} AND {average}))",
            "plyr_pass_no_scrmbl": f"plyr_pass_scrmbl = 0 AND plyr_pass_yds_scrmbl IS NULL AND {tried}",
            "plyr_pass_missing_stats": f"({_nulls(record)} AND NOT {_nulls(record, 'AND')}) OR {_nulls(COLUMNS['plyr_pass'][3:6])} OR ({tried} AND ({still}))",
        },
    )


def _plyr_gm_pass() -> str:
    return _statement(
        "plyr_gm_pass",
        _where(["plyr_gm_pass_cay_cmp", "plyr_gm_pass_yac_cmp", "plyr_gm_pass_yds_cmp"], "plyr_gm_pass_cmp = 0")
        | {
            "plyr_gm_pass_first_dwn": "coalesce(plyr_gm_pass_first_dwn, CASE WHEN plyr_gm_pass_cmp = 0 THEN -999 ELSE 0 END)",
            "plyr_gm_pass_first_dwn_pct": "coalesce(plyr_gm_pass_first_dwn_pct, CASE WHEN plyr_gm_pass_cmp = 0 OR plyr_gm_pass_first_dwn IS NULL THEN -999 END)",
            "plyr_gm_pass_yds_scrmbl": "coalesce(plyr_gm_pass_yds_scrmbl, CASE WHEN plyr_gm_pass_scrmbl_tgt = 0 THEN -1 END)",
        },
        {
            "plyr_gm_pass_no_cmp": f"plyr_gm_pass_cmp = 0 AND {_nulls(COLUMNS['plyr_gm_pass'][1:6])}",
            "plyr_gm_pass_no_scrmbl": "plyr_gm_pass_scrmbl_tgt = 0 AND plyr_gm_pass_yds_scrmbl IS NULL",
            "plyr_gm_pass_no_first_dwn": "plyr_gm_pass_cmp IS DISTINCT FROM 0 AND plyr_gm_pass_first_dwn IS NULL AND plyr_gm_pass_first_dwn_pct IS NULL",
            "plyr_gm_pass_no_td": "false", "plyr_gm_pass_no_int": "false", "plyr_gm_pass_no_prss": "false", "plyr_gm_pass_no_sk": "false",
        },
    )


def _plyr_rush() -> str:
    of_attempt = COLUMNS["plyr_rush"][2:]
    return _statement(
        "plyr_rush",
        _where(of_attempt, "plyr_rush_att = 0") | _where(["plyr_rush_brkn_tkl_att"], "plyr_rush_att = 0 OR plyr_rush_brkn_tkl = 0") | _where(["plyr_rush_lng"], "plyr_rush_att = 0 OR plyr_rush_yds <= 0"),
        {
            "plyr_rush_no_att": f"plyr_rush_att = 0 AND {_nulls(of_attempt)}",
            "plyr_rush_no_brkn_tkl": "plyr_rush_att IS DISTINCT FROM 0 AND plyr_rush_brkn_tkl = 0 AND plyr_rush_brkn_tkl_att IS NULL",
            "plyr_rush_no_positive_yds": "plyr_rush_att IS DISTINCT FROM 0 AND plyr_rush_yds <= 0 AND plyr_rush_lng IS NULL",
        },
    )


def _tm_def_pass() -> str:
    return _statement(
        "tm_def_pass",
        _always(["tm_def_int", "tm_def_sk"], "0") | _where(["tm_def_int_pct"], "coalesce(tm_def_int, 0) = 0") | _where(["tm_def_pass_td_pct"], "tm_def_pass_td = 0")
        | _where(["tm_def_sk_pct", "tm_def_sk_yds"], "coalesce(tm_def_sk, 0) = 0") | _always(["tm_def_pass_exp"]),
        {
            "tm_def_no_int": "coalesce(tm_def_int, 0) = 0 AND tm_def_int_pct IS NULL", "tm_def_no_pass_td": "tm_def_pass_td = 0 AND tm_def_pass_td_pct IS NULL",
            "tm_def_no_sk": "coalesce(tm_def_sk, 0) = 0 AND (tm_def_sk_pct IS NULL OR tm_def_sk_yds IS NULL)", "missing_stats": "tm_def_pass_exp IS NULL",
        },
    )


def _tm_pass() -> str:
    when = lambda column, condition: {column: f"CASE WHEN {condition} THEN -999 ELSE {column} END"}
    none = {k: f"coalesce(tm_pass_{k}, 0) = 0" for k in ("int", "sk", "td")}
    return _statement(
        "tm_pass",
        _always(["tm_fqc", "tm_gwd", "tm_pass_int", "tm_pass_sk"], "0") | when("tm_pass_int_pct", none["int"]) | when("tm_pass_sack_yds", none["sk"]) | when("tm_pass_sk_pct", none["sk"])
        | when("tm_pass_yds_scrmbl", "tm_pass_scrmbl = 0") | when("tm_pass_td_pct", none["td"]),
        {"tm_pass_no_int": none["int"], "tm_pass_no_sk": none["sk"], "tm_pass_no_scrmbl": "tm_pass_scrmbl = 0", "tm_pass_no_td": none["td"]},
    )


BY_HAND: dict[str, str] = {
    "nfl_fastr_wr": _nfl_fastr_wr(), "plyr_gm_rec": _plyr_gm_rec(), "plyr_rec": _plyr_rec(), "plyr_gm_def": _plyr_gm_def(), "plyr_pass": _plyr_pass(), "plyr_gm_pass": _plyr_gm_pass(),
    "plyr_rush": _plyr_rush(), "tm_def_pass": _tm_def_pass(), "tm_pass": _tm_pass(),
}
