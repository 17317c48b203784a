from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions import filters as P
from tidemark.functions import metrics as M
from tidemark.functions import scalar as S


def value(spark, column, **given):
    kinds = {str: "string", int: "int", float: "double"}
    schema = ", ".join(f"{k} {kinds.get(type(v), 'string')}" for k, v in given.items()) or "x int"
    out = spark.createDataFrame([tuple(given.values()) or (1,)], schema).select(column.alias("v")).first()[0]
    return tuple(out) if hasattr(out, "asDict") else out


@pytest.mark.parametrize(
    ("function", "given", "expected"),
    [
        (S.whole, "3.0", 3), (S.whole, "x", None), (S.whole, "1,204", 1204), (S.whole, None, None), (S.whole, "NaN", None),
        (S.height_inches, "6-2", 74), (S.height_inches, "6' 2\"", 74), (S.height_inches, "tall", None),
        (S.leading_number, "Rook", 0), (S.leading_number, "300 lbs", 300), (S.leading_number, "", None),
        (S.clock_24h, "8:20PM", "20:20:00"), (S.clock_24h, "8PM", "20:00:00"), (S.clock_24h, "12:05AM", "00:05:00"), (S.clock_24h, "noon", None),
        (S.seconds, "02:30", 150), (S.seconds, "1:02:30", 3750), (S.seconds, "x:30", None), (S.seconds, None, None),
        (S.quarter, "OT", 5), (S.quarter, "7", 5), (S.quarter, "2", 2),
        (S.percent_always, "56", 0.56), (S.percent_marked, "56%", 0.56), (S.percent_marked, "56", 56.0), (S.percent_guessed, "56", 0.56), (S.percent_guessed, "0.5", 0.5),
        (S.swap_day_month, "31/12/1990", "12/31/1990"), (S.strip_marks, "Some Team*+", "Some Team"), (S.flag, " Yes", 1), (S.flag, None, 0),
        (S.week_set, "3, 1,3,x", [1, 3]), (S.week_set, None, []), (S.year_in, "/data/2023/w1.csv", 2023), (S.decimal_places, "1.250", 2),
        (S.coordinate, "-84.4° W", (-84.4, "W")), (S.field_position, "PIT 35", ("PIT", 35.0)), (S.betting_line, "Some Team -3.5", ("Some Team", -3.5)),
        (S.with_remark, "46.5 (over)", ("46.5", "over")), (S.primary_secondary, "Fumble, Safety", ("Fumble", "Safety")),
        (S.draft, "2020: Rd 1, Pk 5 (ABC)", ("ABC", 1, 5, 2020)), (S.draft, "Some Team / 2nd / 33rd pick / 2019", ("Some Team", 2, 33, 2019)),
        (S.plain_name, "D.J. Some-Name Jr. (IR)", "dj some-name"), (S.on_reserve, "A Name (IR)", 1), (S.on_reserve, "Irvin Name", 0),
    ],
)
def test_scalar(spark, function, given, expected):
    assert value(spark, function(F.col("x")), x=given) == expected


def test_name_variants_meet(spark):
    a, b = (set(value(spark, S.name_variants(F.col("x")), x=n)) for n in ("D.J. Sample", "DJ Sample Jr."))
    assert a & b


def test_guid_is_md5_of_joined_parts(spark):
    import hashlib

    assert value(spark, S.guid(F.lit("a"), F.lit(None), F.lit("c"))) == hashlib.md5(b"a__c").hexdigest()


def test_division_and_rating(spark):
    assert value(spark, M.ratio(F.lit(10), F.lit(2))) == 5
    assert value(spark, M.ratio(F.lit(20), F.lit(0))) is None
    assert value(spark, M.ratio(F.lit(None), F.lit(3), 0)) == 0
    lit = lambda *n: [F.lit(x) for x in n]
    assert value(spark, M.passer_rating(*lit(5, 10, 100, 1, 0))) == pytest.approx(118.75)
    assert value(spark, M.passer_rating(*lit(10, 10, 120, 3, 0))) == pytest.approx(156.25)
    assert value(spark, M.passer_rating(*lit(0, 0, 0, 0, 0))) is None


def test_packs_use_totals(spark):
    names = "rec_tgt rec_rec rec_yds rec_air_yds rec_yac rec_td rec_int rec_brkn_tkl rec_drp game_count".split()
    df = spark.createDataFrame([(20, 15, 150, 120, 30, 1, 0, 2, 1, 3), (0, 0, 0, 0, 0, 0, 0, 0, 0, 1)], " int, ".join(names) + " int")
    a, b = M.with_metrics(df, M.receiving_pack()).orderBy(F.desc("rec_tgt")).collect()
    assert a["rec_catch_pct"] == 0.75 and a["rec_adot"] == 6 and a["rec_ypg"] == 50
    assert b["rec_catch_pct"] is None and b["rec_adot"] is None and b["rec_pass_rtg"] is None


def test_regression_metrics(spark):
    df = spark.createDataFrame([(2.0, 1.0), (4.0, 6.0), (None, 1.0)], "y double, p double")
    row = df.agg(*[v.alias(k) for k, v in M.regression_metrics("y", "p").items()]).first()
    assert row["mae"] == 1.5 and row["rmse"] == pytest.approx(2.5**0.5) and row["r2"] == pytest.approx(-1.5) and row["mape"] == pytest.approx(50)


def test_periods():
    assert P.periods("2022-2024, 2020") == [2020, 2022, 2023, 2024]
    assert P.periods(None) is None and P.periods(" ") is None
    for bad in ("x", "2024-2022", "1,,2"):
        with pytest.raises(ValueError):
            P.periods(bad)


def test_filters(spark):
    df = spark.createDataFrame([("Week", "a"), ("1", "WR"), (None, None), ("2", None)], "week string, pos string")
    assert [r[0] for r in P.drop_header_rows(df, "week", "Week").collect()] == ["1", "2"]
    assert df.where(P.not_among(F.col("pos"), ["WR"])).count() == 3
    assert df.where(P.either(["pos", "week"], "WR")).count() == 1
    with pytest.raises(ValueError):
        P.split_by_years(df, "week", [1], [1, 2])


def test_colleges(spark):
    assert value(spark, S.same_college(F.lit("University of Somewhere"), F.lit("somewhere")))
    assert not value(spark, S.same_college(F.lit(None), F.lit("somewhere")))


def test_teams_positions_and_files(spark):
    from tidemark.functions import teams as N

    paths = ["a/b/cleaned_Green_Bay_Packers_New_York_Jets_wk3.csv", "New_York_Giants_Dallas_Cowboys_wk12_2024.csv", "Dallas_Cowboys_wk1.csv", "x_wk1/Dallas_Cowboys_Miami_Dolphins.csv", "", None, "c\\San_Francisco_49ers_Los_Angeles_Rams_wk1.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] and tuple(r[0]) for r in df.select(N.teams_in_path(F.col("p"))).collect()]
    assert got == [("Green Bay Packers", "New York Jets"), ("New York Giants", "Dallas Cowboys"), None, None, None, None, ("San Francisco 49ers", "Los Angeles Rams")]
    one = spark.createDataFrame([("Jets", "Tampa Bay Buccaneers", "RLB/MLB"), ("x", "y", "ATH"), (None, None, None)], "a string, b string, c string")
    got = [tuple(r) for r in one.select(N.code_of_nickname(F.col("a")), N.name_of_nickname(F.col("a")), N.team_code(F.col("b")), N.position_group(F.col("c"))).collect()]
    assert got == [("NYJ", "New York Jets", "TAM", "LB"), ("x", "x", "y", "ATH"), (None, None, None, None)]
    assert len(N.TEAMS) == 32 and len({N.nickname(n) for n in N.TEAMS}) == 32
