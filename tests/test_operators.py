from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import impute as I
from tidemark.operators import joins as J
from tidemark.operators import linkage as L
from tidemark.operators import windows as W
from tidemark.operators.aggregates import merge_duplicates, summary_rows
from tidemark.operators.cumulative import running_totals, totals, totals_until, two_phase
from tidemark.operators.quality import leaks
from tidemark.sources import scan, sinks
from tidemark.streaming.incremental import sessions, stream_totals, windowed_counts


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def components(edges):
    """(node, component) of a few edges: every node with the least one that it is linked to."""
    least = {}
    for a, b in edges.collect():
        low, high = sorted((least.setdefault(a, a), least.setdefault(b, b)))
        least = {node: low if part == high else part for node, part in least.items()}
    return edges.sparkSession.createDataFrame(list(least.items()), "node long, component long")


def test_running_totals_equal_a_loop_over_the_periods(spark):
    data = [("a", 1, 2, 5), ("a", 1, 2, 1), ("a", 1, 5, 2), ("b", 1, 4, None), (None, 1, 1, 9), ("a", 2, 6, 7)]
    df = spark.createDataFrame(data, "id string, season int, week int, x int")
    once = running_totals(df, ["id", "season"], "week", F.lit(6), ["x"], ["x"][:0])
    loop = []
    for week in range(1, 7):
        loop += [(r["id"], r["season"], week, r["x"], r["game_count"]) for r in totals_until(df, ["id", "season"], "week", week, ["x"]).collect()]
    assert rows(once) == sorted(loop, key=str)


def test_totals_of_nulls_and_absent_columns(spark):
    df = spark.createDataFrame([("a", None, None)], "id string, x int, y int")
    assert rows(totals(df, ["id"], ["x", "absent"], ["y"])) == [("a", 0, None, 1)]
    assert totals(df.limit(0), ["id"], ["x"]).count() == 0


def test_two_phase_counts_games(spark):
    df = spark.createDataFrame([("t", 1, 2), ("t", 1, 3), ("t", 2, 4)], "team string, game int, x int")
    assert rows(two_phase(df, ["team"], "game", ["x"])) == [("t", 9, 2)]


def test_rolling_mean_never_sees_its_own_row(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([10, -999, 30, 40, 50])], "id string, week int, x double")
    found = W.rolling_means(df, ["id"], ["week"], ["x"], [3]).orderBy("week")
    assert [r["roll_3g_x"] for r in found.collect()] == [None, 10, 10, 20, 35]
    clean = df.withColumn("x", F.nullif("x", F.lit(-999.0)))
    assert leaks(W.rolling_means(clean, ["id"], ["week"], ["x"], [3]), ["id"], ["week"], "x", "roll_3g_x", 3).count() == 0
    assert leaks(clean.withColumn("roll_3g_x", F.col("x")), ["id"], ["week"], "x", "roll_3g_x", 3).count() > 0


def test_average_ranks_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (None,), (5.0,)], "x double")
    assert sorted((r[0] is None, r[0], r[1]) for r in W.average_ranks(df, ["x"]).collect()) == [(False, 1, 1), (False, 2, 2.5), (False, 2, 2.5), (False, 5, 4), (True, None, None)]


def test_intervals_have_open_ends_and_gaps(spark):
    spans = spark.createDataFrame([(1, None, 3, "x"), (1, 6, None, "y")], "id int, s int, e int, team string")
    left = spark.createDataFrame([(1, w) for w in (1, 3, 5, 99)] + [(2, 1)], "id int, week int")
    found = J.in_interval(left, spans, ["id"], "week", "s", "e", "team")
    assert [r["team"] for r in found.orderBy("id", "week").collect()] == ["x", "x", None, "y", None]


@pytest.mark.parametrize(("frequent", "slices"), [(1 << 20, 32), (0, 1), (0, 5), (40, 32)])
def test_intervals_equal_brute_force(spark, frequent, slices):
    rng = random.Random(3)
    end = lambda s: None if rng.random() < 0.1 else (s or 0) + rng.randrange(-2, 15)
    starts = [None if rng.random() < 0.1 else rng.randrange(60) for _ in range(90)]
    spans = [(rng.choice([1, 1, 1, 2, None]), s, end(s), f"v{i}") for i, s in enumerate(starts)]
    spans = [x for x in spans if x[0] != 1 or x[2] is not None] + [(3, None, None, "all"), (3, 2, 5, "in")]
    left = [(n, rng.choice([1, 1, 2, 3, 4, None]), None if rng.random() < 0.05 else rng.randrange(-3, 80)) for n in range(400)]
    low = lambda x: (x is not None, x or 0)

    def first(k, t):
        fits = lambda s, e: (s is None or (t is not None and s <= t)) and (e is None or (t is not None and e >= t))
        return min(((low(s), low(e), v) for i, s, e, v in spans if i == k and k is not None and fits(s, e)), default=(None,))[-1]

    found = J.in_interval(
        spark.createDataFrame(left, "n int, id int, week int"), spark.createDataFrame(spans, "id int, s int, e int, team string"), ["id"], "week", "s", "e", "team", frequent, slices
    )
    assert found.columns == ["n", "id", "week", "team"]
    assert {r["n"]: r["team"] for r in found.collect()} == {n: first(k, t) for n, k, t in left}


@pytest.mark.parametrize("frequent", [1000, 1 << 20])
def test_intervals_of_one_frequent_key(spark, frequent):
    """20,000 spans and 20,000 rows of one key, 4e8 pairs."""
    left = spark.range(20000).selectExpr("1 AS id", "CAST(id AS INT) AS week")
    spans = spark.range(20000).selectExpr("1 AS id", "CAST(id AS INT) AS s", "CAST(id + 1 AS INT) AS e", "id AS v")
    found = J.in_interval(left, spans, ["id"], "week", "s", "e", "v", frequent)
    assert found.where("v = greatest(week - 1, 0)").count() == 20000
    assert "collect_list" not in found._jdf.queryExecution().toString()


def test_linked_and_clustered_records_equal_brute_force(spark):
    rng = random.Random(5)
    day = lambda: None if rng.random() < 0.1 else datetime.date(2000, 1, rng.randrange(1, 9))
    data = [(i, rng.choice(["x", "y", None]), rng.choice([0, 1, 2, None]), rng.choice([0, 1]), rng.choice("ab"), day()) for i in range(60)]
    df = spark.createDataFrame(data, "id int, name string, a int, b int, c string, born date")

    def agree(x, y):
        same = sum(p is not None and p == q for p, q in zip(x[2:5], y[2:5], strict=True))
        return x[1] is not None and x[1] == y[1] and same + (None not in (x[5], y[5]) and abs((x[5] - y[5]).days) <= 1) >= 3

    links = [(x[0], y[0]) for x in data for y in data if x[0] != y[0] and agree(x, y)]
    direct = {x[0]: min([x[0], *[b for a, b in links if a == x[0]]]) for x in data}
    cluster = {x[0]: x[0] for x in data}
    for _ in data:
        for a, b in links:
            cluster[a] = min(cluster[a], cluster[b])
    assert direct != cluster
    args = ("id", "name", ["a", "b", "c"], ["born"], 3)
    assert {r["id"]: r["same_as"] for r in J.linked_records(df, *args).collect()} == direct
    assert {r["id"]: r["same_as"] for r in L.clusters(df, *args).collect()} == cluster
    assert "NestedLoop" not in J.linked_records(df, *args)._jdf.queryExecution().toString()


def test_nearest_takes_the_earlier_of_a_tie(spark):
    left = spark.sql("SELECT 1 AS g, TIMESTAMP '2024-01-01 12:30:00' AS t UNION ALL SELECT 2, TIMESTAMP '2024-01-01 12:00:00'")
    right = spark.sql("SELECT 1 AS g, TIMESTAMP '2024-01-01 12:00:00' AS h, 5.0D AS v UNION ALL SELECT 1, TIMESTAMP '2024-01-01 13:00:00', 6.0D")
    found = {r["g"]: r["v"] for r in J.nearest(left, right, ["g"], "t", "h", ["v"]).collect()}
    assert found == {1: 5.0, 2: None}


def test_tiers_report_what_they_cannot_resolve(spark):
    left = spark.createDataFrame([(1, "A B"), (2, "c"), (3, "z"), (4, None)], "id int, name string")
    right = spark.createDataFrame([(10, "a b"), (11, "c"), (12, "c")], "pid int, name string")
    tiers = [J.Tier([F.col("name")], [F.col("name")]), J.Tier([F.lower("name")], [F.col("name")])]
    assert rows(J.tiered_match(left, right, "id", "pid", tiers)) == [(1, 10, 1), (2, None, None), (3, None, None), (4, None, None)]


def test_lookup_of_one_table_in_two_roles(spark):
    games = spark.createDataFrame([(1, 2), (2, None)], "home int, away int")
    teams = spark.createDataFrame([(1, "x"), (2, "y")], "team int, name string")
    found = J.lookup(J.lookup(games, teams, {"home": "team"}, "home_"), teams, {"away": "team"}, "away_")
    assert rows(found) == [(1, 2, "x", "y"), (2, None, "y", None)]


def test_shifted_source_meets_the_next_period(spark):
    spine = spark.createDataFrame([(1, 1), (1, 2)], "team int, week_id int")
    stats = spark.createDataFrame([(1, 1, 7.0)], "team int, week_id int, x double")
    source = J.FeatureSource(stats, {"team": "team", "week_id": "week_id"}, ["x"], shift=1)
    assert rows(J.join_source(spine, source)) == [(1, 1, None), (1, 2, 7.0)]


def test_duplicates_and_summary_rows(spark):
    df = spark.createDataFrame([(1, 2.0, "b"), (1, 4.0, None), (2, None, "c")], "id int, x double, team string")
    assert rows(merge_duplicates(df, ["id"])) == [(1, 3.0, "b"), (2, None, "c")]
    assert rows(summary_rows(df, ["id"], F.col("team") == "b", [F.col("x")])) == [(1, 2.0, "b"), (2, None, "c")]


CASES = [
    ("plyr_rz_pass", {"plyr_pass_tz_att": 0, "plyr_pass_tz_cmp_pct": None}, {"plyr_pass_tz_cmp_pct": -999, "plyr_rz_pass_no_tz_att": 1}),
    ("plyr_rz_pass", {"plyr_pass_tz_att": 3, "plyr_pass_tz_cmp_pct": None}, {"plyr_pass_tz_cmp_pct": None, "plyr_rz_pass_no_tz_att": 0}),
    ("plyr_rz_pass", {"plyr_pass_tz_att": None, "plyr_pass_tz_cmp_pct": None}, {"plyr_pass_tz_cmp_pct": None, "plyr_rz_pass_no_tz_att": 0}),
    ("plyr_gm_pass", {"plyr_gm_pass_cmp": 2, "plyr_gm_pass_first_dwn": None, "plyr_gm_pass_first_dwn_pct": None},
     {"plyr_gm_pass_first_dwn": 0, "plyr_gm_pass_first_dwn_pct": -999, "plyr_gm_pass_no_first_dwn": 1}),
    ("plyr_gm_pass", {"plyr_gm_pass_scrmbl_tgt": 0, "plyr_gm_pass_yds_scrmbl": None}, {"plyr_gm_pass_yds_scrmbl": -1, "plyr_gm_pass_no_scrmbl": 1}),
    ("tm_pass", {"tm_pass_int": None, "tm_pass_int_pct": 5}, {"tm_pass_int": 0, "tm_pass_int_pct": -999, "tm_pass_no_int": 1}),
    ("tm_def_pass", {"tm_def_sk": None, "tm_def_sk_pct": None, "tm_def_sk_yds": 4}, {"tm_def_sk": 0, "tm_def_sk_pct": -999, "tm_def_sk_yds": 4, "tm_def_no_sk": 1}),
    ("plyr_gm_def", {"plyr_gm_def_tgt": 0, "plyr_gm_def_pass_yds_tgt": 0, "other": None},
     {"plyr_gm_def_pass_yds_tgt": -999, "plyr_gm_def_no_targets": 1, "other": -999, "plyr_gm_def_missing_stats": 1}),
    ("plyr_gm_rec", {"plyr_gm_rec": 3, "plyr_gm_rec_first_dwn": None}, {"plyr_gm_rec_first_dwn": -999, "plyr_gm_rec_no_first_dwn": 1, "plyr_gm_rec_no_catches": 0}),
    ("plyr_rz_rush", {"plyr_rush_fz_att": 2, "plyr_rush_fz_usage": None}, {"plyr_rush_fz_usage": -999, "plyr_rz_rush_missing_stats": 1, "plyr_rz_rush_fz_no_att": 0}),
    ("nfl_fastr_wr", {"plyr_gm_rec_epa": None, "plyr_gm_rec_racr": 1}, {"plyr_gm_rec_epa": -999, "nfl_fastr_missing_fastr": 0, "nfl_fastr_did_not_qualify": 1}),
    ("plyr_pass", {"plyr_pass_cmp": 4, "plyr_pass_yds": -2, "plyr_pass_lng": None}, {"plyr_pass_lng": -999, "plyr_pass_no_cmp": 1, "plyr_pass_missing_stats": 0}),
    ("tm_rush", {"tm_rush_brkn_tkl": 0, "tm_rush_att_brkn_tkl": 3}, {"tm_rush_att_brkn_tkl": -999, "tm_rush_no_brkn_tkl": 1}),
]


@pytest.mark.parametrize(("name", "given", "expected"), CASES)
def test_imputation(spark, name, given, expected):
    df = spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} int" for k in given))
    found = I.impute(df, I.TABLES[name]).first().asDict()
    assert {k: found[k] for k in expected} == expected


def test_every_table_takes_an_empty_frame(spark):
    df = spark.createDataFrame([], "unrelated int")
    for name, table in I.TABLES.items():
        assert I.impute(df, table).count() == 0, name
        assert {*table.indicators} <= {*I.impute(df, table).columns}


def test_text_fill(spark):
    df = spark.createDataFrame([(None,)], "tm_gm_dr_res_secondary string")
    assert I.impute(df, I.TABLES["tm_gm_drive"]).first()["tm_gm_dr_res_secondary"] == "UNKNOWN"


def test_partitions_are_replaced_and_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2023, 1), (2, 2023, 2), (3, 2024, 1)], "x int, season int, week int")
    for _ in range(2):
        sinks.write_partitions(df, path, ["season", "week"])
    sinks.write_partitions(spark.createDataFrame([(9, 2023, 2)], "x int, season int, week int"), path, ["season", "week"])
    assert rows(scan.scan_partitioned(spark, path, "2023").select("x", "season_id", "week_id")) == [(1, 2023, 1), (9, 2023, 2)]
    plan = scan.scan_partitioned(spark, path, "2023", "2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(season" in plan
    sinks.copy_periods(spark, path, str(tmp_path / "c"), "2024")
    assert spark.read.parquet(str(tmp_path / "c")).count() == 1


def test_merge_into_keeps_versions(spark, tmp_path):
    path = str(tmp_path / "m")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    sinks.merge_into(spark, path, first, ["id"])
    sinks.merge_into(spark, path, spark.createDataFrame([(2, None), (3, "c")], "id int, v string"), ["id"], keep_old=True)
    assert rows(spark.read.parquet(sinks.current_version(spark, path))) == [(1, "a"), (2, "b"), (3, "c")]


def test_versions_are_numbered_and_taken_once(spark, tmp_path):
    path = str(tmp_path / "m")
    assert sinks.current_version(spark, path) is None
    for n in range(1, 12):  # beyond one digit: numbers are compared, not their text
        sinks.merge_into(spark, path, spark.createDataFrame([(1, n)], "id int, v int"), ["id"])
    assert rows(spark.read.parquet(sinks.current_version(spark, path))) == [(1, 11)]
    with pytest.raises(RuntimeError):
        sinks._take_number(spark, path, 11, "late")
    assert rows(spark.read.parquet(sinks.current_version(spark, path))) == [(1, 11)]


def test_schemas_of_a_partitioned_table(spark, tmp_path):
    path = str(tmp_path / "p")
    for season, kind in ((2023, "x int"), (2024, "x int, y int")):
        spark.createDataFrame([(1, 2)[: kind.count("int")]], kind).write.parquet(f"{path}/season={season}")
    expected = [(1, None, 2023), (1, 2, 2024)]
    for found in (scan.scan_partitioned(spark, path, schema="x int, y int"), scan.scan_partitioned(spark, path, merge_schema=True)):
        assert sorted(rows(found.select("x", "y", "season")), key=lambda r: r[2]) == expected


def test_two_header_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text(",Passing,Passing\nPlayer,Yds,Yds\nA,1,2\nPlayer,Yds,Yds\nB,3,4\n")
    found = scan.scan_two_header_csv(spark, str(tmp_path / "x.csv"))
    assert found.columns == ["Player", "Passing_Yds", "Passing_Yds_2"]
    assert found.where("Player <> 'Player'").count() == 2
    (tmp_path / "y.csv").write_text("a,b\nc,d\n")
    with pytest.raises(ValueError):
        scan.scan_two_header_csv(spark, str(tmp_path))


def test_latest_file_and_seeds(spark, tmp_path):
    import os

    for n, name in enumerate(("a.csv", "b.csv")):
        (tmp_path / name).write_text("x\n")
        os.utime(tmp_path / name, (n * 1000, n * 1000))
    assert scan.latest_file(spark, str(tmp_path)).endswith("b.csv")
    weeks = scan.season_weeks(spark, [2023, 2022])
    assert weeks.count() == 36 and weeks.agg(F.max("week_id")).first()[0] == 36


def test_html_tables(spark):
    page = '<table><tr class="thead"><td>h</td></tr><tr><td><a href="/p/1">A</a></td><td> 2 </td></tr></table>'
    found = scan.table_rows(spark.createDataFrame([(1, page), (2, None)], "id int, html string"), "id", "html").collect()
    assert [(r["cells"], r["links"]) for r in found] == [(["A", "2"], ["/p/1"])]


def test_lineage_record(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    assert sinks.write_dataset(df, str(tmp_path / "d"), ["id"]) == {"n_rows": 2, "null_id": 1}


def test_stream_totals_read_new_files_only(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    spark.createDataFrame([("a", 1)], "k string, x int").write.parquet(source)
    assert rows(stream_totals(spark, source, lambda d: d, ["k"], ["x"], "n", folder)) == [("a", 1, 1)]
    spark.createDataFrame([("a", 2), ("b", 5)], "k string, x int").write.mode("append").parquet(source)
    assert rows(stream_totals(spark, source, lambda d: d, ["k"], ["x"], "n", folder)) == [("a", 3, 2), ("b", 5, 1)]


def test_windows_and_sessions_of_a_stream(spark, tmp_path):
    spark.sql("SELECT TIMESTAMP '2024-01-01 10:00:00' AS ts, 'a' AS k UNION ALL SELECT TIMESTAMP '2024-01-01 10:10:00', 'a' UNION ALL SELECT TIMESTAMP '2024-01-01 12:00:00', 'a'").write.parquet(str(tmp_path / "e"))
    for n, (build, expected) in enumerate(((windowed_counts, [3]), (sessions, [1, 2]))):
        stream = spark.readStream.schema("ts timestamp, k string").parquet(str(tmp_path / "e"))
        query = build(stream, "ts", ["k"]).writeStream.outputMode("complete").format("memory").queryName(f"w{n}").option("checkpointLocation", str(tmp_path / f"c{n}")).trigger(availableNow=True).start()
        query.awaitTermination()
        assert sorted(r["count"] for r in spark.table(f"w{n}").collect()) == expected


@pytest.mark.parametrize(
    ("table", "row", "expected"),
    [
        ("plyr_gm_rec", {"plyr_gm_rec": None, "plyr_gm_rec_first_dwn": None}, {"plyr_gm_rec_first_dwn": -999, "plyr_gm_rec_no_first_dwn": 1, "plyr_gm_rec": None}),
        ("plyr_rec", {"plyr_rec": None, "plyr_rec_tgt": 3, "plyr_rec_lng": None}, {"plyr_rec_lng": -999, "plyr_rec_no_positive_yds": 1}),
        ("plyr_pass", {"plyr_pass_att": None, "plyr_pass_succ_rt": None}, {"plyr_pass_succ_rt": -999, "plyr_pass_did_not_qualify": 1, "plyr_pass_missing_stats": 1}),
        ("plyr_pass", {"plyr_pass_att": None, "plyr_pass_cmp": 0, "plyr_pass_yds_cmp": None}, {"plyr_pass_yds_cmp": -999, "plyr_pass_no_cmp": 1}),
        ("plyr_gm_pass", {"plyr_gm_pass_cmp": None, "plyr_gm_pass_first_dwn": None, "plyr_gm_pass_first_dwn_pct": None}, {"plyr_gm_pass_first_dwn": 0, "plyr_gm_pass_first_dwn_pct": -999, "plyr_gm_pass_no_first_dwn": 1}),
        ("plyr_rush", {"plyr_rush_att": None, "plyr_rush_yds": -2, "plyr_rush_lng": None}, {"plyr_rush_lng": -999, "plyr_rush_no_positive_yds": 1}),
        ("plyr_rush", {"plyr_rush_att": 4, "plyr_rush_yds": None, "plyr_rush_lng": None}, {"plyr_rush_lng": None, "plyr_rush_no_positive_yds": 0}),
        ("plyr_gm_def", {"plyr_gm_def_tgt": None, "plyr_gm_def_cmp": 2, "plyr_gm_def_pass_yds": None}, {"plyr_gm_def_no_pass_yds": 0, "plyr_gm_def_pass_yds": -999, "plyr_gm_def_missing_stats": 1}),
    ],
)
def test_a_missing_count_is_not_a_count_of_zero(spark, table, row, expected):
    from tidemark.operators import impute as I

    df = spark.createDataFrame([row], ", ".join(f"{c} int" for c in row))
    got = I.impute(df, I.TABLES[table]).first().asDict()
    assert {k: got[k] for k in expected} == expected


def test_imputation_sql_by_hand_names_the_columns_of_its_table():
    from tidemark.operators import impute as I
    from tidemark.plans import imputation_sql
    from tidemark.plans.imputation import _columns

    for name, columns in imputation_sql.COLUMNS.items():
        assert {*columns} == {*_columns(I.TABLES[name])}, name
