"""Spanned tables, types of text, the ledger and saved models."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.functions import types as T
from tidemark.operators import ledger as G
from tidemark.operators.model import evaluate, fit_forest, load_model, save_model
from tidemark.sources import html as H


def grid(spark, *header):
    page = "<table>" + "".join(f"<tr>{r}</tr>" for r in header) + "<tr><td>x</td></tr></table>"
    row = spark.createDataFrame([(page,)], "html string").select(H.header_grid(F.slice(H.rows(F.col("html")), 1, len(header))).alias("g")).first()
    return ["/".join(p) for p in row.g]


def test_header_cells_cover_what_they_span(spark):
    assert grid(spark, "<th>a</th><th>b</th>") == ["a", "b"]
    assert grid(spark, '<th rowspan="3">k</th><th colspan=2>A</th><th colspan="1">B</th>', "<th rowspan=2>x</th><th>y</th><th>z</th>", "<th>y2</th><th>z2</th>") == ["k", "A/x", "A/y/y2", "B/z/z2"]
    assert grid(spark, "<th colspan=2></th><th>A</th>", "<th>p</th><th>q</th><th>r</th>") == ["p", "q", "A/r"]
    assert grid(spark, "<th>a</th>", "<th>x</th><th>y</th>") == ["a/x", "y"]  # a ragged header
    assert grid(spark, "<th colspan=0>a</th><th colspan='99999'>b</th><th rowspan=x>c</th>") == ["a", "b", "c"]  # no sensible spans
    assert grid(spark, "", "<th>a</th>") == ["a"]


def test_header_rows_are_parsed_once_and_not_for_every_column(spark):
    plan = spark.createDataFrame([(["<tr></tr>"],)], "h array<string>").select(H.header_grid(F.col("h")).alias("g"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("</t[dh]>") == 1 and plan.count("colspan") == 1 and plan.count("rowspan") == 1
    page = "<table><tr>" + "".join(f"<th>h{i}</th>" for i in range(300)) + "</tr><tr>" + "".join(f"<td>{i}</td>" for i in range(300)) + "</tr></table>"
    found = H.spanned_cells(spark.createDataFrame([(1, page)], "id int, html string"), "id", "html").collect()
    assert [(r.name, r.value) for r in sorted(found, key=lambda r: r["at"])] == [(f"h{i}", str(i)) for i in range(300)]


def test_spanned_cells_of_pages_without_tables_and_with_repeated_headers(spark):
    body = "<tr><th>Al</th><td>1</td></tr><tr><th>Name</th><th>Yds</th></tr><tr><td colspan=2>both</td></tr><tr><td>a</td><td>b</td><td>beyond</td></tr>"
    pages = [(1, None), (2, ""), (3, "<table></table>"), (4, f"<table id='t'><tr><th>Name</th><th>Yds</th></tr>{body}</table><table>{body}</table>")]
    found = H.spanned_cells(spark.createDataFrame(pages, "id int, html string"), "id", "html")
    got = sorted((r.table, r.row, r["at"], r.name, r.value) for r in found.collect())
    assert got[:7] == [(0, 0, 0, "Name", "Al"), (0, 0, 1, "Yds", "1"), (0, 1, 0, "Name", "both"), (0, 1, 1, "Yds", "both"), (0, 2, 0, "Name", "a"), (0, 2, 1, "Yds", "b"), (0, 2, 2, None, "beyond")]
    assert {r[0] for r in got} == {0, 1} and all(r[3] is None for r in got if r[0] == 1)
    assert H.spanned_cells(spark.createDataFrame(pages, "id int, html string"), "id", "html", "id='t'").select("table").distinct().count() == 1


@pytest.mark.parametrize(
    ("ddl", "found"),
    [
        ("DECIMAL(7,4)", T.Declared("decimal", 3, 4)), ("decimal", T.Declared("decimal", 10, 0)), ("NUMERIC(5)", T.Declared("decimal", 5, 0)), ("FLOAT(7,4)", T.Declared("float", 3, 4)),
        ("double", T.Declared("float")), ("INT UNSIGNED", T.Declared("integer", 9, 0)), ("tinyint(1)", T.Declared("integer", 2, 0)), ("VARCHAR(50) NOT NULL", T.Declared("text", length=50)),
        ("TEXT", T.Declared("text")), ("ENUM('a','bcd')", T.Declared("text", length=3)), ("DATE", T.Declared("date")), ("TIME(3)", T.Declared("time")),
    ],
)
def test_declared_types(ddl, found):
    assert T.declared(ddl) == found


@pytest.mark.parametrize("ddl", ["", "blob(3)", "42"])
def test_other_declarations_are_rejected(ddl):
    with pytest.raises(ValueError, match="no type"):
        T.declared(ddl)


def test_recommended_types_hold_all_values_and_merge(spark):
    columns = {
        "a": (["1", "-0020", " 3 ", None, ""], "INT"), "b": (["1.50", "+20", ".125"], "DECIMAL(5,3)"), "c": (["9" * 18], "BIGINT"), "d": (["9" * 30, "1"], "DECIMAL(30,0)"),
        "e": (["9" * 39], "DOUBLE"), "f": (["2024-01-02", "2024-01-03"], "DATE"), "g": (["2024-01-02", "7"], "VARCHAR(10)"), "h": ([None, " "], None), "i": (["0", "0.0"], "INT"),
        "j": (["1" * 30 + "." + "1" * 20], "DOUBLE"),
    }
    n = max(len(v) for v, _ in columns.values())
    rows = [tuple(v[i] if i < len(v) else None for v, _ in columns.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    for parts in (1, 3):
        got = {r.column: r.recommended for r in T.recommended(T.profile(df.repartition(parts), list(columns))).collect()}
        assert got == {c: t for c, (_, t) in columns.items()}


def test_verdicts_on_declared_types(spark):
    df = spark.createDataFrame([("1234", "1.25", "x", "7"), ("5", "3", "yy", None)], "a string, b string, c string, d string")
    types = {"a": "TINYINT", "b": "DECIMAL(3,1)", "c": "INT", "d": "BIGINT"}
    got = {r.column: r.verdict for r in T.compared(T.recommended(T.profile(df, ["a", "b", "c", "d"])), types).collect()}
    assert got == {"a": "too narrow", "b": "too narrow", "c": "other kind", "d": "ok"}


def test_a_call_takes_fingerprints_of_the_work_once(spark, tmp_path, monkeypatch):
    """However many batches a call has, the work is not read again to see what is left."""
    taken, own = [], G.fingerprint
    monkeypatch.setattr(G, "fingerprint", lambda columns: taken.append(columns) or own(columns))

    def always(rows):
        raise ValueError("no")

    _, failed = G.process(_work(spark, 3), ["k"], always, "k int", str(tmp_path))
    assert {r.attempt for r in failed.collect()} == {3} and len(taken) == 1


def _work(spark, n=6):
    return spark.createDataFrame([(k, None if k == 3 else k % 2, i) for k in range(n) for i in range(k + 1)], "k int, week int, v int")


def test_failed_units_are_retried_three_times_and_changed_input_runs_anew(spark, tmp_path):
    tries = tmp_path / "tries"
    tries.mkdir()

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        key = int(rows["k"].iloc[0])
        with open(tries / f"{key}", "a") as log:
            log.write("x")
        if key == 2 or (key == 4 and (tries / "4").stat().st_size < 2):
            raise RuntimeError(f"lost {key}")
        return rows.groupby("k", as_index=False).agg(total=("v", "sum"))[: 0 if key == 1 else None]

    call = lambda work, **how: G.process(work, ["k", "week"], count, "k int, total long", f"{tmp_path}/job", **how)
    results, failed = call(_work(spark), rounds=1)
    assert sorted(r.k for r in results.collect()) == [0, 3, 5] and sorted(r.k for r in failed.collect()) == [2, 4]
    results, failed = call(_work(spark))
    assert sorted(map(tuple, results.collect())) == [(0, 0), (3, 6), (4, 10), (5, 15)]
    assert [tuple(r) for r in failed.collect()] == [(2, 0, 3, "RuntimeError: lost 2")]
    sizes = {p.name: p.stat().st_size for p in tries.iterdir()}
    assert sizes == {"0": 1, "1": 1, "2": 3, "3": 1, "4": 2, "5": 1}
    call(_work(spark))
    assert sizes == {p.name: p.stat().st_size for p in tries.iterdir()}  # nothing is left to do
    changed = _work(spark).where("NOT (k = 5 AND v = 0)").withColumn("v", F.when(F.col("k") == 5, 100).otherwise(F.col("v")))
    results, _ = call(changed)
    assert (5, 500) in set(map(tuple, results.collect())) and (tries / "5").stat().st_size == 2 and (tries / "0").stat().st_size == 1


def test_a_batch_that_was_killed_before_its_entry_counts_for_nothing(spark, tmp_path, monkeypatch):
    same = lambda rows: rows[["k"]].drop_duplicates()
    with monkeypatch.context() as m:
        m.setattr(G.Ledger, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            G.process(_work(spark, 3), ["k"], same, "k int", str(tmp_path))
    results, failed = G.process(_work(spark, 3), ["k"], same, "k int", str(tmp_path))
    assert sorted(r.k for r in results.collect()) == [0, 1, 2] and failed.count() == 0
    assert G.Ledger(spark, str(tmp_path), [("k", "int")]).entries().count() == 3
    none, _ = G.process(_work(spark, 3).limit(0), ["k"], same, "k int", f"{tmp_path}/none")
    assert none.count() == 0


def test_stages_go_on_where_they_were_killed(spark, tmp_path):
    ran = []

    def stage(name, fail=False):
        def run(df):
            ran.append(name)
            if fail:
                raise KeyboardInterrupt
            return df.withColumn(name, F.lit(len(df.columns)))

        return name, run

    source = spark.range(5)
    with pytest.raises(KeyboardInterrupt):
        list(G.run_stages(source, [stage("a"), stage("b"), stage("c", True)], str(tmp_path)))
    done = list(G.run_stages(source, [stage("a"), stage("b"), stage("c")], str(tmp_path)))
    assert ran == ["a", "b", "c", "c"] and [d for _, d, _ in done] == [True, True, False]
    assert done[-1][2].columns == ["id", "a", "b", "c"] and done[-1][2].count() == 5
    list(G.run_stages(spark.range(6), [stage("a")], str(tmp_path)))
    assert ran[-1] == "a"  # another source


def test_a_fingerprint_knows_values_and_not_their_order(spark):
    of = lambda rows: spark.createDataFrame(rows, "a int, b string").agg(G.fingerprint(["a", "b"])).first()[0]
    rows = [(1, "x"), (2, None), (2, "y"), (2, "y")]
    assert of(rows) == of(rows[::-1])
    assert len({of(rows), of(rows[:3]), of([(1, "x"), (2, ""), (2, "y"), (2, "y")]), of([(2, "x"), (1, None), (2, "y"), (2, "y")]), of([])}) == 5


def test_a_saved_model_needs_its_record(spark, tmp_path):
    rows = spark.range(200).selectExpr("id % 7 AS a", "id % 3 AS b", "CAST(id % 7 * 2 AS DOUBLE) AS y")
    model = fit_forest(rows, ["a", "b"], "y", trees=3, depth=3)
    save_model(model, f"{tmp_path}/m", ["a", "b"], "y", evaluate(model.transform(rows), "y", "prediction"))
    again, record = load_model(spark, f"{tmp_path}/m")
    assert again.transform(rows).select("prediction").collect() == model.transform(rows).select("prediction").collect()
    assert record["trees"] == "3" and record["depth"] == "3" and record["features"] == "a,b"
    assert spark.read.parquet(f"{tmp_path}/m/importances").orderBy(F.desc("importance")).first()["feature"] == "a"
    model.write().save(f"{tmp_path}/half/model")
    with pytest.raises(AnalysisException):
        load_model(spark, f"{tmp_path}/half")


def test_a_catalog_names_every_table_that_is_not_as_it_must_be(spark, tmp_path):
    from tidemark.sources import scan

    spark.range(3).write.parquet(f"{tmp_path}/a")
    catalog = scan.Catalog(spark, str(tmp_path), {"a": "a", "b": "b"})
    assert catalog.validated({"a": ["id", "season_id"]})["a"].count() == 3
    with pytest.raises(ValueError, match=r"a: no \['x'\].*b: PATH_NOT_FOUND"):
        catalog.validated({"a": ["id", "x"], "b": ["id"]})
    with pytest.raises(ValueError, match="no table 'c'"):
        catalog.validated({"c": []})


def test_a_week_is_looked_up(spark):
    from tidemark.sources import scan

    weeks = scan.season_weeks(spark, [2020, 2021], 3)
    assert scan.week_of(weeks, 5) == (2, 2) and scan.week_of(weeks, 99) is None


def test_a_configuration_is_checked(spark, tmp_path):
    from tidemark.sources import config as C

    assert C.parse('{"a": "${X}/b"}', {"X": "/r"}) == {"a": "/r/b"}
    assert C.parse("a: [1, 2]\nb: {c: d}", {}) == {"a": [1, 2], "b": {"c": "d"}}
    for text, what in (("{", "."), ("[1]", "mapping"), ('{"a": "${NONE}"}', "no value")):
        with pytest.raises(Exception, match=what):
            C.parse(text, {})
    base = {"root": str(tmp_path), "tables": {"a": "a"}, "spine": "a", "columns": ["id"]}
    spark.range(3).write.parquet(f"{tmp_path}/a")
    assert C.build(spark, C.Dataset.of(base)).count() == 3
    for more, what in (({"spin": 1}, "spin"), ({"spine": "b"}, "not listed"), ({"sources": [{"table": "a", "keys": {}, "feature": []}]}, "feature")):
        with pytest.raises(ValueError, match=what):
            C.Dataset.of(base | more)


def test_row_groups_that_are_damaged_are_counted_and_the_rest_is_read(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tidemark.sources import salvage

    def file(values, **more):
        sink = pa.BufferOutputStream()
        pq.write_table(pa.table({"a": pa.array(values, pa.int32()), **more}), sink, row_group_size=10, write_page_checksum=True, use_dictionary=False, compression="none")
        return sink.getvalue().to_pybytes()

    whole, other = file(list(range(25)), b=[str(i) for i in range(25)]), file([100])
    column = pq.ParquetFile(pa.BufferReader(whole)).metadata.row_group(1).column(0)
    at = column.data_page_offset + column.total_compressed_size - 4  # in the values, behind the page's header
    broken = whole[:at] + bytes([whole[at] ^ 255]) + whole[at + 1 :]
    files = [("x", broken), ("y", other), ("z", whole[:-3]), ("e", b"")]
    rows, lost = salvage.salvage(spark.createDataFrame(files, "path string, content binary").repartition(3), "a long, b string")
    assert sorted(tuple(r) for r in rows.collect()) == [(i, str(i)) for i in [*range(10), *range(20, 25)]] + [(100, None)]
    assert sorted((r.path, r.group, r.n_rows) for r in lost.collect() if r.path == "x") == [("x", 1, 10)]
    assert {r.path for r in lost.where("group IS NULL").collect()} == {"z", "e"}
    rows, lost = salvage.salvage(spark.createDataFrame([("x", whole)], "path string, content binary"), "b int, c date")
    assert rows.count() == 25 and lost.count() == 0
    rows, lost = salvage.salvage(spark.createDataFrame([("x", file([1], b=["no number"]))], "path string, content binary"), "b int")
    assert rows.count() == 0 and lost.first().n_rows == 1


def test_stamped_paths_sort_by_time():
    import datetime

    from tidemark.sources import sinks

    first, second = (sinks.stamped("/a/", "audit", datetime.datetime(2024, 1, 2, 3, 4, s)) for s in (5, 6))
    assert first == "/a/audit_20240102_030405_000000" and first < second < sinks.stamped("/a", "audit")
