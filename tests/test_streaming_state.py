"""Totals in state: corrections, repeated deliveries, a restart between calls, timers that close periods, rows that come too late."""

from __future__ import annotations

import datetime

from tidemark.streaming.keyed import keyed_totals

SCHEMA = "team long, id long, version long, amount long, time timestamp"


def at(day, hour=12):
    return datetime.datetime(2024, 1, day, hour)


def test_corrections_restarts_timers_and_late_rows(spark, tmp_path):
    def call(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        found = keyed_totals(spark, f"{tmp_path}/in", SCHEMA, ["team"], f"{tmp_path}/job", "2 days")
        return {(r.team, r.day.day): (r.n, r.total, r.closed) for r in found.collect()}

    got = call([(1, 10, 0, 5, at(1)), (1, 10, 0, 5, at(1)), (1, 11, 0, 7, at(1)), (2, 12, 0, 1, at(1))])
    assert got == {(1, 1): (2, 12, False), (2, 1): (1, 1, False)}
    got = call([(1, 10, 1, 50, at(1)), (1, 13, 0, 3, at(2)), (1, 11, 0, 999, at(1))])
    assert got == {(1, 1): (2, 57, False), (2, 1): (1, 1, False), (1, 2): (1, 3, False)}
    got = call([(3, 14, 0, 4, at(10))])
    assert got == {(1, 1): (2, 57, True), (2, 1): (1, 1, True), (1, 2): (1, 3, True), (3, 10): (1, 4, False)}
    got = call([(1, 10, 2, 1000, at(1)), (3, 14, 3, 6, at(10)), (3, 14, 2, 8, at(10))])
    assert got == {(1, 1): (2, 57, True), (2, 1): (1, 1, True), (1, 2): (1, 3, True), (3, 10): (1, 6, False)}
