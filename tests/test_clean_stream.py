"""The clean table of a stream of raw files equals the batch clean of all of them."""

import os

import pytest
from pyspark.sql import functions as F

from fleetlens.operators.cleaning import clean_table
from fleetlens.sources import csv_files
from fleetlens.streaming import clean as S


def arrive(df, landing, name):
    csv_files.write_table(df.coalesce(2), os.path.join(landing, name))


def check(spark, table, landing, db):
    want = clean_table(csv_files.read_table(spark, table, landing + "/*"), table)
    got = spark.table(f"{db}.{table}_clean").select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_files_late_files_and_restarts_give_the_batch_result(spark, tables, scratch_dir):
    raw, landing, db = tables.raw("courier_feedback"), scratch_dir + "/landing", "clean_stream_db"
    run = lambda: S.clean_stream(spark, "courier_feedback", landing + "/*", db, late_days=2, checkpoint_location=scratch_dir + "/progress")
    arrive(raw.where("day <= 3"), landing, "a")
    first = run()
    assert first["late_rows"] == 0 and first["cleaned_again"] == []
    check(spark, "courier_feedback", landing, db)
    # copies of rows that came before, in later files: the state knows them
    arrive(raw.where("day in (3, 4)"), landing, "b")
    assert run()["late_rows"] == 0
    check(spark, "courier_feedback", landing, db)
    arrive(raw.where("day in (6, 7)"), landing, "c")
    run()
    # day 1 is closed by now; copies and new rows of it come late
    late = raw.where("day = 1").limit(40).withColumn("shop_id", F.concat("shop_id", F.lit("x"))).unionByName(raw.where("day = 1").limit(20))
    arrive(late, landing, "d")
    got = run()
    assert got["late_rows"] > 0 and got["open_from"] > 1 and 1 in got["cleaned_again"]
    check(spark, "courier_feedback", landing, db)
    arrive(raw.where("day = 5 or day = 1 and gps_measure_offset = 0"), landing, "e")
    got = run()
    assert got["open_from"] == 6 and got["cleaned_again"] == [1, 5]     # the other closed days did not change
    check(spark, "courier_feedback", landing, db)
    assert run() | {"open_from": 0} == {"late_rows": 0, "open_from": 0, "cleaned_again": []}


def test_a_run_that_broke_off_is_made_good(spark, tables, scratch_dir, monkeypatch):
    raw, landing, db = tables.raw("courier_feedback"), scratch_dir + "/landing", "clean_stream_broken"
    run = lambda **k: S.clean_stream(spark, "courier_feedback", landing + "/*", db, 1, scratch_dir + "/progress", 1)
    arrive(raw.where("day >= 5"), landing, "a")
    run()
    arrive(raw.where("day <= 2"), landing, "b")
    monkeypatch.setattr(S, "repair", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run()
    monkeypatch.undo()
    assert set(run()["cleaned_again"]) >= {1, 2}        # no new file, but the marker is there
    check(spark, "courier_feedback", landing, db)
    # a batch that fails after its write is done again, without a row twice
    real, failed = S._write, []

    def once(rows, name, batch):
        real(rows, name, batch)
        if not failed:
            failed.append(batch)
            raise RuntimeError("lost")
    monkeypatch.setattr(S, "_write", once)
    arrive(raw.where("day = 7").withColumn("shop_id", F.lit("s0")), landing, "c")
    with pytest.raises(Exception):
        run()
    monkeypatch.undo()
    run()
    check(spark, "courier_feedback", landing, db)


def test_state_holds_open_days_only(spark, tables, scratch_dir):
    landing = scratch_dir + "/landing"
    for day in range(1, 8):
        arrive(tables.raw("courier_feedback").where(F.col("day") == day), landing, f"day{day}")
        S.clean_stream(spark, "courier_feedback", landing + "/*", "clean_stream_state", 1, scratch_dir + "/progress")
    state = spark.read.format("statestore").load(scratch_dir + "/progress/stream")
    days = {r.day for r in state.select("key.day").distinct().collect()}
    assert days and days <= {6, 7}
    check(spark, "courier_feedback", landing, "clean_stream_state")
