"""Incremental clean tables, and the audit taken while clean tables are written."""

import os

from pyspark.sql import Observation
from pyspark.sql import functions as F

from fleetlens.operators.cleaning import audit_frame, audited_clean, clean_audit, clean_table
from fleetlens.plans import incremental as I
from fleetlens.plans import jobs
from fleetlens.plans.tables import CourierTables
from fleetlens.schemas import TABLES
from fleetlens.sources import catalog


def same(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def files(spark, name):
    """{day: names of the data files} of a partitioned table."""
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first().data_type.removeprefix("file:")
    return {int(d.split("=")[1]): sorted(f for f in os.listdir(f"{place}/{d}") if f.endswith(".parquet"))
            for d in os.listdir(place) if d.startswith("day=")}


def load(spark, raw, table, db):
    return {r.day: r.status for r in I.incremental_clean(CourierTables(spark, {table: raw}), db, [table]).collect()}


def test_second_load_rewrites_changed_days_only(spark, tables):
    raw, db = tables.raw("courier_report"), "incremental_db"
    first = raw.where("day <> 7 and not (day = 3 and no % 2 = 0)").union(
        raw.where("day = 1").withColumn("day", F.lit(9)).select(raw.columns))
    assert set(load(spark, first, "courier_report", db).values()) == {"new"}
    name = f"{db}.courier_report_clean"
    assert same(clean_table(first, "courier_report"), spark.table(name))
    before = files(spark, name)
    assert set(before) == {1, 2, 3, 4, 5, 6, 9}
    assert load(spark, raw, "courier_report", db) == {
        1: "unchanged", 2: "unchanged", 3: "changed", 4: "unchanged", 5: "unchanged", 6: "unchanged", 7: "new", 9: "removed"}
    after = files(spark, name)
    assert set(after) == set(range(1, 8)) and {d for d in before if before[d] != after.get(d)} == {3, 9}
    assert same(clean_table(raw, "courier_report"), spark.table(name))
    # nothing changed, in another order: nothing is written
    assert set(load(spark, raw.orderBy(F.rand(1)), "courier_report", db).values()) == {"unchanged"}
    assert files(spark, name) == after


def test_copies_nulls_and_emptied_days(spark):
    schema = "no int, city_id string, day int, courier_id string, os_version string, phone_mode string"
    row = (1, "1", 1, "c1", "v", "m")
    make = lambda *rows: spark.createDataFrame(rows, schema)
    db = "incremental_cases"
    assert load(spark, make(row, (2, "1", 2, "c", "v", "m"), (3, "1", None, "c", "v", "m")), "courier_device", db) == {1: "new", 2: "new"}
    # a copy more, and a NULL that moves to another column, are changes of the input
    assert load(spark, make(row, row, (2, "1", 2, "c", None, "m")), "courier_device", db) == {1: "changed", 2: "changed"}
    assert [tuple(r) for r in spark.table(f"{db}.courier_device_clean").select("no", "day").collect()] == [(1, 1)]
    assert load(spark, make(row, row, (2, "1", 2, "c", "m", None)), "courier_device", db) == {1: "unchanged", 2: "changed"}
    assert load(spark, make(row).limit(0), "courier_device", db) == {1: "removed", 2: "removed"}
    assert spark.table(f"{db}.courier_device_clean").count() == 0
    assert load(spark, make(row), "courier_device", db) == {1: "new"}


def test_a_load_that_broke_off_and_a_new_rule_are_done_again(spark, tables, monkeypatch):
    raw, db = tables.raw("courier_feedback"), "incremental_broken"
    part = raw.where("day < 4")
    load(spark, part, "courier_feedback", db)
    real = catalog.write_table
    monkeypatch.setattr(I.catalog, "write_table", lambda df, d, name, **k: 1 / 0 if name.endswith("_days") else real(df, d, name, **k))
    try:
        load(spark, raw, "courier_feedback", db)
    except ZeroDivisionError:
        pass
    monkeypatch.setattr(I.catalog, "write_table", real)
    assert {d for d, s in load(spark, raw, "courier_feedback", db).items() if s == "new"} == {4, 5, 6, 7}
    assert same(clean_table(raw, "courier_feedback"), spark.table(f"{db}.courier_feedback_clean"))
    monkeypatch.setitem(I.VALIDITY_RULES, "courier_feedback", {"distance_to_merchant": (0, 500)})
    assert set(load(spark, raw, "courier_feedback", db).values()) == {"changed"}
    assert spark.table(f"{db}.courier_feedback_clean").agg(F.max("distance_to_merchant")).first()[0] <= 500
    # the lost fingerprints, and a table that isn't partitioned, only cost a full clean
    spark.sql(f"DROP TABLE {db}.courier_feedback_clean_days")
    assert set(load(spark, part, "courier_feedback", db).values()) == {"new"}
    assert same(clean_table(part, "courier_feedback"), spark.table(f"{db}.courier_feedback_clean"))
    clean_table(raw, "courier_feedback").write.mode("overwrite").saveAsTable(f"{db}.courier_feedback_clean")
    load(spark, raw, "courier_feedback", db)
    assert same(clean_table(raw, "courier_feedback"), spark.table(f"{db}.courier_feedback_clean"))


def test_all_tables_at_once(spark, tables):
    report = I.incremental_clean(tables, "incremental_all")
    assert {r.table_name for r in report.collect()} == set(TABLES)
    for t in TABLES:
        assert same(tables.clean(t), catalog.table(spark, "incremental_all", t + "_clean"))


def test_audit_is_taken_in_the_writing_pass(spark, tables):
    audit = jobs.clean_job(tables, "audited_db")
    want = {tuple(r) for r in clean_audit({t: tables.raw(t) for t in TABLES}).collect()}
    assert {tuple(r) for r in audit.collect()} == want
    for t in TABLES:
        assert same(tables.clean(t), catalog.table(spark, "audited_db", t + "_clean"))
    # one scan and one shuffle of the raw rows
    plan = audited_clean(tables.raw("courier_report"), "courier_report", Observation())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_audit_of_an_empty_table(spark, tables, scratch_dir):
    audit = Observation()
    audited_clean(tables.raw("courier_feedback").limit(0), "courier_feedback", audit).write.parquet(scratch_dir + "/none")
    assert tuple(audit_frame(spark, {"x": audit}).first()) == ("x", 0, 0, 0, 0, 0)


def test_rows_are_shuffled_once(spark, tables, monkeypatch):
    """The shuffle that removes copies is the only one of the rows, in a first load and in a later one."""
    plans, db = [], "incremental_once"
    raw = tables.raw("courier_report")
    monkeypatch.setattr(I, "clean_table", lambda df, t: plans.append(clean_table(df, t)) or plans[-1])
    real = catalog.write_table
    def write(df, d, name, **k):
        if name.endswith("_clean"):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1
            plans.append("seen")
        real(df, d, name, **k)
    monkeypatch.setattr(I.catalog, "write_table", write)
    load(spark, raw.where("day <> 7"), "courier_report", db)
    assert "seen" in plans and load(spark, raw, "courier_report", db)[7] == "new"
    assert same(clean_table(raw, "courier_report"), spark.table(f"{db}.courier_report_clean"))


def test_fingerprint_is_the_sum_of_the_hashes(spark, tables):
    raw = tables.raw("courier_feedback")
    cols = sorted(raw.columns)
    h = F.xxhash64(*cols, *[F.col(c).isNull() for c in cols])
    want = {r.day: (r.n, int(r.s)) for r in raw.groupBy("day").agg(F.count("*").alias("n"), F.sum(h.cast("decimal(28,0)")).alias("s")).collect()}
    assert {r.day: (r.raw_rows, int(r.hash_sum)) for r in I.day_fingerprints(raw, "courier_feedback").collect()} == want
