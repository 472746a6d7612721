"""Lines that are no rows: rejected with file, text, reason and columns."""

import os

from pyspark.sql import functions as F

from fleetlens.plans import jobs
from fleetlens.schemas import SCHEMAS, TABLES
from fleetlens.sources import catalog, csv_files

HEADER = "no,city_id,day,courier_id,os_version,phone_mode"


def write(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_planted_lines_come_back(spark, scratch_dir):
    good = ['1,1,2,c1,v1,m', '2,,2,c1,v1,"a, \\"b\\""', '3,1,,c1,"x \\" y",m', '-4,1,+2,c1,,']
    a = write(scratch_dir, "a.csv", HEADER, *good, "5,1,2,c1,v1", "6,1,2,c1,v1,m,z", HEADER)
    b = write(scratch_dir, "b.csv", "x7,1,2.0,c1,v1,m", "", "8, ,2,c1,v1,m", '9,1,2,c1,v1,"open', " 9,1,2,c1,v1,m", "99999999999,1,2,c,v,m")
    parsed = csv_files.parsed_lines(spark, "courier_device", [a, b])
    rows = csv_files.accepted(parsed, "courier_device")
    assert rows.schema == SCHEMAS["courier_device"]
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([
        (1, "1", 2, "c1", "v1", "m"), (2, None, 2, "c1", "v1", 'a, "b"'), (3, "1", None, "c1", 'x " y', "m"),
        (-4, "1", 2, "c1", None, None), (8, " ", 2, "c1", "v1", "m")], key=str)
    got = {(os.path.basename(r.source_file), r.line): (r.reason, r.columns) for r in csv_files.rejected(parsed, "courier_device").collect()}
    assert got == {
        ("a.csv", "5,1,2,c1,v1"): ("too_few_fields", None), ("a.csv", "6,1,2,c1,v1,m,z"): ("too_many_fields", None),
        ("a.csv", HEADER): ("repeated_header", None), ("b.csv", "x7,1,2.0,c1,v1,m"): ("bad_value", ["no", "day"]),
        ("b.csv", '9,1,2,c1,v1,"open'): ("unclosed_quote", None), ("b.csv", " 9,1,2,c1,v1,m"): ("bad_value", ["no"]),
        ("b.csv", "99999999999,1,2,c,v,m"): ("bad_value", ["no"])}


def test_good_files_are_read_as_by_the_plain_reader(spark, tables, scratch_dir):
    for t in TABLES:
        path = os.path.join(scratch_dir, t)
        csv_files.write_table(tables.raw(t).limit(3000).repartition(3), path)
        parsed, plain = csv_files.parsed_lines(spark, t, path), csv_files.read_table(spark, t, path)
        rows = csv_files.accepted(parsed, t)
        assert rows.exceptAll(plain).count() == 0 and plain.exceptAll(rows).count() == 0
        assert csv_files.rejected(parsed, t).count() == 0


def test_pruning_columns_rejects_no_less(spark, scratch_dir):
    path = write(scratch_dir, "c.csv", HEADER, "1,1,x,c1,v1,m", "2,1,2,c1,v1,m")
    parsed = csv_files.parsed_lines(spark, "courier_device", path)
    assert [r.city_id for r in csv_files.accepted(parsed, "courier_device").select("city_id").collect()] == ["1"]
    assert csv_files.rejected(parsed, "courier_device").select("reason").count() == 1


def test_doubles(spark, scratch_dir):
    names = ",".join(SCHEMAS["courier_feedback"].names)
    line = lambda x: f"1,1,c,s,1,1,1,1,1,1,1,{x},0"
    path = write(scratch_dir, "f.csv", names, *map(line, ["1.5", "-2", "1e3", ".5", "NaN", "Inf", "", "1.5d", " 1", "abc"]))
    parsed = csv_files.parsed_lines(spark, "courier_feedback", path)
    got = sorted(map(str, (r.distance_to_merchant for r in csv_files.accepted(parsed, "courier_feedback").collect())))
    assert got == sorted(["1.5", "-2.0", "1000.0", "0.5", "nan", "inf", "None"])
    assert {tuple(r.columns) for r in csv_files.rejected(parsed, "courier_feedback").collect()} == {("distance_to_merchant",)}


def test_ingest_writes_rows_and_rejects(spark, scratch_dir):
    a = write(scratch_dir + "/1", "a.csv", HEADER, "1,1,2,c1,v1,m", "broken")
    b = write(scratch_dir + "/1", "b.csv", HEADER, "2,1,2,c1,v1,m")
    counts = jobs.checked_ingest_job(spark, "checked_db", {"courier_device": [a, b]}).first()
    assert tuple(counts) == ("courier_device", 3, 2, 1)
    kept = catalog.table(spark, "checked_db", "courier_device_rejects")
    assert kept.columns == list(csv_files.REJECT_COLUMNS)
    assert [(os.path.basename(r.source_file), r.line, r.reason) for r in kept.collect()] == [("a.csv", "broken", "too_few_fields")]
    # more files are appended; a repeated header is found although no line is broken
    c = write(scratch_dir + "/2", "c.csv", HEADER, "3,1,2,c1,v1,m", HEADER, HEADER)
    counts = jobs.checked_ingest_job(spark, "checked_db", {"courier_device": c}, mode="append").first()
    assert tuple(counts) == ("courier_device", 3, 1, 2)
    assert catalog.table(spark, "checked_db", "courier_device").agg(F.sum("no")).first()[0] == 6
    assert catalog.table(spark, "checked_db", "courier_device_rejects").where("reason = 'repeated_header'").count() == 2
    # files without a fault leave an empty table of rejects
    jobs.checked_ingest_job(spark, "checked_db", {"courier_device": b})
    assert catalog.table(spark, "checked_db", "courier_device_rejects").count() == 0
