"""Incremental clean tables (K-1, L-6): only days whose input changed are cleaned again.

``{table}_clean`` is partitioned by day, and ``{table}_clean_days`` keeps, per
day, a fingerprint of the raw rows that the partition was made from. A load

1. fingerprints the raw table by day: one narrow aggregate (row count, sum
   and exclusive-or of row hashes), which depends neither on the rows' order
   nor on their files, and on the cleaning rule;
2. compares it with the stored one; a day is new, changed, unchanged or removed;
3. cleans the raw rows of new and changed days and overwrites their
   partitions (dynamic partition overwrite). Full-row cleaning never looks
   across days, so the table equals a full clean. The shuffle that removes
   copies is the only one: a task writes a file for each day it has rows of;
4. drops the partitions of removed days and of days of which no row is left;
5. stores the fingerprints, last: a load that breaks off before that is
   simply done again, since until then the changed days still count as changed.

Rows with a null day are incomplete and belong to no clean table. What the
driver holds is one row per day.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import VALIDITY_RULES, clean_table
from ..schemas import TABLES
from ..session import materialize
from ..sources import catalog
from .tables import CourierTables

CLEAN_SUFFIX = "_clean"
STATE_SUFFIX = "_clean_days"
DAY = "day"
OPEN_DAYS = 16            # files that a task holds open
STATUSES = ("new", "changed", "unchanged", "removed")
REPORT = "table_name string, day int, status string, raw_rows bigint"


def rule_signature(df: DataFrame, table: str) -> str:
    """Changes with the cleaning rule and with the table's columns."""
    text = repr((sorted(VALIDITY_RULES[table].items()), sorted(df.dtypes)))
    return hashlib.md5(text.encode()).hexdigest()


def day_fingerprints(raw: DataFrame, table: str) -> DataFrame:
    """(day, raw_rows, hash_sum, hash_xor, rule), one row per day with rows."""
    cols = sorted(raw.columns)
    # a NULL leaves Spark's hash as it is, so where the NULLs are is hashed too
    nulls = [F.col(c).isNull() for c in cols]
    # the halves of a hash are summed as integers and put together once a day
    high, low = F.sum(F.shiftright("_h", 32)), F.sum(F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF)))
    whole = high.cast("decimal(28,0)") * F.lit(1 << 32).cast("decimal(10,0)") + low.cast("decimal(28,0)")
    return (raw.where(F.col(DAY).isNotNull()).select(DAY, F.xxhash64(*cols, *nulls).alias("_h"))
            .groupBy(DAY).agg(F.count(F.lit(1)).alias("raw_rows"), whole.cast("decimal(38,0)").alias("hash_sum"),
                              F.bit_xor("_h").alias("hash_xor"))
            .withColumn("rule", F.lit(rule_signature(raw, table))))


@contextmanager
def dynamic_overwrite(spark: SparkSession):
    """An overwrite replaces the partitions that it writes, and no others; a
    task writes its days side by side, and sorts only what is of further days."""
    keys = {"spark.sql.sources.partitionOverwriteMode": "dynamic", "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_DAYS)}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def partition_days(spark: SparkSession, database: str, name: str) -> set | None:
    """Days that the table has a partition of; None if it isn't a table partitioned by day."""
    if not catalog.table_exists(spark, database, name):
        return None
    if [c.name for c in spark.catalog.listColumns(catalog.qualified(database, name)) if c.isPartition] != [DAY]:
        return None
    rows = spark.sql(f"SHOW PARTITIONS {catalog.qualified(database, name)}").collect()
    return {int(r.partition.split("=", 1)[1]) for r in rows}


def compare(now: DataFrame, before: DataFrame | None) -> DataFrame:
    """(day, status, raw_rows) of every day on either side."""
    if before is None:
        return now.select(DAY, F.lit("new").alias("status"), "raw_rows")
    marks = ["raw_rows", "hash_sum", "hash_xor", "rule"]
    both = now.select(DAY, F.struct(*marks).alias("a")).join(before.select(DAY, F.struct(*marks).alias("b")), DAY, "full")
    status = (F.when(F.col("b").isNull(), "new").when(F.col("a").isNull(), "removed")
              .when(F.col("a") == F.col("b"), "unchanged").otherwise("changed"))
    return both.select(DAY, status.alias("status"), F.coalesce("a.raw_rows", F.lit(0)).cast("long").alias("raw_rows"))


def load_table(raw: DataFrame, table: str, database: str) -> list[tuple]:
    """Bring ``{table}_clean`` up to date with ``raw``; (day, status, raw_rows) of every day."""
    spark = raw.sparkSession
    clean, state = table + CLEAN_SUFFIX, table + STATE_SUFFIX
    catalog.create_database(spark, database)
    held = partition_days(spark, database, clean)
    known = held is not None and catalog.table_exists(spark, database, state)
    now = materialize(day_fingerprints(raw, table))
    days = compare(now, catalog.table(spark, database, state) if known else None).collect()
    redo = sorted(r.day for r in days if r.status in ("new", "changed"))
    gone = {r.day for r in days if r.status == "removed"} | ((held or set()) - {r.day for r in days})
    if held is None:
        rows = clean_table(raw.where(F.col(DAY).isNotNull()), table)
        with dynamic_overwrite(spark):
            catalog.write_table(rows, database, clean, partition_by=DAY)
    elif redo:
        written = Observation(f"days of {clean}")
        rows = (clean_table(raw.where(F.col(DAY).isin(redo)), table)
                .select(*catalog.table(spark, database, clean).columns)
                .observe(written, F.collect_set(DAY).alias("days")))
        with dynamic_overwrite(spark):
            rows.write.insertInto(catalog.qualified(database, clean), overwrite=True)
        gone |= held & (set(redo) - set(written.get["days"]))
    for day in sorted(gone):
        spark.sql(f"ALTER TABLE {catalog.qualified(database, clean)} DROP IF EXISTS PARTITION ({DAY} = {day})")
    catalog.write_table(now, database, state)
    return [(r.day, r.status, r.raw_rows) for r in days]


def incremental_clean(tables: CourierTables, database: str, only=TABLES) -> DataFrame:
    """Bring the clean tables in ``only`` up to date; (table_name, day, status, raw_rows)."""
    rows = [(t, *r) for t in only for r in load_table(tables.raw(t), t, database)]
    return tables.spark.createDataFrame(rows, REPORT)
