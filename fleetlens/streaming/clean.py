"""Cleaning as a stream: arriving raw files feed a clean table (L-2, L-6).

Full-row de-duplication needs to remember rows, so the memory has to end
somewhere. Event time is the day column: the last ``late_days`` days seen are
open, and their rows are de-duplicated by Spark's streaming state, which
forgets a day once the watermark has reached it. Later rows of a closed day are dropped by the state
operator; the run counts them, and when there are any (or when an earlier run
broke off, so that nobody knows) it cleans the closed days whose raw rows
changed once more, as a batch. After each run the table equals a full clean
of all files that arrived.

A batch writes its own partitions (day, batch) and replaces them when it is
done again, so a restart neither loses nor repeats rows.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import clean_table, drop_incomplete, validity_predicate
from ..plans.incremental import DAY, compare, day_fingerprints, dynamic_overwrite
from ..schemas import SCHEMAS
from ..session import materialize, stable_folder
from ..sources import catalog, csv_files
from .ingest import raw_file_stream

BATCH = "batch"
REPAIRED = -1               # the batch of a day that was cleaned again as a whole
SECONDS_PER_DAY = 86400


def unique_rows(rows: DataFrame, table: str, late_days: int) -> DataFrame:
    """The valid rows of a stream, each once as far as its day is open."""
    names = rows.columns
    valid = drop_incomplete(rows).where(validity_predicate(table))
    return (valid.withColumn("_event", F.timestamp_seconds(F.col(DAY).cast("long") * SECONDS_PER_DAY))
            .withWatermark("_event", f"{late_days} days").dropDuplicates([*names, "_event"]).select(*names))


class _Marker:
    """A file beside the stream's progress that says: a run is under way, or broke off."""

    def __init__(self, spark: SparkSession, folder: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_running")
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.fs.exists(self.path)

    def set(self) -> None:
        self.fs.create(self.path, True).close()

    def clear(self) -> None:
        self.fs.delete(self.path, False)


def _write(rows: DataFrame, name: str, batch: int) -> None:
    spark = rows.sparkSession
    with dynamic_overwrite(spark):
        rows.withColumn(BATCH, F.lit(batch).cast("long")).select(*spark.table(name).columns).write.insertInto(name, overwrite=True)


def _drop(spark: SparkSession, name: str, day: int, keep: int | None = None) -> None:
    for r in spark.sql(f"SHOW PARTITIONS {name} PARTITION ({DAY} = {day})").collect():
        batch = int(r.partition.rsplit("=", 1)[1])
        if batch != keep:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({DAY} = {day}, {BATCH} = {batch})")


def repair(spark: SparkSession, table: str, landing_dir: str, database: str, closed: int) -> list[int]:
    """Clean again the days before ``closed`` whose raw rows are not those that
    the last repair saw; the days."""
    name, state = catalog.qualified(database, table + "_clean"), table + "_closed_days"
    raw = csv_files.read_table(spark, table, landing_dir).where(F.col(DAY) < closed)
    now = materialize(day_fingerprints(raw, table))
    before = catalog.table(spark, database, state) if catalog.table_exists(spark, database, state) else None
    days = sorted(r.day for r in compare(now, before).collect() if r.status in ("new", "changed"))
    if days:
        whole = materialize(clean_table(raw.where(F.col(DAY).isin(days)), table))
        _write(whole, name, REPAIRED)
        for day in days:
            _drop(spark, name, day, keep=REPAIRED)
        catalog.write_table(now, database, state)
    return days


def clean_stream(spark: SparkSession, table: str, landing_dir: str, database: str, late_days: int = 2,
                 checkpoint_location: str | None = None, max_files_per_trigger: int | None = None) -> dict:
    """Take in every file that arrived; ``{table}_clean`` is then the clean
    table of all of them. Returns the late rows, the first open day, and the
    closed days that were cleaned again."""
    progress = checkpoint_location or stable_folder(spark, f"clean/{database}/{table}")
    catalog.create_database(spark, database)
    name = catalog.qualified(database, table + "_clean")
    if not catalog.table_exists(spark, database, table + "_clean"):
        empty = spark.createDataFrame([], SCHEMAS[table]).withColumn(BATCH, F.lit(0).cast("long"))
        catalog.write_table(empty, database, table + "_clean", partition_by=[DAY, BATCH])
    marker = _Marker(spark, progress)
    broke_off = marker.exists()
    marker.set()
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "1000000")             # the late rows of every batch are asked for below
    try:
        query = (unique_rows(raw_file_stream(spark, table, landing_dir, max_files_per_trigger=max_files_per_trigger), table, late_days)
                 .writeStream.foreachBatch(lambda rows, batch: _write(rows, name, batch))
                 .option("checkpointLocation", f"{progress.rstrip('/')}/stream").trigger(availableNow=True).start())
        query.awaitTermination()
        seen = query.recentProgress
    finally:
        spark.conf.set(kept, before)
    late = sum(op["numRowsDroppedByWatermark"] for p in seen for op in p["stateOperators"])
    marks = [p["eventTime"]["watermark"] for p in seen if "watermark" in p["eventTime"]]
    closed = max((_first_open(m) for m in marks), default=None)
    again = []
    if late or broke_off:
        again = repair(spark, table, landing_dir, database, closed if closed is not None else 1 << 30)
    marker.clear()
    return {"late_rows": late, "open_from": closed, "cleaned_again": again}


def _first_open(mark: str) -> int:
    """The first day behind a watermark, which closes its own day too."""
    at = datetime.fromisoformat(mark.replace("Z", "+00:00")).astimezone(timezone.utc)
    return int(at.timestamp() // SECONDS_PER_DAY) + 1
