"""Incremental raw-file ingestion with Structured Streaming (S-2 + K-3).

Raw delimited files keep arriving in a landing folder (one folder per
table). ``ingest_stream`` appends every file not loaded before to the raw
catalog table: a file source with a fixed schema, progress in an explicit
folder or one derived from the configured ``spark.checkpoint.dir`` (the same
in every application, so which files are done survives restarts), and an
exactly-once table sink. ``trigger="available_now"`` loads
everything present and stops, which is how a scheduled batch load uses it.

Cleaning stays a batch job: full-row de-duplication across all history has
no event time to bound its state, so it is not run as a stream.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..schemas import SCHEMAS
from ..session import stable_folder
from ..sources import catalog


def raw_file_stream(spark: SparkSession, table: str, landing_dir: str, delimiter: str = ",",
                    max_files_per_trigger: int | None = None):
    reader = (spark.readStream.schema(SCHEMAS[table])
                   .option("header", True).option("sep", delimiter))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(landing_dir)


def ingest_stream(spark: SparkSession, table: str, landing_dir: str, database: str,
                  checkpoint_location: str | None = None, trigger: str = "available_now",
                  interval: str = "1 minute") -> StreamingQuery:
    ckpt = checkpoint_location or stable_folder(spark, f"ingest/{database}/{table}")
    catalog.create_database(spark, database)
    writer = (raw_file_stream(spark, table, landing_dir).writeStream
              .format("parquet").outputMode("append").option("checkpointLocation", ckpt))
    writer = (writer.trigger(availableNow=True) if trigger == "available_now"
              else writer.trigger(processingTime=interval))
    return writer.toTable(catalog.qualified(database, table))
