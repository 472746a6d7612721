"""Table-writing jobs: ingest (S-1, S-2), clean (L-6 + K-1), results (K-2),
fault injection (L-12 + K-3) and models (M-*).

Each job reads its inputs lazily, builds the plans from the operators in this
package and writes managed tables. Writes are the only actions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import audit_frame, audited_clean
from ..operators.faults import fault_rows
from ..schemas import FEEDBACK_JOIN_KEYS, TABLES
from ..sources import catalog, csv_files
from . import analytics as A
from . import models as M
from .features import feature_frame
from .tables import CourierTables

CLEAN_SUFFIX = "_clean"
REJECTS_SUFFIX = "_rejects"
FACT_TABLES = ("courier_report", "courier_feedback")


def _load(df: DataFrame, database: str, table: str, mode: str) -> None:
    if mode == "append" and catalog.table_exists(df.sparkSession, database, table):
        catalog.append_table(df, database, table)
    else:
        catalog.write_table(df, database, table, mode="overwrite")


def checked_ingest_job(spark: SparkSession, database: str, paths: dict[str, list[str] | str],
                       mode: str = "overwrite", delimiter: str = ",") -> DataFrame:
    """``ingest_job`` that loses no line: what is no row goes to
    ``{table}_rejects`` with its file, text, reason and columns. Returns
    (table_name, lines, loaded_rows, rejected_rows).

    The rows are written in one scan, which also observes the counts and the
    files that hold rejects (the driver lists the input files anyway); only
    those files are read again for the rejects.
    """
    catalog.create_database(spark, database)
    counts = []
    for table, files in paths.items():
        parsed = csv_files.parsed_lines(spark, table, files, delimiter)
        seen, reason = Observation(f"ingest {table}"), F.col("reason")
        bad = reason.isNotNull() & (reason != csv_files.HEADER)
        watched = parsed.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(reason.isNull()).alias("rows"),
                                 F.count_if(reason == csv_files.HEADER).alias("headers"),
                                 F.collect_set(F.when(bad, F.col("source_file"))).alias("files"))
        _load(csv_files.accepted(watched, table), database, table, mode)
        got = seen.get
        inputs = parsed.inputFiles()
        again = inputs if got["headers"] > len(inputs) else list(got["files"])      # a repeated header may be in any file
        rejects = (csv_files.rejected(csv_files.parsed_lines(spark, table, again, delimiter), table) if again
                   else csv_files.rejected(parsed, table).limit(0))
        _load(rejects, database, table + REJECTS_SUFFIX, mode)
        counts.append((table, got["lines"] - min(got["headers"], len(inputs)), got["rows"]))
    return (spark.createDataFrame(counts, "table_name string, lines bigint, loaded_rows bigint")
            .withColumn("rejected_rows", F.col("lines") - F.col("loaded_rows")))


def ingest_job(spark: SparkSession, database: str, paths: dict[str, list[str] | str],
               mode: str = "overwrite") -> None:
    """Load delimited raw files into ``{database}.{table}`` (one scan per table,
    however many files)."""
    catalog.create_database(spark, database)
    for table, files in paths.items():
        df = csv_files.read_table(spark, table, files)
        _load(df, database, table, mode)


def clean_job(tables: CourierTables, database: str, fact_buckets: int | None = None) -> DataFrame:
    """Write ``{table}_clean`` for the four tables, always from the raw ones
    (so it can be run again); returns the clean audit, whose numbers are
    taken while the tables are written (one scan of each raw table).

    With ``fact_buckets``, the two fact tables are written bucketed and
    sorted on the 7-column order key of the report ⟕ feedback join, so that
    join later reads co-located buckets and shuffles neither side. The
    buckets hash the whole key, so one busy courier or shop does not fill a
    bucket.
    """
    audits = {}
    for t in TABLES:
        bucket = (fact_buckets, FEEDBACK_JOIN_KEYS) if fact_buckets and t in FACT_TABLES else None
        audits[t] = Observation(f"clean {t}")
        catalog.write_table(audited_clean(tables.raw(t), t, audits[t]), database, t + CLEAN_SUFFIX, bucket_by=bucket)
    return audit_frame(tables.spark, audits)


def result_tables(tables: CourierTables, min_count: int = A.BUSY_HOUR_MIN_COUNT,
                  quantile_mode: str = "approx") -> dict[str, Callable[[], DataFrame]]:
    """The fourteen result tables of the analysis jobs; each is built (and
    any job of its own started) only when it is called."""
    t = tables
    return {
        "avg_response_time": lambda: A.avg_response_time(t.feedback),
        "courier_response_counts": lambda: A.courier_response_counts(t.feedback),
        "courier_final": lambda: A.courier_final(t.report, t.feedback, quantile_mode=quantile_mode, materialize_per_courier=True),
        "average_delivery_time": lambda: A.average_delivery_time(t.report),
        "top_busy_hours_per_city": lambda: A.top_busy_hours_per_city(t.report, min_count),
        "courier_phone_mode_counts": lambda: A.courier_phone_mode_counts(t.couriers),
        "courier_os_version_counts": lambda: A.courier_os_version_counts(t.couriers),
        "courier_city_phone_mode_favourite": lambda: A.courier_city_phone_mode_favourite(t.couriers),
        "shop_brand_counts": lambda: A.shop_brand_counts(t.merchants),
        "shop_model_counts": lambda: A.shop_model_counts(t.merchants),
        "shop_city_model_favourite": lambda: A.shop_city_model_favourite(t.merchants),
        "city_courier_merchant_counts": lambda: A.city_courier_merchant_counts(t.couriers, t.merchants),
        "shop_order_counts": lambda: A.shop_order_counts(t.feedback),
        "shop_top_by_day": lambda: A.shop_top_by_day(t.feedback),
    }


def analysis_job(tables: CourierTables, result_database: str, fmt: str = "orc",
                 min_count: int = A.BUSY_HOUR_MIN_COUNT, only=None) -> list[str]:
    """Write the result tables (ORC by default). Reads clean tables when the
    source has them; otherwise the cleaned fact tables are kept (memory, then
    disk) while several results read them, and released (O-13)."""
    builders = {n: b for n, b in result_tables(tables, min_count).items() if not only or n in only}
    shared = [tables.clean(t).persist() for t in FACT_TABLES
              if t not in tables.stored_clean and len(builders) > 1]
    try:
        for name, build in builders.items():
            catalog.write_table(build(), result_database, name, fmt=fmt)
    finally:
        for df in shared:
            df.unpersist()
    return list(builders)


def fault_job(spark: SparkSession, database: str, tables=("courier_feedback", "courier_report",
                                                          "merchant_device"), seed: int = 7) -> None:
    """Append fault rows to raw catalog tables. The fault rows are computed
    before the append (they depend only on the schema and the seed)."""
    for i, t in enumerate(tables):
        schema = catalog.table(spark, database, t).schema
        catalog.append_table(fault_rows(spark, schema, seed=seed + i), database, t)


def model_job(tables: CourierTables, with_feedback: bool = True, seed: int = 42,
              result_database: str | None = None, folder: str | None = None) -> DataFrame:
    """Fit, predict, evaluate; optionally write predictions and metrics. With
    ``folder``, models stored there for the same rows are not fitted again."""
    feats = feature_frame(tables.report, tables.feedback if with_feedback else None)
    preds, trained = M.run_models(feats, with_feedback, seed=seed, folder=folder)
    metrics = M.model_metrics(preds, trained)
    if result_database:
        suffix = "with_feedback" if with_feedback else "report_only"
        catalog.write_table(preds, result_database, f"delivery_predictions_{suffix}")
        catalog.write_table(metrics, result_database, f"model_metrics_{suffix}")
    return metrics
