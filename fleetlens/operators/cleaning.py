"""Cleaning and data-quality operators (L-1 .. L-9).

``clean`` = drop incomplete rows, then drop full-row duplicates. The dedupe
is an aggregate on every column: Spark runs it as a partial (map-side)
aggregate before the shuffle, so a group of copies holding a large share of
all rows collapses to one row per task before anything is exchanged.
Validity rules are plain predicates; Catalyst pushes them below the dedupe
aggregate and into the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FEEDBACK_STAGES, REPORT_STAGES, stage_columns

# Validity rules per fact table (L-4, L-5): column → (lower, upper) bounds,
# inclusive, None for an open side. ``gps_measure_offset`` is not checked.
VALIDITY_RULES: dict[str, dict[str, tuple]] = {
    "courier_feedback": {
        **{c: (0, None) for c in stage_columns(FEEDBACK_STAGES)},
        "feedback": (0, None),
        "distance_to_merchant": (0, 1000),
    },
    "courier_report": {c: (0, None) for c in stage_columns(REPORT_STAGES)},
    "courier_device": {},
    "merchant_device": {},
}

# Fill values for columns left NULL by the report ⟕ feedback join (L-9).
NO_NOTIFICATION_FILL = {
    "feedback": 2, "distance_to_merchant": 0.0, "gps_measure_offset": 0,
    "feedback_hour": 24, "feedback_minute": 0, "feedback_second": 0,
}


def _and_all(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def range_predicate(bounds: dict[str, tuple]) -> Column:
    """Conjunction of inclusive range checks (F-1)."""
    preds = []
    for c, (lo, hi) in bounds.items():
        if lo is not None:
            preds.append(F.col(c) >= F.lit(lo))
        if hi is not None:
            preds.append(F.col(c) <= F.lit(hi))
    return _and_all(preds)


def validity_predicate(table: str) -> Column:
    return range_predicate(VALIDITY_RULES[table])


def incomplete_predicate(df: DataFrame) -> Column:
    """True for rows that ``na.drop()`` removes: any NULL, or NaN in a
    floating-point column."""
    preds = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            preds.append(c.isNull() | F.isnan(c))
        else:
            preds.append(c.isNull())
    return reduce(lambda a, b: a | b, preds)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """L-1: drop rows holding any NULL (or NaN)."""
    return df.na.drop(how="any")


def dedupe(df: DataFrame) -> DataFrame:
    """L-2: full-row de-duplication."""
    return df.dropDuplicates()


def clean(df: DataFrame) -> DataFrame:
    """L-3: drop incomplete rows, then duplicates."""
    return dedupe(drop_incomplete(df))


def clean_table(df: DataFrame, table: str) -> DataFrame:
    """L-6: the per-table clean job's transformation."""
    out = clean(df)
    rule = VALIDITY_RULES[table]
    return out.where(range_predicate(rule)) if rule else out


def clean_placed(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """``clean_table`` placed by ``keys``, for a join on them: equal rows have
    equal keys, so one shuffle by key serves the dedupe and the join. Copies
    of a row meet in their key's task, where they collapse as they are read."""
    valid = drop_incomplete(df).where(validity_predicate(table))
    return dedupe(valid.repartition(*keys))


def clean_audit(raw: dict[str, DataFrame]) -> DataFrame:
    """L-7 as data: per table, how many rows each cleaning step removes.

    Columns: table_name, raw_rows, null_rows, duplicate_rows, invalid_rows,
    clean_rows. Steps are counted in cleaning order: NULL rows first, then
    duplicates among complete rows, then distinct complete rows failing the
    validity rule. One grouping on the full row per table (partial
    aggregation first), then a one-row global aggregate.
    """
    parts = []
    for table, df in raw.items():
        cols = df.columns
        grouped = (df.withColumn("_incomplete", incomplete_predicate(df))
                     .withColumn("_valid", validity_predicate(table))
                     .groupBy(*cols, "_incomplete", "_valid")
                     .agg(F.count(F.lit(1)).alias("_copies")))
        complete = ~F.col("_incomplete")
        summary = grouped.agg(
            F.sum("_copies").alias("raw_rows"),
            F.sum(F.when(F.col("_incomplete"), F.col("_copies")).otherwise(0)).alias("null_rows"),
            F.sum(F.when(complete, F.col("_copies") - 1).otherwise(0)).alias("duplicate_rows"),
            F.count(F.when(complete & ~F.col("_valid"), 1)).alias("invalid_rows"),
            F.count(F.when(complete & F.col("_valid"), 1)).alias("clean_rows"),
        )
        parts.append(summary.select(F.lit(table).alias("table_name"), *[
            F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
            for c in ("raw_rows", "null_rows", "duplicate_rows", "invalid_rows", "clean_rows")]))
    return reduce(DataFrame.unionByName, parts)


AUDIT_COLUMNS = ("raw_rows", "null_rows", "duplicate_rows", "invalid_rows", "clean_rows")


def audited_clean(df: DataFrame, table: str, audit: Observation) -> DataFrame:
    """``clean_table`` that takes the numbers of ``clean_audit`` on the way:
    whoever writes the result finds them in ``audit``, from the one scan and
    the one shuffle that the cleaning needs anyway.

    Rows are grouped with their number of copies, incomplete ones as one
    group (their columns blanked, so they collapse before the shuffle). The
    numbers are summed behind that shuffle, in the stage that writes, where
    Spark counts each task once, however often tasks or stages run again;
    the result must therefore be written as it is, without a further shuffle.
    """
    incomplete = incomplete_predicate(df)
    groups = (df.select(*[F.when(~incomplete, F.col(c)).alias(c) for c in df.columns], incomplete.alias("_incomplete"))
                .groupBy(*df.columns, "_incomplete").agg(F.count(F.lit(1)).alias("_copies")))
    complete = ~F.col("_incomplete")
    valid = complete & validity_predicate(table)
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("_copies"))), F.lit(0))
    numbers = [total(F.lit(True)), total(F.col("_incomplete")),
               F.coalesce(F.sum(F.when(complete, F.col("_copies") - 1)), F.lit(0)),
               F.count(F.when(complete & ~valid, 1)), F.count(F.when(valid, 1))]
    return (groups.observe(audit, *[n.cast("long").alias(c) for n, c in zip(numbers, AUDIT_COLUMNS, strict=True)])
                  .where(valid).select(*df.columns))


def audit_frame(spark, audits: dict[str, Observation]) -> DataFrame:
    """The observed numbers of written tables, with the columns of ``clean_audit``."""
    rows = [(table, *[int(seen.get[c]) for c in AUDIT_COLUMNS]) for table, seen in audits.items()]
    return spark.createDataFrame(rows, "table_name string, " + ", ".join(f"{c} bigint" for c in AUDIT_COLUMNS))


def fill_missing(df: DataFrame, values: dict | None = None) -> DataFrame:
    """L-9: fill NULLs column by column."""
    return df.fillna(values or NO_NOTIFICATION_FILL)
