"""Schema-driven fault rows (L-10 .. L-12): a negative fixture for cleaning.

Two kinds of rows are generated for any table schema, on executors with
``spark.range`` (nothing is built on the driver):

* incomplete rows: every string column NULL, integer columns in 1..100,
  double columns in [0, 100);
* identical sentinel rows: strings ``"error"``, numbers -100.

Each kind gets between 1000 and 2000 rows (inclusive). Counts and values are
integer arithmetic on ``seed``, row id and column position, so they are the
same on any number of cores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTINEL_TEXT = "error"
SENTINEL_NUMBER = -100
ROW_RANGE = (1000, 2000)


def row_count(seed: int, kind: int) -> int:
    low, high = ROW_RANGE
    return low + (seed * 7919 + kind * 104_729) % (high - low + 1)


def _null_value(field: T.StructField, position: int, seed: int) -> Column:
    spread = F.col("id") * 7919 + (position * 104_729 + seed * 1_299_709)
    t = field.dataType
    if isinstance(t, T.StringType):
        return F.lit(None).cast(t)
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return (spread % 10_000 / 100.0).cast(t)
    return (spread % 100 + 1).cast(t)


def _sentinel_value(field: T.StructField) -> Column:
    t = field.dataType
    if isinstance(t, T.StringType):
        return F.lit(SENTINEL_TEXT)
    return F.lit(SENTINEL_NUMBER).cast(t)


def fault_rows(spark: SparkSession, schema: T.StructType, seed: int = 7,
               null_rows: int | None = None, sentinel_rows: int | None = None) -> DataFrame:
    n_null = null_rows if null_rows is not None else row_count(seed, 0)
    n_sent = sentinel_rows if sentinel_rows is not None else row_count(seed, 1)
    nulls = spark.range(n_null).select(*[
        _null_value(f, i, seed).alias(f.name) for i, f in enumerate(schema.fields)])
    sentinels = spark.range(n_sent).select(*[_sentinel_value(f).alias(f.name) for f in schema.fields])
    return nulls.unionByName(sentinels)


def inject_faults(df: DataFrame, seed: int = 7, null_rows: int | None = None,
                  sentinel_rows: int | None = None) -> DataFrame:
    """The table with fault rows appended (what L-12 writes back)."""
    faults = fault_rows(df.sparkSession, df.schema, seed, null_rows, sentinel_rows)
    return df.unionByName(faults)
