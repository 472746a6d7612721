"""Derive the four raw courier tables from the driver's TPC-H-like tables.

The courier tables are not shipped with the test data, so they are built from
``lineitem``, ``customer`` and ``part`` with integer arithmetic (the rules are
fixed by FIXTURES.md §2). Every derivation is a narrow projection over one
parquet scan: no shuffle, no driver work, and it grows with the input.

Each raw fact table carries deliberate dirt: duplicate rows, a -100 sentinel
hour, NULL delivery hours, out-of-range distances and feedback code 2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def _h(x: Column) -> Column:
    return (x / 3600).cast("int")          # x ≥ 0, so truncation is floor


def _m(x: Column) -> Column:
    return ((x % 3600) / 60).cast("int")


def _s(x: Column) -> Column:
    return (x % 60).cast("int")


def _clock(prefix: str, seconds: Column) -> list[Column]:
    return [_h(seconds).alias(f"{prefix}_hour"), _m(seconds).alias(f"{prefix}_minute"),
            _s(seconds).alias(f"{prefix}_second")]


def _row_number(key: Column) -> Column:
    """A 64-bit key as the 32-bit row number of the raw tables; keys beyond
    wrap, which keeps smaller ones as they are."""
    return (key % 2147483647).cast("int")


def _txt(x: Column) -> Column:
    return x.cast("string")


def _rows(df: DataFrame, fields: dict[str, Column], copy_when: Column) -> DataFrame:
    """One output row per input row, two when ``copy_when`` holds.

    The row's base values are built as one struct inside an ``inline``
    generator: the source is scanned once (no union), and everything
    computed from the generated columns is plain attribute arithmetic.
    Predicates applied later (the cleaning rules) cannot be pushed below the
    generator, so they never inline the derivation arithmetic; that keeps the
    generated code of every stage small enough to be JIT-compiled.
    """
    row = F.struct(*[c.alias(n) for n, c in fields.items()])
    return df.select(F.inline(F.array_repeat(row, F.when(copy_when, 2).otherwise(1))))


def _lineitem_keys() -> dict[str, Column]:
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    return {
        "city_id": _txt(1 + sk % 9),
        "day": (1 + ok % 7).cast("int"),
        "courier_id": F.concat(F.lit("c"), _txt(sk)),
        "shop_id": F.concat(F.lit("s"), _txt(pk % 200)),
        "_a0": (ok * 7919 + F.col("l_linenumber") * 1009) % 86400,   # acceptance, s of day
    }


def courier_report(lineitem: DataFrame) -> DataFrame:
    ok, pk, ln, flag = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"))
    no = _row_number(ok)
    base = _rows(lineitem, {
        "no": no, **_lineitem_keys(),
        "_d1": 60 + (pk * 31) % 900,                   # to arrival
        "_d2": 30 + (ok * 13) % 600,                   # to pickup
        "_d3": 300 + (pk * 17 + ok) % 1800,            # to delivery
        "_bad_acceptance": (flag == "R") & (ln == 7),
        "_no_delivery": (flag == "A") & (ln == 6),
    }, no % 50 == 0)
    a0, d1, d2, d3 = (F.col(c) for c in ("_a0", "_d1", "_d2", "_d3"))
    arr = (a0 + d1) % 86400
    pick = (a0 + d1 + d2) % 86400
    dlv = (a0 + d1 + d2 + d3) % 86400
    acc = _clock("acceptance", a0)
    acc[0] = F.when(F.col("_bad_acceptance"), F.lit(-100)).otherwise(_h(a0)).alias("acceptance_hour")
    dl = _clock("delivery", dlv)
    dl[0] = F.when(F.col("_no_delivery"), F.lit(None).cast("int")).otherwise(_h(dlv)).alias("delivery_hour")
    return base.select("no", "city_id", "day", "courier_id", "shop_id",
                       *acc, *_clock("arrier", arr), *_clock("pickup", pick), *dl)


def courier_feedback(lineitem: DataFrame) -> DataFrame:
    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    offset = (ln - 4).cast("int")
    kept = lineitem.where(((ok + ln) % 3 == 0) & (F.col("l_suppkey") % 9 < 8))
    base = _rows(kept, {
        **_lineitem_keys(),
        "_df": 5 + (pk * 7) % 240,                     # to feedback
        "feedback": F.when(ok % 10 == 0, 2).when(ok % 10 < 4, 0).otherwise(1).cast("int"),
        "distance_to_merchant": F.col("l_quantity") * 24.0,
        "gps_measure_offset": offset,
    }, offset == 3)
    a0 = F.col("_a0")
    return base.select("city_id", "day", "courier_id", "shop_id",
                       *_clock("acceptance", a0), *_clock("feedback", (a0 + F.col("_df")) % 86400),
                       "feedback", "distance_to_merchant", "gps_measure_offset")


def courier_device(customer: DataFrame) -> DataFrame:
    ck = F.col("c_custkey")
    return customer.select(
        _row_number(ck).alias("no"),
        _txt(1 + ck % 10).alias("city_id"),
        (1 + ck % 7).cast("int").alias("day"),
        F.concat(F.lit("c"), _txt(ck)).alias("courier_id"),
        F.concat(F.lit("v"), _txt(F.col("c_nationkey") % 5)).alias("os_version"),
        F.col("c_mktsegment").alias("phone_mode"),
    )


def merchant_device(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    return part.select(
        _row_number(pk).alias("no"),
        F.when(pk % 500 == 499, F.lit("error")).otherwise(_txt(1 + pk % 10)).alias("city_id"),
        (1 + pk % 7).cast("int").alias("day"),
        F.concat(F.lit("s"), _txt(pk % 200)).alias("shop_id"),
        F.concat(F.lit("b"), _txt(pk)).alias("beacon_id"),
        F.col("p_type").alias("manufacturer"),
        F.col("p_brand").alias("brand"),
        F.concat(F.col("p_type"), F.lit(" "), _txt(F.col("p_size"))).alias("model"),
    )


SPREAD_BYTES = 1 << 30


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Enough input tasks for a small scan.

    A small source stored as one row group is one scan task, which would run
    the derivation and the map side of every aggregate alone. If the scan is
    estimated at no more than ``SPREAD_BYTES`` and has fewer splits than the
    cluster has cores, its rows are spread round-robin once (sorted first, so
    a retried task sends the same rows). A larger scan is left as it is: its
    splits are set by ``spark.sql.files.maxPartitionBytes``.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SPREAD_BYTES:
        return df
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


_BUILDERS = {
    "courier_report": ("lineitem", courier_report),
    "courier_feedback": ("lineitem", courier_feedback),
    "courier_device": ("customer", courier_device),
    "merchant_device": ("part", merchant_device),
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw courier table derived from the driver tables under ``sf_dir``."""
    source, build = _BUILDERS[name]
    return build(_read(spark, sf_dir, source))
