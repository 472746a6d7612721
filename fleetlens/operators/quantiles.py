"""Quantile bounds (A-8) as lazy one-row DataFrames.

``mode="approx"`` is ``percentile_approx``: a mergeable sketch of bounded
size per task (relative rank error ``1/accuracy``; accuracy 1000 gives the
0.001 error of ``approxQuantile``). It is the default at scale.

``mode="exact"`` gives ``percentile_disc`` results (the value at 1-based
position ``ceil(p * n)`` of the sorted column) without gathering a column
into one task:

1. stack the columns as ``(column index, value)`` and pre-aggregate to a
   histogram ``(column, value) → copies`` (hot values collapse map-side);
2. range-partition the histogram on ``(column, value)`` and checkpoint it
   into the shared checkpoint folder: the partition numbers of the stored
   frame are fixed, so both branches below see the same value ranges (two
   separately sampled range exchanges could disagree), and the lineage is
   cut before the reads that follow;
3. copies per ``(partition, column)`` → running offsets and column totals,
   joined back with a broadcast bounded by partitions × columns rows;
4. a running sum inside each partition gives each value's global
   cumulative count; the answer for ``p`` is the smallest value whose
   cumulative count reaches ``ceil(p * n)``.

Every step is a distributed aggregate, sort or window over one partition's
share of the distinct values; only the last one-row aggregate is global.
Exact mode writes the histogram when the frame is built (an eager job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def quantile_name(col: str, p: float) -> str:
    pct = round(p * 100, 6)
    txt = f"{int(pct):02d}" if pct == int(pct) else str(pct).replace(".", "_")
    return f"{col}_p{txt}"


def approx_quantiles(df: DataFrame, cols, probs, accuracy: int = 1000) -> DataFrame:
    aggs = [F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(f"_{i}")
            for i, c in enumerate(cols)]
    row = df.agg(*aggs)
    return row.select(*[F.col(f"_{i}")[j].alias(quantile_name(c, p))
                        for i, c in enumerate(cols) for j, p in enumerate(probs)])


def exact_quantiles(df: DataFrame, cols, probs, partitions: int | None = None) -> DataFrame:
    """Without ``partitions``, AQE sizes the range exchange from the histogram
    (it only merges adjacent partitions, so each stays a contiguous range)."""
    spark = df.sparkSession
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v"))
        for i, c in enumerate(cols)])).alias("_e")).select("_e._c", "_e._v")
    hist = (stacked.where(F.col("_v").isNotNull())
                   .groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n")))
    ensure_checkpoint_dir(spark)
    by_range = (hist.repartitionByRange(partitions, "_c", "_v") if partitions
                else hist.repartitionByRange("_c", "_v"))
    ranged = (by_range.checkpoint(eager=True)
                  .withColumn("_pid", F.spark_partition_id()))
    by_col = Window.partitionBy("_c")
    offsets = (ranged.groupBy("_pid", "_c").agg(F.sum("_n").alias("_pn"))
                     .withColumn("_off", F.coalesce(F.sum("_pn").over(
                         by_col.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                     .withColumn("_tot", F.sum("_pn").over(by_col))
                     .drop("_pn"))
    # `offsets` has at most (range partitions ≤ shuffle partitions) × len(cols)
    # rows: a proven broadcast bound.
    within = (Window.partitionBy("_pid", "_c").orderBy("_v")
                    .rowsBetween(Window.unboundedPreceding, 0))
    cum = (ranged.join(F.broadcast(offsets), ["_pid", "_c"])
                 .withColumn("_cum", F.col("_off") + F.sum("_n").over(within)))
    picks = []
    for i, c in enumerate(cols):
        for p in probs:
            target = F.greatest(F.ceil(F.lit(float(p)) * F.col("_tot")), F.lit(1))
            hit = (F.col("_c") == i) & (F.col("_cum") >= target)
            picks.append(F.min(F.when(hit, F.col("_v"))).alias(quantile_name(c, p)))
    return cum.agg(*picks)


def quantile_bounds(df: DataFrame, cols, probs=(0.01, 0.99), mode: str = "approx",
                    accuracy: int = 1000) -> DataFrame:
    """One row holding ``{col}_p{NN}`` for every column and probability."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    if mode == "approx":
        return approx_quantiles(df, cols, probs, accuracy)
    if mode == "exact":
        return exact_quantiles(df, cols, probs)
    raise ValueError(f"unknown quantile mode {mode!r}")
