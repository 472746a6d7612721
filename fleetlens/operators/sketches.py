"""Mergeable daily summaries (A-2, A-8, T-3): the facts are read once for a
small table of sketches by day, and any span of days is answered from it.

* Distinct counts: HyperLogLog sketches; a span's sketch is the union of its
  days', with the error of one sketch however many days it covers.
* Quantiles: KLL sketches; merged likewise.
* Frequent items: Misra-Gries summaries (Spark's ``approx_top_k_*``). Their
  counts are only used to name candidates. The candidates are recounted
  exactly, and a bound on what any other item can have proves the list
  complete; while it doesn't, the summary is taken with more counters, at
  last with one for every item.

Sketches have a fixed size, so a summary table has (days x keys) small rows
and its merge is a partial aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import count_by, top_k

LG_K = 12                   # 4096 registers
KLL_K = 400
# Of an HLL sketch with 2^lg_k registers: one standard error (public bound of the sketch).
hll_error = lambda lg_k: 1.04 / math.sqrt(2 ** lg_k)
# Of a KLL sketch: the rank error that 99 of 100 queries keep (published fit of the sketch).
kll_error = lambda k: 2.296 / k ** 0.9021


# ---------------------------------------------------------- distinct counts
def distinct_sketches(df: DataFrame, keys, items, lg_k: int = LG_K) -> DataFrame:
    """Per key group: its rows and an HLL sketch ``{item}_sketch`` of each item column."""
    keys, items = _names(keys), _names(items)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"),
                                 *[F.hll_sketch_agg(c, F.lit(lg_k)).alias(f"{c}_sketch") for c in items])


def merged_distinct(sketches: DataFrame, keys, items) -> DataFrame:
    """Sketches of coarser groups (no ``keys``: of everything), and their
    estimates ``{item}_estimate``."""
    keys, items = _names(keys), _names(items)
    united = sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"),
                                         *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in items])
    return united.withColumns({f"{c}_estimate": F.hll_sketch_estimate(f"{c}_sketch") for c in items})


# ---------------------------------------------------------------- quantiles
def quantile_sketches(df: DataFrame, keys, value: Column, k: int = KLL_K) -> DataFrame:
    """Per key group: the values counted, and a KLL sketch of them (NULLs out)."""
    return (df.withColumn("_v", value.cast("double")).groupBy(*_names(keys))
            .agg(F.count("_v").alias("n"), F.kll_sketch_agg_double("_v", F.lit(k)).alias("sketch")))


def merged_quantiles(sketches: DataFrame, keys, probs, k: int = KLL_K) -> DataFrame:
    """``n`` and the array ``quantiles`` (one per probability) of coarser groups."""
    merged = (sketches.where("n > 0").groupBy(*_names(keys))
              .agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch")))
    found = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs]))
    return merged.withColumn("quantiles", F.when(F.col("n") > 0, found))         # without keys, no values give one row of NULLs


# ----------------------------------------------------------- frequent items
def item_text(keys) -> Column:
    """Several key columns as one text that splits again (NULL keys apart from texts)."""
    return F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in _names(keys)]), {"ignoreNullFields": "false"})


def item_summaries(df: DataFrame, by, keys, counters: int) -> DataFrame:
    """Per group of ``by``: rows and a summary of the frequent items (texts of ``keys``)."""
    return (df.withColumn("_item", item_text(keys)).groupBy(*_names(by))
            .agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(_item, {counters})").alias("summary")))


def candidates(summaries: DataFrame, counters: int) -> tuple[list[str], int, int]:
    """(items, the most rows that an item not among them can have, all rows)."""
    merged = summaries.groupBy(F.lit("all").alias("_all")).agg(
        F.sum("rows").alias("rows"), F.expr(f"approx_top_k_combine(summary, {counters})").alias("summary"))
    first = merged.select("rows", F.expr(f"approx_top_k_estimate(summary, {counters})").alias("items")).first()
    if first is None:
        return [], 0, 0
    if sum(i["count"] for i in first["items"]) == first["rows"]:
        return [i["item"] for i in first["items"]], 0, first["rows"]        # no counter was ever given up
    # A summary errs by at most 3.5 / counters of the rows; it names every item
    # whose lower bound passes its error, so others have twice that at most.
    return [i["item"] for i in first["items"]], math.ceil(7 * first["rows"] / counters), first["rows"]


MOST_COUNTERS = 1 << 16


def heavy_hitters(df: DataFrame, keys, n: int, by=("day",), counters: int = 1024, name: str = "count",
                  summaries: DataFrame | None = None) -> DataFrame:
    """The ``n`` most frequent items with exact counts, ties broken by the keys:
    the rows of ``top_k(count_by(df, keys), ...)``, but only candidates are
    counted by key. ``summaries`` may be stored ones with ``counters`` counters."""
    keys = _names(keys)
    while counters <= MOST_COUNTERS:
        found = summaries if summaries is not None else item_summaries(df, by, keys, counters)
        items, most, rows = candidates(found, counters)
        named = df.sparkSession.createDataFrame([(i,) for i in items], "_item string")         # at most ``counters`` rows
        exact = count_by(df.withColumn("_item", item_text(keys)).join(F.broadcast(named), "_item", "left_semi").drop("_item"), keys, name)
        best = top_k(exact, name, n, tie_break=keys)
        if not most:
            return best
        kept = best.agg(F.count(F.lit(1)).alias("k"), F.min(name).alias("least")).first()
        if kept.k == n and kept.least > most:
            return best
        summaries, counters = None, counters * 4
    return top_k(count_by(df, keys, name), name, n, tie_break=keys)


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)
