"""Operator 12, exact dedup with a heavy-hitter split (DataFrame functions only).

Texts are equal when they are the same after removing blanks, tabs and line
ends. Each document becomes one short row (id, length, SHA-256), which is
stored once; texts are not moved. Then

1. Misra-Gries: every task keeps ``COUNTERS`` counters of digests (Spark's
   ``approx_top_k_accumulate``, a Misra-Gries summary whose decrement is the
   counters' median); the summaries are merged in two levels. A digest that
   no counter holds has at most a few ``rows / COUNTERS`` rows.
2. The summary's digests are verified: their rows are counted exactly and the
   row that stays is found by partial aggregation, so a group of a third of
   all rows is one row per task before it is moved.
3. These at most ``COUNTERS`` groups are broadcast; their rows get the answer
   where they are and leave the input of the shuffle.
4. All other rows are shuffled by digest; no group among them is large.

Of equal texts the one with the most code points stays, then the smallest
doc_id (null last); of rows alike in all of that, one stays.

Cases: a null text is empty, and all texts empty after normalisation are one
group; a null doc_id is kept and loses ties; rows that repeat an id are
documents of their own; an empty table gives no rows; other columns of any
name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import full_text, small, stored

# Fixed by the task: the characters that equality ignores.
IGNORED = " \t\n\x0b\x0c\r"
COUNTERS = 1024
# Summaries are merged in this many tasks first, then in one.
MERGE_TASKS = 64


def digest() -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(F.translate(full_text(), IGNORED, ""), 256))


def frequent(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(head): 64-bit heads of at most ``counters`` digests, those of every
    digest with a large share of ``rows`` among them."""
    summaries = (rows.select(F.xxhash64("digest").alias("head"), (F.spark_partition_id() % MERGE_TASKS).alias("part"))
                 .groupBy("part").agg(F.expr(f"approx_top_k_accumulate(head, {counters})").alias("summary")))
    merged = summaries.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(summary, {counters})").alias("summary"))
    items = merged.select(F.expr(f"inline(approx_top_k_estimate(summary, {counters}))"))
    return items.where("count > 1 and item is not null").select(F.col("item").alias("head"))


def winners(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """(digest, best_id, best_tag, rows): the exact size of the groups that
    ``heads`` names and the row of each that stays."""
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id", "tag"))
    found = rows.withColumn("head", F.xxhash64("digest")).join(F.broadcast(heads), "head", "left_semi")
    return (found.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"), best.alias("best"))
            .select("digest", "rows", F.col("best.doc_id").alias("best_id"), F.col("best.tag").alias("best_tag")))


def groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chars."""
    rows = stored(docs.select("doc_id", F.length(full_text()).alias("n"), digest().alias("digest"))
                  .withColumn("tag", F.monotonically_increasing_id()))
    heavy = stored(winners(rows, stored(frequent(rows, counters))))     # at most ``counters`` rows
    settled = rows.join(F.broadcast(heavy), "digest").select(
        "doc_id", F.col("best_id").alias("keep_id"), F.col("rows").alias("group_size"),
        (F.col("tag") == F.col("best_tag")).alias("kept"), "digest", "n")
    group = Window.partitionBy("digest")
    order = group.orderBy(F.desc("n"), F.asc_nulls_last("doc_id"), "tag")
    others = rows.join(F.broadcast(heavy), "digest", "left_anti").select(
        "doc_id", F.first("doc_id").over(order).alias("keep_id"), F.count(F.lit(1)).over(group).alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"), "digest", "n")
    return settled.union(others).select("doc_id", "keep_id", "group_size", "kept",
                                        F.lower(F.hex("digest")).alias("text_sha256"), F.col("n").cast("long").alias("n_chars"))


def keep_one(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents of which ``groups`` says that they stay, with all their columns."""
    found = groups(docs, counters)
    stay = stored(found.where("kept").select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_digest"), F.col("n_chars").alias("_n")))
    twice = stored(found.where("not kept and doc_id <=> keep_id").select(F.unhex("text_sha256").alias("_digest")).distinct())
    rows = docs.withColumns({"_digest": digest(), "_n": F.length(full_text())})
    same = rows["doc_id"].eqNullSafe(stay["_id"]) & (rows["_digest"] == stay["_digest"]) & (rows["_n"] == stay["_n"])
    kept = rows.join(stay, same, "left_semi")
    once = kept.join(small(twice), "_digest", "left_anti")
    repeated = kept.join(small(twice), "_digest", "left_semi").dropDuplicates(["_digest"])
    return once.select(docs.columns).union(repeated.select(docs.columns))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256, n AS n_chars
FROM d WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
