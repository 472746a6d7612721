"""Equi-joins that stay balanced when one key holds a large share of rows.

``skew_safe_join(left, right, on, how)`` handles keys that are hot on the
``right`` side (the side whose rows fan out per key). It is one lazy plan:

1. count right rows per key (partial aggregation, then one row per key and
   task is shuffled); a key is hot when it holds more than ``target_rows``
   rows, an absolute number, and gets ``ceil(rows / target_rows)`` salts, so
   a salt holds about ``target_rows`` rows however hot the key is;
2. cold keys join normally (sort-merge at scale; AQE may still split a
   skewed *left* partition, which it can do for inner and left joins);
3. hot right rows are reduced to distinct rows with a multiplicity and
   spread over their key's salts by a hash of their content (deterministic,
   so a retried task sends every row to the same salt); each hot left row is
   replicated once per salt, which its output outnumbers by ``target_rows``.
   Multiplicities are expanded after the join.

The list of hot keys is joined without a hint: AQE broadcasts it from its
measured size or shuffles it. Every hot key exists on the right, so for
those rows a left outer join and an inner join give the same result; the two
parts are unioned. No rows are dropped or sampled.

``filtered_join(left, right, on, how)`` is for a left side of which most rows
find no partner: a broadcast filter of the right side's keys keeps them out
of the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SALTS = "_salts"
TARGET_ROWS = 1_000_000


def hot_keys(right: DataFrame, on: list[str], target_rows: int = TARGET_ROWS) -> DataFrame:
    """Keys of ``right`` with more than ``target_rows`` rows, and their salts."""
    counts = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    return (counts.where(F.col("_rows") > target_rows)
            .select(*on, F.ceil(F.col("_rows") / target_rows).cast("int").alias(SALTS)))


# A key filter is broadcast: 16 MB at most. Beyond that many keys it would let
# most rows pass, and the join runs without it.
FILTER_BITS = 1 << 27
BITS_PER_KEY = 32


def _bit(on: list[str], bits: int):
    return F.pmod(F.xxhash64(*on), F.lit(bits)) + 1          # Spark's bitmap blocks count from 1


def key_filter(right: DataFrame, on: list[str], keys: int | None = None) -> tuple[DataFrame, int] | None:
    """A Bloom filter (one hash) of the right side's keys: stored rows
    (block, 4 KB of bits) and the number of bits; None if the keys are too
    many for ``FILTER_BITS``. ``keys`` is their number where it is known;
    else a sketch counts them. The bits are set by partial aggregation."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    keyed = right.where(whole).select(*on)
    if keys is None:
        keys = keyed.agg(F.approx_count_distinct(F.xxhash64(*on))).first()[0]
    if keys * BITS_PER_KEY > FILTER_BITS:
        return None
    bits = max(1 << 15, 1 << (max(1, keys) * BITS_PER_KEY - 1).bit_length())
    at = keyed.select(_bit(on, bits).alias("_at"))
    return materialize(at.groupBy(F.bitmap_bucket_number("_at").alias("_block"))
                       .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits"))), bits


def may_match(left: DataFrame, found: tuple[DataFrame, int], on: list[str], name: str = "_may") -> DataFrame:
    """``left`` with a flag that is false only on rows whose key no right row has."""
    blocks, bits = found
    place = F.bitmap_bit_position(F.col("_at"))
    byte = F.conv(F.hex(F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    keyed = left.withColumn("_at", _bit(on, bits)).withColumn("_block", F.bitmap_bucket_number("_at"))
    flag = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    for c in on:
        flag = flag & F.col(c).isNotNull()
    return keyed.join(F.broadcast(blocks), "_block", "left").withColumn(name, flag).select(*left.columns, name)


def filtered_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", keys: int | None = None) -> DataFrame:
    """``left.join(right, on, how)`` that shuffles only left rows which may have
    a match. The rest, in a left join, get their NULLs where they are read;
    the left side is scanned for each of the two parts. Building it runs the
    jobs of the filter."""
    if how not in ("inner", "left"):
        raise ValueError("filtered_join supports inner and left joins")
    found = key_filter(right, on, keys)
    if found is None:
        return left.join(right, on, how)
    flagged = may_match(left, found, on)
    joined = flagged.where("_may").drop("_may").join(right, on, how)
    if how == "inner":
        return joined
    types = {f.name: f.dataType for f in right.schema.fields}
    alone = flagged.where("not _may").select(*[F.lit(None).cast(types[c]).alias(c) if c not in left.columns else F.col(c) for c in joined.columns])
    return joined.unionByName(alone)


def skew_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
                   target_rows: int = TARGET_ROWS) -> DataFrame:
    if how not in ("inner", "left"):
        raise ValueError("skew_safe_join supports inner and left joins")
    hot = hot_keys(right, on, target_rows)
    lm = left.join(hot, on, "left")
    rm = right.join(hot, on, "left")
    is_cold = F.col(SALTS).isNull()

    cold = lm.where(is_cold).drop(SALTS).join(rm.where(is_cold).drop(SALTS), on, how)

    rcols = right.columns
    r_hot = (rm.where(~is_cold)
               .groupBy(*rcols, SALTS).agg(F.count(F.lit(1)).alias("_mult"))
               .withColumn("_salt", F.pmod(F.xxhash64(*rcols), F.col(SALTS)).cast("int")).drop(SALTS))
    l_hot = (lm.where(~is_cold)
               .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col(SALTS) - 1))).drop(SALTS))
    hot_part = (l_hot.join(r_hot, on + ["_salt"], "inner")
                     .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_mult").cast("int"))))
                     .drop("_salt", "_mult", "_copy"))
    return cold.unionByName(hot_part.select(*cold.columns))
