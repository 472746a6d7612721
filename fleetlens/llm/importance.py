"""Operator 13, importance resampling towards a target distribution.

Features are runs of one to three words, hashed into ``BUCKETS`` buckets. The
ratio of a bucket's smoothed shares in target and corpus is its gain; a
document's weight is the sum of its features' gains, and Gumbel noise from a
hash of its id makes the highest scores a draw without replacement.

1. Counts of the corpus and of the target are arrays of ``BUCKETS`` numbers
   per task, summed by bucket; the gains are one array of that length.
2. Array-scored weights: a task hashes a document's words into an array of
   buckets and sums the gains at these places. The scored rows (no texts) are
   stored once.
3. A quantile sketch (KLL) of the scores proposes a bracket around the
   cutoff. Exact counts above and inside validate it; a bracket that misses
   the cutoff is widened until it holds it, at last to the whole line.
4. Only the bracket is sorted to locate the cutoff. What lies above it is
   drawn without having been compared (it is sorted apart, for its ranks);
   what lies below is not moved at all.

Words of a long text are hashed in blocks, so memory does not grow with it.

Cases: a null or empty text has no words, weight 0 and no rank; a null doc_id
counts as empty text in the hash and comes last in ties; rows that repeat an
id are drawn each; an empty table gives no rows; an empty target is one that
holds no feature; other columns of any name are ignored.
"""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_id, bound_batches, full_text, small, stored

# Fixed by the task.
BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
# Lower-cases A-Z; every other ASCII character but digits and letters ends a word.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

BLOCK = 1 << 20
SKETCH_K = 4096
MERGE_TASKS = 64
# First bracket around the cutoff, as shares of the rows on either side.
MARGIN = 0.002


def word_blocks(data: bytes):
    """The words of translated text, in lists of about ``BLOCK`` bytes."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + BLOCK)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def buckets(text: str):
    """(number of words, array of the buckets of the features) per block of
    the text; runs go on from one block to the next. The CRC of a run is that
    of its first words, continued by the next word."""
    last: list[bytes] = []
    for words in word_blocks(text.encode().translate(WORD_BYTES)):
        joined = last + words
        more = [b" " + w for w in joined]
        found = [list(map(crc32, joined))]
        for _ in range(LONGEST - 1):
            found.append(list(map(crc32, more[len(found):], found[-1])))
        # runs that lie in the words carried over were counted with their block
        new = [run[max(0, len(last) - k):] for k, run in enumerate(found)]
        last = joined[len(joined) - min(len(joined), LONGEST - 1):]
        yield len(words), np.array([c for run in new for c in run], dtype=np.uint32) % np.uint32(BUCKETS)


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n): features of all texts by bucket."""
    bound_batches(texts.sparkSession)
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                for _, found in buckets(text):
                    total += np.bincount(found, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], schema=schema)

    shares = texts.select(full_text().alias("text")).mapInArrow(run, "bucket int, n bigint")
    return shares.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket; the counts, ``BUCKETS`` numbers each, come to the driver."""
    s, t = np.zeros(BUCKETS, dtype=object), np.zeros(BUCKETS, dtype=object)
    for table, counts in ((docs, s), (target, t)):
        for r in bucket_counts(table).collect():
            counts[r.bucket] = r.n
    all_s, all_t = int(s.sum()), int(t.sum())
    return np.array([math.floor(1000 * math.log((float(b + 1) * float(all_s + BUCKETS)) / (float(a + 1) * float(all_t + BUCKETS))))
                     for a, b in zip(s, t, strict=True)], dtype=np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the hash of an id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    u = (h.cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def scores(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, words, n_features, weight, score) of every document."""
    gain = gains(docs, target)
    kind, atype = arrow_id(docs, "doc_id")
    schema = pa.schema([("doc_id", atype), ("words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])
    bound_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                words = features = weight = 0
                for n, found in buckets(text):
                    words, features, weight = words + n, features + len(found), weight + int(gain[found].sum())
                out.append((words, features, weight))
            cols = np.array(out, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(atype), *(pa.array(cols[:, i]) for i in range(3))], schema=schema)

    weighed = docs.select("doc_id", full_text().alias("text")).mapInArrow(
        run, f"doc_id {kind}, words bigint, n_features bigint, weight bigint")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id")))


def sketch(rows: DataFrame) -> bytes:
    """A KLL sketch of the scores (bounded size), merged in two levels."""
    parts = (rows.select("score", (F.spark_partition_id() % MERGE_TASKS).alias("part"))
             .groupBy("part").agg(F.kll_sketch_agg_bigint("score", F.lit(SKETCH_K)).alias("sketch")))
    return bytes(parts.agg(F.kll_merge_agg_bigint("sketch", F.lit(SKETCH_K)).alias("sketch")).first().sketch)


def bracket(rows: DataFrame, n: int, k: int, margin: float = MARGIN) -> tuple[int | None, int | None, int]:
    """(low, high, rows above high) such that the ``k``-th highest of the ``n``
    scores lies in [low, high] for certain; None is an open side."""
    summary = rows.sparkSession.createDataFrame([(sketch(rows),)], "sketch binary")
    at = 1 - (k - 0.5) / n
    while True:
        ends = [max(0.0, at - margin), min(1.0, at + margin)]
        low, high = summary.select(F.kll_sketch_get_quantile_bigint("sketch", F.array(*map(F.lit, ends))).alias("q")).first().q
        low, high = (None if ends[0] == 0 else low), (None if ends[1] == 1 else high)
        over = F.lit(False) if high is None else F.col("score") > high
        under = F.lit(False) if low is None else F.col("score") < low
        above, below = rows.agg(F.count_if(over), F.count_if(under)).first()
        if above < k <= n - below:
            return low, high, above
        margin *= 4


def positions(rows: DataFrame, before: int = 0) -> DataFrame:
    """``rows`` with ``position``, from ``before`` + 1 on, by score, then doc_id:
    sorted by ranges and stored, the ranges' sizes summed up."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("tag")]
    ranged = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    ranged = ranged.withColumn("place", F.monotonically_increasing_id())
    part, at = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()      # a row per partition
    starts, total = [], before
    for r in sorted(sizes, key=lambda r: r.part):
        starts.append((r.part, total))
        total += r.n
    first = rows.sparkSession.createDataFrame(starts, "part bigint, start bigint")
    return (ranged.withColumns({"part": part, "at": at}).join(F.broadcast(first), "part")
            .withColumn("position", F.col("start") + F.col("at") + 1).select(*rows.columns, "position"))


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
         margin: float = MARGIN) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null where not drawn) of every
    document: the highest scores of those with ``least_words`` words."""
    rows = stored(scores(docs, target).withColumn("tag", F.monotonically_increasing_id()))
    eligible = F.col("words") >= least_words
    n = rows.where(eligible).count()
    k = n * percent // 100
    out = ["doc_id", "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("bigint").alias("rank")
    if not k:
        return rows.select(*out, undrawn)
    low, high, above = bracket(rows.where(eligible), n, k, margin)
    over = eligible & (F.lit(False) if high is None else F.col("score") > high)
    under = ~eligible | (F.lit(False) if low is None else F.col("score") < low)
    inside = positions(rows.where(~over & ~under), before=above)
    return (rows.where(under).select(*out, undrawn)
            .union(inside.select(*out, F.when(F.col("position") <= k, F.col("position")).alias("rank")))
            .union(positions(rows.where(over)).select(*out, F.col("position").alias("rank"))))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The drawn documents with all their columns; a null id is never drawn here."""
    ids = stored(draw(docs, target, percent, least_words).where("rank is not null and doc_id is not null").select("doc_id").distinct())
    return docs.join(small(ids), "doc_id", "left_semi").select(docs.columns)
