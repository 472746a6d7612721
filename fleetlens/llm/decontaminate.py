"""Operator 9, benchmark decontamination by SimHash windows, with DataFrame and
SQL functions only.

A window of a document as long as a benchmark item (in words) is contaminated
if the weighted Jaccard similarity of their five-word shingles is at least
the threshold; at the end of a text, what is left of it is a window too.
Both have S shingles, so a window may lack at most S/9 of
the item's at 0.8; between the lacking ones lies a run of shared shingles of
a known length. Looking up every ``stride``-th shingle of a document, with
``stride`` the shortest such run over all items, therefore hits each
contaminated window. In the documents and items that it pairs, every shingle
is looked up, and the windows that hold enough of the item's are counted out
by running sums; in which order the shingles stand doesn't matter, as it
doesn't in the similarity.

SimHash fingerprints (64 bits, shingles weighted by their counts) of those
windows are compared with the item's by multi-index blocks: two fingerprints
within ``RADIUS`` bits agree in one of ``RADIUS + 1`` blocks entirely. (A pair
at the threshold differs in 9.7 bits on average, and in more than 20 with
probability 0.0006.) Pairs within the radius are verified by exact similarity.

The tables of the benchmark are broadcast if they are small, otherwise
joined by shuffle.

Cases: null or empty texts and items have no words and match nothing; an item
of fewer than five words is one shingle, looked up at every word; repeated rows give one result;
documents or items with a null id are left out; other columns are ignored;
empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import full_text, small, stored

WORDS, THRESHOLD, RADIUS = 5, 0.8, 20
BROADCAST_GRAMS = 500_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"(?U)\W+"), "")


def shingles(ws: str) -> Column:
    """Hashes of all five-word shingles of array ``ws``; fewer words are one shingle."""
    return F.expr(f"transform(sequence(0, greatest(size({ws}) - {WORDS}, 0)), i -> xxhash64(slice({ws}, i + 1, {WORDS})))")


def simhash(h: str) -> Column:
    """64-bit SimHash of array ``h`` of hashes; repeated ones weigh more."""
    return F.expr(f"""aggregate(sequence(0, 63), 0L, (f, b) -> f | shiftleft(
        IF(aggregate({h}, 0, (s, x) -> s + CAST(shiftrightunsigned(x, b) & 1L AS INT) * 2 - 1) > 0, 1L, 0L), b))""")


def blocks(f: str) -> Column:
    """(block, value) of the ``RADIUS + 1`` blocks of fingerprint ``f``."""
    n = RADIUS + 1
    return F.expr(f"""transform(sequence(0, {RADIUS}), k -> struct(k as block,
        shiftrightunsigned({f}, CAST(k * 64 / {n} AS INT))
          & (shiftleft(1L, CAST((k + 1) * 64 / {n} AS INT) - CAST(k * 64 / {n} AS INT)) - 1L) as value))""")


def weighted_jaccard(a: str, b: str) -> Column:
    common = f"""aggregate(array_intersect({a}, {b}), 0, (s, x) -> s
        + least(size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x))))"""
    return F.expr(f"CAST({common} AS DOUBLE) / (size({a}) + size({b}) - {common})")


def items(benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(item_id, n, grams, lost, run, fingerprint) of the items that have words.
    ``lost`` is how many shingles a match may lack, ``run`` the least longest
    run of shared ones."""
    most = (1 - threshold) / (1 + threshold)
    return (benchmark.where("item_id is not null").select("item_id", words(full_text()).alias("ws")).distinct()
            .where("size(ws) > 0")
            .select("item_id", F.size("ws").alias("n"), shingles("ws").alias("grams"))
            .withColumn("lost", F.floor(F.size("grams") * F.lit(most) + 1e-9).cast("int"))
            .withColumn("run", F.ceil((F.size("grams") - F.col("lost")) / (F.col("lost") + 1)).cast("int"))
            .withColumn("fingerprint", simhash("grams")))


def starts(by_word: DataFrame, item: DataFrame, asked: DataFrame, widths: list[int], threshold: float) -> DataFrame:
    """(doc_id, item_id, n, start) of the windows of pairs ``asked`` in which
    enough shingles are the item's, wherever in the item they stand.

    Each such place counts for the windows that hold it, from its first start
    to its last: running sums over these ends give every window's count."""
    grams = ", ".join(f"""transform(sequence(0, greatest(size(ws) - {w}, 0)),
        i -> struct(i as at, xxhash64(slice(ws, i + 1, {w})) as gram, {w} as width))""" for w in widths)
    places = (by_word.join(small(asked.select("doc_id").distinct()), "doc_id", "left_semi")
              .select("doc_id", F.expr(f"explode(concat({grams}))").alias("s")).select("doc_id", "s.*"))
    # fewer shared shingles than this cannot reach the threshold, not even in a text that ends before the window
    known = small(item.select("item_id", "n", F.size("grams").alias("size"), F.least("n", F.lit(WORDS)).alias("width"),
                              F.ceil(F.size("grams") * F.lit(threshold) - 1e-9).cast("int").alias("need"),
                              F.explode(F.array_distinct("grams")).alias("gram")), BROADCAST_GRAMS)
    found = places.join(known, ["gram", "width"]).join(asked, ["doc_id", "item_id"], "left_semi")
    ends = found.select("doc_id", "item_id", "n", "need", F.explode(F.array(
        F.struct(F.greatest(F.col("at") - F.col("size") + 1, F.lit(0)).alias("place"), F.lit(1).alias("change")),
        F.struct((F.col("at") + 1).alias("place"), F.lit(-1).alias("change")))).alias("e"))
    steps = ends.groupBy("doc_id", "item_id", "n", "need", "e.place").agg(F.sum("e.change").alias("change"))
    pair = Window.partitionBy("doc_id", "item_id").orderBy("place")
    counted = steps.select("doc_id", "item_id", "n", "need", "place", F.sum("change").over(pair).alias("shared"),
                           F.lead("place").over(pair).alias("next"))
    return (counted.where("shared >= need")
            .select("doc_id", "item_id", "n", F.explode(F.sequence("place", F.col("next") - 1)).alias("start")))


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, start_word, similarity): the best window of each pair."""
    item = stored(items(benchmark, threshold))
    stride = item.where(F.col("n") >= WORDS).agg(F.min("run")).first()[0] or WORDS
    short = [r[0] for r in item.where(F.col("n") < WORDS).select("n").distinct().collect()]      # at most WORDS - 1
    steps = [(WORDS, stride), *[(n, 1) for n in sorted(short)]]
    looked_up = ", ".join(f"""transform(sequence(0, greatest(size(ws) - {w}, 0), {step}),
        i -> xxhash64(slice(ws, i + 1, {w})))""" for w, step in steps)
    lookup = small(item.select("item_id", F.explode("grams").alias("gram")).distinct(), BROADCAST_GRAMS)
    own = docs.where("doc_id is not null").select("doc_id", full_text().alias("text"))
    by_word = own.select("doc_id", words(F.col("text")).alias("ws")).where("size(ws) > 0")
    sampled = by_word.select("doc_id", F.expr(f"explode(array_distinct(concat({looked_up})))").alias("gram"))
    asked = stored(sampled.join(lookup, "gram").select("doc_id", "item_id").distinct())
    hits = stored(starts(by_word, item, asked, [WORDS, *sorted(short)], threshold)
                  .groupBy("doc_id", "item_id", "n").agg(F.collect_list("start").alias("starts")))
    window = (own.join(small(hits), "doc_id")
              .select("doc_id", "item_id", "n", "starts", words(F.col("text")).alias("ws"))
              .select("doc_id", "item_id", F.explode(F.expr(f"""transform(filter(starts, s -> s < size(ws)), s -> struct(
                  s as start_word, transform(sequence(0, greatest(least(n, size(ws) - s) - {WORDS}, 0)),
                      i -> xxhash64(slice(ws, s + i + 1, least({WORDS}, n - i)))) as h))""")).alias("w"))
              .select("doc_id", "item_id", "w.*")
              .withColumn("f", simhash("h")))
    index = small(item.select("item_id", F.explode(blocks("fingerprint")).alias("b")).select("item_id", "b.*"), BROADCAST_GRAMS)
    near = (window.withColumn("b", F.explode(blocks("f"))).select(*window.columns, "b.*")
            .join(index, ["item_id", "block", "value"]))
    exact = small(item.select("item_id", "grams", "fingerprint"), BROADCAST_GRAMS // 50)
    return (near.join(exact, "item_id").where(F.bit_count(F.expr("f ^ fingerprint")) <= RADIUS)
            .groupBy("doc_id", "item_id", "start_word").agg(F.first("h").alias("h"), F.first("grams").alias("grams"))
            .withColumn("similarity", weighted_jaccard("h", "grams")).where(F.col("similarity") >= threshold)
            .groupBy("doc_id", "item_id")
            .agg(F.min_by("start_word", F.struct(-F.col("similarity"), "start_word")).cast("bigint").alias("start_word"),
                 F.max("similarity").alias("similarity")))
