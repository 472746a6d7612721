"""Ranking, dimensions, quantiles, scores and the skew-safe join."""

import random

import pytest
from pyspark.sql import functions as F

from fleetlens.functions.scoring import clamped_score
from fleetlens.operators.joins import skew_safe_join
from fleetlens.operators.quantiles import quantile_bounds
from fleetlens.operators.ranking import count_by, favourite, rank_within, top_k
from fleetlens.plans import analytics as A
from fleetlens.sources.dims import CITY_DIM, FEEDBACK_DIM


def test_rank_keeps_ties(spark):
    df = spark.createDataFrame([("d", f"s{i}", 5) for i in range(4)] + [("d", "s9", 1)],
                               "day string, shop_id string, n int")
    assert rank_within(df, "day", "n", 3).count() == 4


def test_favourite_tie_is_alphabetical(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "z")], "g int, item string")
    got = {r.g: (r.item, r["count"]) for r in favourite(df, "g", "item").collect()}
    assert got == {1: ("a", 2), 2: ("z", 1)}


def test_top_k_total_order(spark):
    df = spark.createDataFrame([(c,) for c in "edcba" for _ in range(2)], "k string")
    got = [r.k for r in top_k(count_by(df, "k"), "count", 3, tie_break=["k"]).collect()]
    assert got == ["a", "b", "c"]


def test_dirty_city_falls_out_of_join(spark):
    df = spark.createDataFrame([("error",), (None,), ("3",), ("11",)], "city_id string")
    got = [r.city_name for r in CITY_DIM.join(df, "city_id").collect()]
    assert got == ["深圳"]


def test_unknown_feedback_code_dropped(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "feedback int")
    assert sorted(r.feedback for r in FEEDBACK_DIM.join(df, "feedback").collect()) == [0, 1]


def test_exact_quantiles_match_percentile_disc(spark):
    rnd = random.Random(5)
    for n in (1, 7, 100, 999):
        vals = [float(rnd.randint(0, 40)) for _ in range(n)] + [None]
        df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(vals)], "a double, b double")
        probs = (0.01, 0.07, 0.5, 0.99)
        mine = quantile_bounds(df, ["a", "b"], probs, mode="exact").first()
        ref = df.selectExpr(*[f"percentile_disc({p}) within group (order by {c})" for c in "ab" for p in probs]).first()
        assert list(mine) == list(ref), n


def test_approx_quantiles_close(spark):
    df = spark.range(10000).withColumn("v", F.col("id").cast("double"))
    r = quantile_bounds(df, ["v"], (0.01, 0.99), mode="approx").first()
    assert abs(r.v_p01 - 100) <= 10 and abs(r.v_p99 - 9900) <= 10


def test_flat_scores_take_first_branch(spark):
    df = spark.createDataFrame([(5.0,)], "v double")
    r = df.select(clamped_score(F.col("v"), F.lit(5.0), F.lit(5.0), False).alias("work"),
                  clamped_score(F.col("v"), F.lit(5.0), F.lit(5.0), True).alias("orders")).first()
    assert (r.work, r.orders) == (100.0, 0.0)


def test_scores_in_range(tables):
    out = A.courier_final(tables.report, tables.feedback, quantile_mode="exact")
    r = out.agg(F.min("final_score").alias("lo"), F.max("final_score").alias("hi")).first()
    assert 0.0 <= r.lo <= r.hi <= 100.0


def test_empty_input(spark):
    from fleetlens.schemas import SCHEMAS
    rep = spark.createDataFrame([], SCHEMAS["courier_report"])
    fb = spark.createDataFrame([], SCHEMAS["courier_feedback"])
    r = A.average_delivery_time(rep).collect()
    assert len(r) == 1 and r[0].average_delivery_second is None
    assert A.avg_response_time(fb).first().avg_response_second is None
    assert A.shop_top_by_day(fb).count() == 0
    assert A.courier_final(rep, fb, quantile_mode="exact").count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_safe_join_equals_plain_join(spark, how):
    left = spark.createDataFrame([(k, i) for i in range(300) for k in ("hot", f"k{i % 7}", None)],
                                 "k string, a int")
    right = spark.createDataFrame([("hot", j % 50) for j in range(400)] + [(f"k{j}", j) for j in range(5)]
                                  + [("hot", 1)] * 3, "k string, b int")
    got = skew_safe_join(left, right, ["k"], how, target_rows=10)
    want = left.join(right, ["k"], how)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_exact_quantiles_over_coalesced_ranges(spark):
    # a tiny advisory size makes AQE keep many (merged, adjacent) range partitions
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        df = spark.range(40000).select((F.col("id") * 7919 % 10007).cast("double").alias("v"),
                                       (F.col("id") % 97).cast("double").alias("w"))
        probs = (0.01, 0.33, 0.99)
        mine = quantile_bounds(df, ["v", "w"], probs, mode="exact").first()
        ref = df.selectExpr(*[f"percentile_disc({p}) within group (order by {c})"
                              for c in ("v", "w") for p in probs]).first()
        assert list(mine) == list(ref)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
