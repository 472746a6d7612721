"""Daily sketches, frequent items, key filters, exact split, text clocks."""

import pytest
from pyspark.sql import functions as F

from fleetlens.functions.timeops import parse_clock, text_duration_seconds, time_text
from fleetlens.operators import joins as J
from fleetlens.operators import sketches as S
from fleetlens.operators.ranking import count_by, top_k
from fleetlens.plans import analytics as A
from fleetlens.plans import daily
from fleetlens.plans.features import exact_split, feature_frame
from fleetlens.schemas import FEEDBACK_JOIN_KEYS


def same(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def stored(spark, tables):
    return daily.write_daily(tables, "daily_db")


def test_distinct_counts_of_every_prefix_are_within_the_bound(spark, tables, stored):
    check = {r.day: r for r in daily.distinct_bound_check(tables.report, stored["distinct_days"]).collect()}
    assert sorted(check) == list(range(1, 8)) and all(r.couriers_within and r.shops_within for r in check.values())
    for d in (1, 4, 7):
        rows = tables.report.where(F.col("day") <= d)
        assert (check[d].orders, check[d].couriers, check[d].shops) == tuple(
            rows.agg(F.count("*"), F.count_distinct("courier_id"), F.count_distinct("shop_id")).first())
    # any span, and any column of the key: cities of two days
    span = S.merged_distinct(stored["distinct_days"].where("day in (2, 5)"), "city_id", daily.ITEMS)
    exact = tables.report.where("day in (2, 5)").groupBy("city_id").agg(F.count("*").alias("rows"), F.count_distinct("shop_id").alias("shops"))
    for r in span.join(exact.withColumnRenamed("rows", "n"), "city_id").collect():
        assert r.rows == r.n and abs(r.shop_id_estimate - r.shops) <= max(1, 0.07 * r.shops)
    big = spark.range(300_000).selectExpr("id % 30 as day", "id % 100000 as item")
    merged = S.merged_distinct(S.distinct_sketches(big, "day", "item"), [], "item").first()
    assert merged.rows == 300_000 and abs(merged.item_estimate / 100_000 - 1) < 4 * S.hll_error(S.LG_K)


def test_quantiles_of_every_prefix_are_within_the_bound(spark, tables, stored):
    check = daily.quantile_bound_check(tables.report, stored["work_days"]).collect()
    assert sorted(r.day for r in check) == list(range(1, 8)) and all(r.p01_within and r.p50_within and r.p99_within for r in check)
    values = spark.range(200_000).selectExpr("id % 40 day", "pow(id, 1.5) v")
    got = S.merged_quantiles(S.quantile_sketches(values, "day", F.col("v")), [], [0.01, 0.5, 0.99]).first()
    assert got.n == 200_000
    for p, q in zip([0.01, 0.5, 0.99], got.quantiles):
        assert abs(q ** (1 / 1.5) / 200_000 - p) < S.kll_error(S.KLL_K)
    none = S.quantile_sketches(values.where("day = 1").selectExpr("day", "cast(null as double) v"), "day", F.col("v"))
    assert S.merged_quantiles(none, [], [0.5]).first().quantiles is None
    assert S.merged_quantiles(none, "day", [0.5]).count() == 0


def test_scores_from_daily_rows_equal_those_from_facts(tables, stored):
    ours = daily.courier_final(stored["courier_days"], "exact")
    assert same(ours, A.courier_final(tables.report, tables.feedback, "exact"))
    some = daily.courier_final(stored["courier_days"].where("day < 4"), "exact")
    assert same(some, A.courier_final(tables.report.where("day < 4"), tables.feedback.where("day < 4"), "exact"))
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "courier_report" not in plan and "lineitem" not in plan


@pytest.mark.parametrize("counters", [64, 1024])
def test_heavy_hitters_are_the_exact_top_list(spark, tables, counters):
    for df, keys in ((tables.merchants, ["model"]), (tables.merchants, ["brand"]), (tables.couriers, ["phone_mode", "os_version"])):
        assert S.heavy_hitters(df, keys, 20, counters=counters).collect() == top_k(count_by(df, keys), "count", 20, keys).collect()


def test_heavy_hitters_with_a_long_tail_ties_and_nulls(spark, monkeypatch):
    df = spark.range(60_000).selectExpr(
        "id % 5 as day", "case when id % 10 < 5 then concat('hot', cast(id % 5 * (id % 3) as string)) when id % 11 = 0 then null else concat('t', id) end as a", "id % 2 as b")
    want = top_k(count_by(df, ["a", "b"]), "count", 5, ["a", "b"]).collect()
    summaries = S.item_summaries(df, "day", ["a", "b"], 512)
    items, most, rows = S.candidates(summaries, 512)
    assert rows == 60_000 and 0 < most < 60_000 and len(items) <= 512
    assert S.heavy_hitters(df, ["a", "b"], 5, counters=512, summaries=summaries).collect() == want
    # no item stands out: the list is complete only when everything is counted
    flat = spark.range(60_000).selectExpr("id % 5 as day", "id % 30000 as a")
    monkeypatch.setattr(S, "MOST_COUNTERS", 256)
    assert S.heavy_hitters(flat, "a", 7, counters=64).collect() == top_k(count_by(flat, "a"), "count", 7, ["a"]).collect()
    assert S.heavy_hitters(flat.limit(0), "a", 7).collect() == []


def test_filtered_join_equals_the_join_and_keeps_rows_out_of_the_shuffle(spark, tables, monkeypatch):
    left, right = tables.report.drop("no"), tables.feedback
    for how in ("left", "inner"):
        assert same(J.filtered_join(left, right, FEEDBACK_JOIN_KEYS, how), left.join(right, FEEDBACK_JOIN_KEYS, how))
    flagged = J.may_match(left, J.key_filter(right, FEEDBACK_JOIN_KEYS), FEEDBACK_JOIN_KEYS)
    matched = left.join(right, FEEDBACK_JOIN_KEYS, "left_semi").count()
    passed, n = flagged.where("_may").count(), flagged.count()
    assert matched <= passed <= matched + 0.08 * (n - matched) < n / 2
    odd = spark.createDataFrame([(1, None, "x"), (None, None, "y"), (1, 2, "z"), (1, 2, "z")], "a int, b int, v string")
    other = spark.createDataFrame([(1, 2, "r"), (1, None, "s"), (7, 7, "t"), (1, 2, "u")], "a int, b int, w string")
    for r in (other, other.limit(0)):
        assert same(J.filtered_join(odd, r, ["a", "b"]), odd.join(r, ["a", "b"], "left"))
    monkeypatch.setattr(J, "FILTER_BITS", 64)
    assert J.key_filter(right, FEEDBACK_JOIN_KEYS) is None
    assert same(J.filtered_join(odd, other, ["a", "b"], "inner"), odd.join(other, ["a", "b"], "inner"))


def test_exact_split_counts(spark, tables):
    ff = feature_frame(tables.report)
    for percent in (80, 37, 0, 100):
        got = exact_split(ff.repartition(3), "city_id", percent)
        assert same(got.drop("split"), ff)
        for r in got.groupBy("city_id").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "train").alias("t")).collect():
            assert r.t == -(-r.n * percent // 100)
    assert same(exact_split(ff.repartition(11), "city_id"), exact_split(ff.coalesce(1), "city_id"))
    tiny = spark.createDataFrame([(None, 1), (None, 1), (None, 1), ("", 1), ("a", 2), ("a", 2)], "s string, v int")
    got = {(r.s, r.split): r["count"] for r in exact_split(tiny, "s", 50).groupBy("s", "split").count().collect()}
    assert got == {(None, "train"): 2, (None, "test"): 1, ("", "train"): 1, ("a", "train"): 1, ("a", "test"): 1}
    assert exact_split(tiny.limit(0), "s").count() == 0


def test_clock_texts(spark):
    cases = {"00:00:00": 0, "23:59:59": 86399, "07:05:09": 25509, "24:00:00": None, "7:05:00": None, "07:05": None, "12:60:00": None,
             "12:00:61": None, " 12:00:00": None, "12:00:00 ": None, "ab": None, "": None, None: None, "12-00-00": None, "02:30:00": 9000}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    for zone in ("UTC", "America/New_York", "Asia/Shanghai"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert {r.t: r.s for r in df.select("t", parse_clock(F.col("t")).alias("s")).collect()} == cases
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    d = spark.createDataFrame([("23:50:00", "00:10:00", -85200, 1200), ("10:00:00", "10:00:00", 0, 0), ("24:00:00", "01:00:00", None, None)],
                              "a string, b string, plain bigint, wrapped bigint")
    for r in d.select("plain", "wrapped", text_duration_seconds(F.col("a"), F.col("b")).alias("x"),
                      text_duration_seconds(F.col("a"), F.col("b"), "midnight").alias("y")).collect():
        assert (r.x, r.y) == (r.plain, r.wrapped)


def test_clock_texts_round_trip(tables):
    from fleetlens.functions.timeops import duration_seconds
    r = tables.report
    off = r.where(~text_duration_seconds(time_text("acceptance"), time_text("delivery")).eqNullSafe(duration_seconds("acceptance", "delivery")))
    assert off.count() == 0
