"""The named delivery-operations analytics (N-1 .. N-21).

Each function takes clean courier tables and returns one lazy DataFrame: no
action, no driver round trip. Scalars (averages, quantile bounds) stay
inside the plan as one-row aggregates or scalar subqueries, so the caller
decides when and where the work runs. The exception is ``courier_final``
when it is asked to store its per-courier frame (always in exact mode),
which runs jobs while it is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import clamped_score, weighted_sum
from ..functions.timeops import duration_seconds, response_seconds, time_text
from ..operators.quantiles import quantile_bounds, quantile_name
from ..operators.ranking import count_by, favourite, rank_within, sort_desc, top_k
from ..session import materialize
from ..sources.dims import CITY_DIM, CONFIRM, FEEDBACK_DIM, TRY_LATER

# Parameters of the reference analyses.
BUSY_HOUR_MIN_COUNT = 1000
TOP_RANK = 3
TOP_N = 20
SCORE_QUANTILES = (0.01, 0.99)
SCORE_WEIGHTS = {"work_duration_score": 0.4, "order_count_score": 0.6}


# ---------------------------------------------------------------- report
def dataset_summary(report: DataFrame, approx: bool = False) -> DataFrame:
    """N-1: orders, cities, couriers, shops in one aggregate (A-1 count, A-2
    three count-distincts; ``approx=True`` uses HyperLogLog sketches)."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return report.agg(
        F.count(F.lit(1)).alias("orders"),
        distinct("city_id").alias("cities"),
        distinct("courier_id").alias("couriers"),
        distinct("shop_id").alias("shops"),
    )


def order_work_duration(report: DataFrame) -> DataFrame:
    """N-7: report rows with ``HH:mm:ss`` acceptance / delivery text and the
    work duration in seconds, wrapped past midnight."""
    return report.withColumns({
        "acceptance_time": time_text("acceptance"),
        "delivery_time": time_text("delivery"),
        "work_duration_seconds": duration_seconds("acceptance", "delivery", wrap="midnight"),
    })


def courier_avg_work_duration(report: DataFrame) -> DataFrame:
    """N-8."""
    return (report.withColumn("_w", duration_seconds("acceptance", "delivery", wrap="midnight"))
                  .groupBy("courier_id")
                  .agg(F.avg("_w").alias("avg_work_duration_seconds")))


def _with_delivery_seconds(report: DataFrame, wrap: str = "none") -> DataFrame:
    return report.withColumn("total_delivery_time_seconds",
                             duration_seconds("acceptance", "delivery", wrap=wrap))


def average_delivery_time(report: DataFrame, wrap: str = "none") -> DataFrame:
    """N-10: mean delivery time, by default without midnight wrap (overnight
    orders count negative, as in the source analysis); ``wrap="midnight"``
    counts them right. A-3 average and P-13 seconds → minutes, kept as a lazy
    one-row frame (S-8)."""
    avg = F.avg("total_delivery_time_seconds")
    return _with_delivery_seconds(report, wrap).agg(
        avg.alias("average_delivery_second"), (avg / 60).alias("average_delivery_minute"))


def delivery_time_by_city_hour(report: DataFrame, min_count: int = BUSY_HOUR_MIN_COUNT) -> DataFrame:
    """N-11: mean delivery time and order count per (city, acceptance hour),
    keeping groups with more than ``min_count`` timed orders."""
    d = F.col("total_delivery_time_seconds")
    return (_with_delivery_seconds(report)
            .groupBy("city_id", "acceptance_hour")
            .agg(F.avg(d).alias("avg_delivery_time_seconds"), F.count(d).alias("count"))
            .where(F.col("count") > min_count))


def top_busy_hours_per_city(report: DataFrame, min_count: int = BUSY_HOUR_MIN_COUNT,
                            k: int = TOP_RANK) -> DataFrame:
    """N-12: the ``k`` slowest acceptance hours per city (ties kept), named,
    slowest first; sorted after the join, which would not keep an order."""
    ranked = rank_within(delivery_time_by_city_hour(report, min_count), "city_id",
                         "avg_delivery_time_seconds", k)
    return (CITY_DIM.join(ranked, "city_id")
            .select("city_name", "acceptance_hour", "avg_delivery_time_seconds", "count")
            .orderBy(F.desc("avg_delivery_time_seconds"), "city_name", "acceptance_hour"))


# ---------------------------------------------------------------- feedback
def labelled_feedback(feedback: DataFrame) -> DataFrame:
    """J-1 + P-1: feedback rows with their label and response time. The
    inner join drops codes outside the dimension."""
    return FEEDBACK_DIM.join(feedback.withColumn("response_time_seconds", response_seconds()),
                             "feedback")


def avg_response_time(feedback: DataFrame) -> DataFrame:
    """N-2: A-3 average response time, P-13 in minutes too; one lazy row (S-8)."""
    avg = F.avg("response_time_seconds")
    return labelled_feedback(feedback).agg(avg.alias("avg_response_second"),
                                           (avg / 60).alias("avg_response_minute"))


def courier_response_counts(feedback: DataFrame) -> DataFrame:
    """N-3."""
    return count_by(labelled_feedback(feedback), ["courier_id", "feedback_tran"], "feedback_count")


def response_leaderboard(feedback: DataFrame, label: str) -> DataFrame:
    """N-4 / N-5: couriers by how often they answered with ``label`` (F-2
    string equality, T-1 sort)."""
    counts = courier_response_counts(feedback).where(F.col("feedback_tran") == label)
    return sort_desc(counts, "feedback_count", tie_break=["courier_id"])


def retry_leaderboard(feedback: DataFrame) -> DataFrame:
    return response_leaderboard(feedback, TRY_LATER)


def confirm_leaderboard(feedback: DataFrame) -> DataFrame:
    return response_leaderboard(feedback, CONFIRM)


def courier_order_counts(feedback: DataFrame) -> DataFrame:
    """N-6: labelled notification rows per courier."""
    return sort_desc(count_by(labelled_feedback(feedback), "courier_id", "order_count"),
                     "order_count", tie_break=["courier_id"])


def courier_final(report: DataFrame, feedback: DataFrame, quantile_mode: str = "approx",
                  accuracy: int = 1000, materialize_per_courier: bool = False) -> DataFrame:
    """N-9: per courier, order count and mean work time, scored 0..100
    between their 1% and 99% quantiles and combined 0.4 / 0.6.

    Both inputs are aggregated on ``courier_id`` before the join, so the join
    reads two frames already hash-partitioned on its key. The quantile bounds
    enter as one scalar subquery (no cross join, no driver round trip). The
    per-courier frame (one row per courier) feeds both the bounds and the
    scores, so it is checkpointed once to the shared checkpoint folder
    in exact mode, whose bounds run jobs of their own; approximate mode is a
    lazy plan that reuses the shuffles, unless ``materialize_per_courier``.
    """
    orders = count_by(labelled_feedback(feedback), "courier_id", "order_count")
    per_courier = orders.join(courier_avg_work_duration(report), "courier_id")   # J-4
    stored = quantile_mode == "exact" or materialize_per_courier
    return scored_couriers(materialize(per_courier) if stored else per_courier, quantile_mode, accuracy, stored)


def scored_couriers(per_courier: DataFrame, quantile_mode: str = "approx", accuracy: int = 1000, stored: bool = True) -> DataFrame:
    """The scores of N-9 for a frame of (courier_id, order_count,
    avg_work_duration_seconds), which is ``stored`` or read several times."""
    work, cnt = "avg_work_duration_seconds", "order_count"
    bounds = quantile_bounds(per_courier, [work, cnt], SCORE_QUANTILES, quantile_mode, accuracy)
    if stored:
        # one row: computed once here, so the optimizer's per-field scalar
        # subqueries below each read a stored row instead of re-running it
        bounds = materialize(bounds)
    b = bounds.select(F.struct(*bounds.columns).alias("b")).scalar()
    lo, hi = SCORE_QUANTILES
    scored = per_courier.withColumns({
        "work_duration_score": clamped_score(F.col(work), b[quantile_name(work, lo)],
                                             b[quantile_name(work, hi)], higher_is_better=False),
        "order_count_score": clamped_score(F.col(cnt), b[quantile_name(cnt, lo)],
                                           b[quantile_name(cnt, hi)], higher_is_better=True),
    })
    out = scored.withColumn("final_score", weighted_sum(SCORE_WEIGHTS)).drop(*SCORE_WEIGHTS)
    return sort_desc(out.select("courier_id", cnt, work, "final_score"), "final_score", tie_break=["courier_id"])


def shop_order_counts(feedback: DataFrame) -> DataFrame:
    """N-20: notification rows per shop (all codes), most first."""
    return sort_desc(count_by(feedback, "shop_id", "order_count"), "order_count", tie_break=["shop_id"])


def shop_top_by_day(feedback: DataFrame, k: int = TOP_RANK) -> DataFrame:
    """N-21: the ``k`` busiest shops of each day, ties kept."""
    counts = count_by(feedback, ["day", "shop_id"], "shop_day_count")
    ranked = rank_within(counts, "day", "shop_day_count", k)
    return ranked.orderBy("day", "rank", "shop_id").select("day", "shop_id", "shop_day_count")


# ---------------------------------------------------------------- devices
def _int_city(df: DataFrame) -> DataFrame:
    """P-8: string city key → int; a dirty key becomes NULL, not an error."""
    return df.withColumn("city_id", F.col("city_id").try_cast("int"))


def courier_phone_mode_counts(couriers: DataFrame, n: int = TOP_N) -> DataFrame:
    """N-13."""
    return top_k(count_by(couriers, "phone_mode"), "count", n, tie_break=["phone_mode"])


def courier_os_version_counts(couriers: DataFrame, n: int = TOP_N) -> DataFrame:
    """N-14."""
    return top_k(count_by(couriers, ["phone_mode", "os_version"]), "count", n,
                 tie_break=["phone_mode", "os_version"])


def _city_favourite(df: DataFrame, item: str, n: int) -> DataFrame:
    fav = favourite(_int_city(df), "city_id", item)
    return (CITY_DIM.join(fav, "city_id").orderBy("city_id").limit(n)
            .select("city_name", item, "count"))


def courier_city_phone_mode_favourite(couriers: DataFrame, n: int = TOP_N) -> DataFrame:
    """N-15: the most common phone model per city."""
    return _city_favourite(couriers, "phone_mode", n)


def shop_brand_counts(merchants: DataFrame, n: int = TOP_N) -> DataFrame:
    """N-16."""
    return top_k(count_by(merchants, "brand"), "count", n, tie_break=["brand"])


def shop_model_counts(merchants: DataFrame, n: int = TOP_N) -> DataFrame:
    """N-17."""
    return top_k(count_by(merchants, "model"), "count", n, tie_break=["model"])


def shop_city_model_favourite(merchants: DataFrame, n: int = TOP_N) -> DataFrame:
    """N-18: the most common merchant device model per city."""
    return _city_favourite(merchants, "model", n)


def city_courier_merchant_counts(couriers: DataFrame, merchants: DataFrame,
                                 distinct: bool = False) -> DataFrame:
    """N-19: device rows per city on both sides (``distinct=True``: couriers
    and shops instead of rows); J-4 joins the two per-city aggregates, J-2
    names the city."""
    if distinct:
        c = _int_city(couriers).groupBy("city_id").agg(F.count_distinct("courier_id").alias("courier_count"))
        m = _int_city(merchants).groupBy("city_id").agg(F.count_distinct("shop_id").alias("merchant_count"))
    else:
        c = count_by(_int_city(couriers), "city_id", "courier_count")
        m = count_by(_int_city(merchants), "city_id", "merchant_count")
    return CITY_DIM.join(c.join(m, "city_id"), "city_id").select(
        "city_name", "courier_count", "merchant_count")
