"""Daily summary tables of the facts, and what is answered from them alone.

``write_daily`` stores three small tables by day, each from one read of the
clean fact tables that it needs; the functions below take those. A courier's figures over any span of
days are sums of daily rows, so the scores (N-9) need no fact rows either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeops import duration_seconds
from ..operators import sketches as S
from ..session import materialize
from ..sources import catalog
from . import analytics as A
from .tables import CourierTables

ITEMS = ("courier_id", "shop_id")
PROBS = (0.01, 0.5, 0.99)


def daily_distinct(report: DataFrame, lg_k: int = S.LG_K) -> DataFrame:
    """(day, city_id, rows, courier_id_sketch, shop_id_sketch)."""
    return S.distinct_sketches(report, ["day", "city_id"], ITEMS, lg_k)


def daily_work(report: DataFrame, k: int = S.KLL_K) -> DataFrame:
    """(day, n, sketch) of the orders' work durations."""
    return S.quantile_sketches(report, "day", duration_seconds("acceptance", "delivery", wrap="midnight"), k)


def courier_days(report: DataFrame, feedback: DataFrame) -> DataFrame:
    """(day, courier_id, order_count, work_sum, work_count): notifications and
    work time of a courier's day; a side without rows counts nothing."""
    orders = A.labelled_feedback(feedback).groupBy("day", "courier_id").agg(F.count(F.lit(1)).alias("order_count"))
    work = (report.withColumn("_w", duration_seconds("acceptance", "delivery", wrap="midnight")).groupBy("day", "courier_id")
            .agg(F.sum("_w").alias("work_sum"), F.count("_w").alias("work_count"), F.count(F.lit(1)).alias("report_rows")))
    return orders.join(work, ["day", "courier_id"], "full").na.fill(0, ["order_count", "work_count", "report_rows"])


def write_daily(tables: CourierTables, database: str) -> dict[str, DataFrame]:
    """Store the three summaries; the tables that read them, by name."""
    made = {"distinct_days": daily_distinct(tables.report), "work_days": daily_work(tables.report),
            "courier_days": courier_days(tables.report, tables.feedback)}
    for name, df in made.items():
        catalog.write_table(df, database, name)
    return {name: catalog.table(tables.spark, database, name) for name in made}


def until(summary: DataFrame) -> DataFrame:
    """Every row once for its own and each later day (``until``): the input of
    answers for all prefixes of days, of which there are few."""
    days = summary.agg(F.sort_array(F.collect_set("day")).alias("d")).scalar()
    own = summary.withColumn("_days", days)
    later = F.slice("_days", F.array_position("_days", F.col("day")).cast("int"), F.size("_days"))
    return own.withColumn("until", F.explode(later)).drop("_days")


def distinct_by_prefix(sketched: DataFrame) -> DataFrame:
    """(until, rows, courier_id_estimate, shop_id_estimate) for each prefix of days."""
    out = S.merged_distinct(until(sketched), "until", ITEMS)
    return out.select("until", "rows", *[f"{c}_estimate" for c in ITEMS])


def work_quantiles_by_prefix(sketched: DataFrame, probs=PROBS) -> DataFrame:
    """(until, n, quantiles) of the work duration for each prefix of days."""
    return S.merged_quantiles(until(sketched), "until", probs).select("until", "n", "quantiles")


def distinct_bound_check(report: DataFrame, sketched: DataFrame, lg_k: int = S.LG_K, errors: float = 4.0) -> DataFrame:
    """Per prefix of days: exact rows, couriers and shops (from each one's first
    day), and whether the estimates are within ``errors`` standard errors."""
    exact = None
    for c in ITEMS:
        firsts = report.groupBy(c).agg(F.min("day").alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias(f"{c}_new"))
        exact = firsts if exact is None else exact.join(firsts, "day", "full")
    days = sketched.groupBy("day").agg(F.sum("rows").alias("_rows"))
    run = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)          # a row per day
    exact = days.join(exact, "day", "left").select(
        F.col("day").alias("until"), *[F.sum(F.coalesce(f"{c}_new", F.lit(0))).over(run).alias(f"{c}_exact") for c in ITEMS])
    both = distinct_by_prefix(sketched).join(exact, "until")
    off = errors * S.hll_error(lg_k)
    return both.select(F.col("until").alias("day"), F.col("rows").alias("orders"), F.col("courier_id_exact").alias("couriers"),
                       F.col("shop_id_exact").alias("shops"), *[
                           (F.abs(F.col(f"{c}_estimate") - F.col(f"{c}_exact")) <= F.greatest(F.lit(1.0), off * F.col(f"{c}_exact"))).alias(f"{n}_within")
                           for c, n in zip(ITEMS, ("couriers", "shops"), strict=True)])


def quantile_bound_check(report: DataFrame, sketched: DataFrame, probs=PROBS, k: int = S.KLL_K) -> DataFrame:
    """Per prefix of days: timed orders, and whether each quantile's exact rank
    is within the sketch's rank error (ties count as the ranks they span)."""
    answers = materialize(work_quantiles_by_prefix(sketched, probs))       # a row per day
    w = report.select("day", duration_seconds("acceptance", "delivery", wrap="midnight").cast("double").alias("w")).where("w is not null")
    values = w.groupBy("day", "w").agg(F.count(F.lit(1)).alias("c"))
    counted = until(values).join(F.broadcast(answers), "until")
    q = lambda i: F.col("quantiles")[i]
    sums = counted.groupBy("until").agg(F.sum("c").alias("timed"), *[
        F.sum(F.when(F.col("w") < q(i), F.col("c")).otherwise(0)).alias(f"below{i}") for i in range(len(probs))], *[
        F.sum(F.when(F.col("w") <= q(i), F.col("c")).otherwise(0)).alias(f"upto{i}") for i in range(len(probs))])
    off = S.kll_error(k)
    near = [(F.col(f"below{i}") / F.col("timed") <= p + off) & (F.col(f"upto{i}") / F.col("timed") >= p - off) for i, p in enumerate(probs)]
    return sums.select(F.col("until").alias("day"), F.col("timed").alias("timed_orders"),
                       *[n.alias(f"p{round(100 * p):02d}_within") for n, p in zip(near, probs, strict=True)])


def courier_final(days: DataFrame, quantile_mode: str = "approx") -> DataFrame:
    """N-9 from ``courier_days`` rows (of any span of days), no fact rows read."""
    per = days.groupBy("courier_id").agg(*[F.sum(c).alias(c) for c in ("order_count", "work_sum", "work_count", "report_rows")])
    per = per.where("order_count > 0 and report_rows > 0").select(
        "courier_id", "order_count", (F.col("work_sum") / F.when(F.col("work_count") > 0, F.col("work_count"))).alias("avg_work_duration_seconds"))
    return A.scored_couriers(materialize(per), quantile_mode)
