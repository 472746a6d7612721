"""Named queries bound to a data directory: ``name → (spark, sf_dir) → DataFrame``.

Every query reads the driver's tables under ``sf_dir`` (through the adapter)
and runs over all of their rows. The HAVING threshold of the busy-hours
queries is the one parameter fixed per registration: the source analysis
uses 1000 orders per (city, hour), which no group reaches at the 0.01 scale
the SQL check runs at, so the checked registration uses 260 and a second
registration keeps 1000 (empty there, 13 rows at 0.1).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import clean_audit, clean_table
from ..operators.faults import inject_faults
from ..functions.timeops import parse_clock, text_duration_seconds, time_text
from ..operators import sketches
from ..operators.joins import filtered_join, skew_safe_join
from ..schemas import FEEDBACK_JOIN_KEYS, stage_columns
from ..session import ensure_checkpoint_dir, kept_folder, kept_rows, materialize
from ..sources import catalog, csv_files
from ..streaming import clean
from . import analytics as A
from . import daily, incremental, jobs
from . import models as M
from .features import exact_split, feature_frame, join_fanout
from .tables import CourierTables

CHECK_MIN_COUNT = 260

Query = Callable[[SparkSession, str], DataFrame]


def _on(fn: Callable[[CourierTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(CourierTables.from_testdata(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    run.build = fn               # the query on tables of any source
    return run


ANALYTICS: dict[str, Query] = {
    "dataset_summary": _on(lambda t: A.dataset_summary(t.report)),
    "avg_response_time": _on(lambda t: A.avg_response_time(t.feedback)),
    "courier_response_counts": _on(lambda t: A.courier_response_counts(t.feedback)),
    "retry_leaderboard": _on(lambda t: A.retry_leaderboard(t.feedback)),
    "confirm_leaderboard": _on(lambda t: A.confirm_leaderboard(t.feedback)),
    "courier_order_counts": _on(lambda t: A.courier_order_counts(t.feedback)),
    "order_work_duration": _on(lambda t: A.order_work_duration(t.report)),
    "courier_avg_work_duration": _on(lambda t: A.courier_avg_work_duration(t.report)),
    "courier_final": _on(lambda t: A.courier_final(t.report, t.feedback, quantile_mode="exact")),
    "courier_final_approx": _on(lambda t: A.courier_final(t.report, t.feedback, quantile_mode="approx",
                                                              materialize_per_courier=True)),
    "average_delivery_time": _on(lambda t: A.average_delivery_time(t.report)),
    "average_delivery_time_wrapped": _on(lambda t: A.average_delivery_time(t.report, wrap="midnight")),
    "delivery_time_by_city_hour": _on(lambda t: A.delivery_time_by_city_hour(t.report, CHECK_MIN_COUNT)),
    "top_busy_hours_per_city": _on(lambda t: A.top_busy_hours_per_city(t.report, CHECK_MIN_COUNT)),
    "top_busy_hours_per_city_min1000": _on(lambda t: A.top_busy_hours_per_city(t.report, 1000)),
    "courier_phone_mode_counts": _on(lambda t: A.courier_phone_mode_counts(t.couriers)),
    "courier_os_version_counts": _on(lambda t: A.courier_os_version_counts(t.couriers)),
    "courier_city_phone_mode_favourite": _on(lambda t: A.courier_city_phone_mode_favourite(t.couriers)),
    "shop_brand_counts": _on(lambda t: A.shop_brand_counts(t.merchants)),
    "shop_model_counts": _on(lambda t: A.shop_model_counts(t.merchants)),
    "shop_city_model_favourite": _on(lambda t: A.shop_city_model_favourite(t.merchants)),
    "city_courier_merchant_counts": _on(lambda t: A.city_courier_merchant_counts(t.couriers, t.merchants)),
    "city_distinct_entity_counts": _on(lambda t: A.city_courier_merchant_counts(t.couriers, t.merchants, distinct=True)),
    "shop_order_counts": _on(lambda t: A.shop_order_counts(t.feedback)),
    "shop_top_by_day": _on(lambda t: A.shop_top_by_day(t.feedback)),
    # N-22 .. N-25: the clean tables
    "clean_courier_device": _on(lambda t: t.couriers),
    "clean_merchant_device": _on(lambda t: t.merchants),
    "clean_courier_feedback": _on(lambda t: t.feedback),
    "clean_courier_report": _on(lambda t: t.report),
}


FAULT_TABLES = ("courier_feedback", "courier_report", "merchant_device")


def _faults(table: str) -> Query:
    return _on(lambda t: inject_faults(t.raw(table)))


def _clean_after_faults(table: str) -> Query:
    return _on(lambda t: clean_table(inject_faults(t.raw(table)), table))


def _frame(t: CourierTables, with_feedback: bool) -> DataFrame:
    """The feature frame; both facts are cleaned where they are joined."""
    if not with_feedback:
        return feature_frame(t.report)
    return feature_frame(*[t.placed(n, FEEDBACK_JOIN_KEYS) for n in ("courier_report", "courier_feedback")])


def _features(with_feedback: bool) -> Query:
    return _on(lambda t: _frame(t, with_feedback))


def _split_query(with_feedback: bool) -> Query:
    return _on(lambda t: M.with_split(_frame(t, with_feedback)))


def _hot_key_join(t: CourierTables):
    """J-5's join where each key is hot: devices per city with every order of
    the city, a thousand rows to a salt."""
    devices = t.couriers.groupBy("city_id").agg(F.count(F.lit(1)).alias("devices"))
    return skew_safe_join(devices, t.report.select("city_id", "no", "courier_id"), ["city_id"], target_rows=1000)


def _csv_round_trip(t: CourierTables):
    """S-1, S-2: the table written as delimited files, read back by its schema."""
    folder = f"{ensure_checkpoint_dir(t.spark)}/csv-{uuid.uuid4().hex}"
    csv_files.write_table(t.raw("courier_device"), folder)
    return csv_files.read_table(t.spark, "courier_device", folder)


def _catalog_round_trip(t: CourierTables):
    """S-3, S-4, S-9, S-10, K-1, K-3: overwrite, append, list and describe a
    catalog table; every row with the number of tables and columns."""
    db = f"round_trip_{uuid.uuid4().hex[:12]}"
    raw, odd = t.raw("merchant_device"), F.col("no") % 2 == 1
    catalog.write_table(raw.where(~odd), db, "merchant_device")
    catalog.append_table(raw.where(odd), db, "merchant_device")
    listed, described = catalog.list_tables(t.spark, db), catalog.describe(t.spark, db, "merchant_device")
    return catalog.table(t.spark, db, "merchant_device").withColumns({
        "tables_listed": F.lit(listed.where("not isTemporary").count()), "columns_described": F.lit(described.count())})


def _sql_view(t: CourierTables):
    """S-6, S-7: SQL text over a registered view."""
    return catalog.sql(t.spark, """
        SELECT city_id, day, COUNT(*) AS orders, COUNT(DISTINCT courier_id) AS couriers
        FROM report_view GROUP BY city_id, day HAVING COUNT(*) > 100""", views={"report_view": t.report})


def _orc_result(t: CourierTables):
    """K-2: a result table as ORC, read back from the catalog."""
    db = f"result_{uuid.uuid4().hex[:12]}"
    jobs.analysis_job(t, db, only=["shop_top_by_day"])
    return catalog.table(t.spark, db, "shop_top_by_day")


def _run(t: CourierTables, with_feedback: bool):
    """Predictions and models; models that were fitted on the same rows before are loaded."""
    return M.run_models(_frame(t, with_feedback), with_feedback,
                        seed=42 if with_feedback else 20, folder=kept_folder(t.spark, "models"))


def _predictions(with_feedback: bool) -> Query:
    return _on(lambda t: _run(t, with_feedback)[0])


def _metrics(with_feedback: bool) -> Query:
    return _on(lambda t: M.model_metrics(*_run(t, with_feedback)))


def _streamed_scoring(t: CourierTables):
    """M-10: the report-only features, arriving as files, scored by the stored
    models batch by batch; held against the batch predictions."""
    batch, trained = _run(t, False)
    folder = f"{ensure_checkpoint_dir(t.spark)}/scoring-{uuid.uuid4().hex}"
    M.with_split(feature_frame(t.report), seed=20).write.parquet(f"{folder}/in")
    M.score_stream(t.spark, trained, f"{folder}/in", f"{folder}/out", f"{folder}/progress", 3).awaitTermination()
    return M.scoring_check(batch, t.spark.read.parquet(f"{folder}/out"))


def _own_database(t: CourierTables, name: str) -> str:
    """An empty database for a query that writes tables, of one fixed name in
    an application (a local catalog ends with it, the warehouse folder doesn't)."""
    name = f"{name}_{re.sub('[^a-z0-9]', '_', t.spark.sparkContext.applicationId.lower())}"
    t.spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    return name


def _incremental(t: CourierTables):
    """K-1, L-6: two incremental loads. Before the second, day 7 had not come,
    day 3 lacked half of its rows, and day 9 held rows that were withdrawn."""
    db, raw = _own_database(t, "fleetlens_incremental"), t.raw("courier_report")
    days = F.explode(F.when(F.col("day") == 1, F.array(F.lit(1), F.lit(9))).otherwise(F.array("day")))
    early = (raw.where("day <> 7 and not (day = 3 and no % 2 = 0)").withColumn("_day", days)     # one scan
             .select(*[F.col("_day").alias("day") if c == "day" else F.col(c) for c in raw.columns]))
    incremental.incremental_clean(CourierTables(t.spark, {"courier_report": early}), db, ["courier_report"])
    status = incremental.incremental_clean(CourierTables(t.spark, {"courier_report": raw}), db, ["courier_report"])
    clean = catalog.table(t.spark, db, "courier_report_clean")
    return clean.join(F.broadcast(status.select("day", "status")), "day", "left")       # a row per day


def _written_audit(t: CourierTables):
    """L-7: the audit taken while the four clean tables are written."""
    return jobs.clean_job(t, _own_database(t, "fleetlens_audited"))


def _dirty_files(t: CourierTables) -> list[str]:
    """Folders of delimited files of the report: the whole table, and broken copies of some of its lines."""
    folder = f"{ensure_checkpoint_dir(t.spark)}/dirty-{uuid.uuid4().hex}"
    raw = t.raw("courier_report")
    csv_files.write_table(raw, f"{folder}/good")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = lambda **other: F.concat_ws(",", *[F.lit(other[c]) if c in other else text(c) for c in raw.columns])
    kinds = [F.concat_ws(",", *map(text, raw.columns[:-1])), F.concat(line(), F.lit(",more")),
             line(acceptance_hour="x7", pickup_minute="1.5"), line(shop_id='"open'), line(day="")]
    broken = F.element_at(F.array(*kinds), (F.col("no") % 5 + 1).cast("int"))
    raw.where("no % 41 = 0").select(broken.alias("value")).write.text(f"{folder}/broken")
    return [f"{folder}/good", f"{folder}/broken"]


def _streamed_clean(t: CourierTables):
    """L-2, L-6: the feedback files arrive in two parts, the second with rows
    of closed days and copies; the clean table of the stream."""
    db, folder = _own_database(t, "fleetlens_streamed"), f"{ensure_checkpoint_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    raw = t.raw("courier_feedback")
    for name, rows in (("a", raw.where("day >= 3 or feedback = 1")), ("b", raw.where("day <= 6"))):
        csv_files.write_table(rows, f"{folder}/landing/{name}")
        clean.clean_stream(t.spark, "courier_feedback", f"{folder}/landing/*", db, 2, f"{folder}/progress")
    return catalog.table(t.spark, db, "courier_feedback_clean").drop("batch")


def _corrupted_table(t: CourierTables):
    """L-12: a catalog table after the job that appends fault rows."""
    db = _own_database(t, "fleetlens_corrupted")
    catalog.write_table(t.raw("merchant_device"), db, "merchant_device")
    jobs.fault_job(t.spark, db, tables=("merchant_device",))
    return catalog.table(t.spark, db, "merchant_device")


def _csv_rejects(t: CourierTables):
    """S-1: every line that is no row, with the reason."""
    parsed = csv_files.parsed_lines(t.spark, "courier_report", _dirty_files(t))
    return csv_files.rejected(parsed, "courier_report").select("line", "reason", F.concat_ws(",", "columns").alias("bad_columns"))


def _csv_rows(t: CourierTables):
    """S-1, S-2: the rows among the same lines."""
    return csv_files.accepted(csv_files.parsed_lines(t.spark, "courier_report", _dirty_files(t)), "courier_report")


def _distinct_by_day(t: CourierTables):
    """A-2: distinct couriers and shops of every prefix of days, from daily sketches."""
    return daily.distinct_bound_check(t.report, materialize(daily.daily_distinct(t.report)))


def _quantiles_by_day(t: CourierTables):
    """A-8: work-duration quantiles of every prefix of days, from daily sketches."""
    timed = kept_rows(t.report.select("day", *stage_columns(("acceptance", "delivery"))))      # read twice, cleaned once
    return daily.quantile_bound_check(timed, materialize(daily.daily_work(timed)))


def _top_lists(t: CourierTables):
    """N-13, N-14, N-16, N-17: the top lists from frequent-item summaries."""
    lists = {"phone_mode": (t.couriers, ["phone_mode"]), "os_version": (t.couriers, ["phone_mode", "os_version"]),
             "brand": (t.merchants, ["brand"]), "model": (t.merchants, ["model"])}
    parts = [sketches.heavy_hitters(df, keys, A.TOP_N).select(F.lit(name).alias("list"), F.concat_ws("/", *keys).alias("item"), "count")
             for name, (df, keys) in lists.items()]
    return reduce(lambda a, b: a.union(b), parts)


def _dirty_clocks(t: CourierTables):
    """P-3, P-4: clock texts, some of them no times of day, and their difference."""
    r = t.report.select("no", "day", "courier_id", "shop_id", time_text("acceptance").alias("a"), time_text("delivery").alias("b"))
    a = (F.when(F.col("no") % 17 == 0, "24:00:00").when(F.col("no") % 17 == 1, F.substring("a", 2, 7))
         .when(F.col("no") % 17 == 2, F.concat(F.lit(" "), F.col("a"))).when(F.col("no") % 17 == 3, F.substring("a", 1, 5))
         .when(F.col("no") % 17 == 4, F.regexp_replace("a", "..$", "60")).when(F.col("no") % 17 == 5, "noon").otherwise(F.col("a")))
    r = r.withColumn("a", a)
    return r.select("no", "day", "courier_id", "shop_id", F.col("a").alias("acceptance_text"), F.col("b").alias("delivery_text"),
                    parse_clock(F.col("a")).alias("acceptance_seconds"),
                    text_duration_seconds(F.col("a"), F.col("b"), "midnight").alias("work_duration_seconds"))


# N-26 clean audit, N-27 fault injection (and the cleaning property it checks)
QUALITY: dict[str, Query] = {
    "clean_audit": _on(lambda t: clean_audit({n: t.raw(n) for n in
                                              ("courier_device", "merchant_device",
                                               "courier_feedback", "courier_report")})),
    "clean_audit_while_writing": _on(_written_audit),
    "incremental_clean_courier_report": _on(_incremental),
    "streamed_clean_courier_feedback": _on(_streamed_clean),
    "corrupted_table_merchant_device": _on(_corrupted_table),
    **{f"inject_faults_{n}": _faults(n) for n in FAULT_TABLES},
    **{f"clean_after_faults_{n}": _clean_after_faults(n) for n in FAULT_TABLES},
}

# N-28 feature frames, N-29 predictions, N-30 metrics (variants A and B)
MODELS: dict[str, Query] = {
    "feature_frame_with_feedback": _features(True),
    "feature_frame_report_only": _features(False),
    "filtered_feedback_join": _on(lambda t: filtered_join(t.report, t.feedback, FEEDBACK_JOIN_KEYS)),
    "exact_split_report_only": _on(lambda t: exact_split(feature_frame(t.report), "city_id")),
    "feedback_join_fanout": _on(lambda t: join_fanout(t.report, t.feedback)),
    "hot_key_join": _on(_hot_key_join),
    "train_test_split_with_feedback": _split_query(True),
    "train_test_split_report_only": _split_query(False),
    "scaled_features_with_feedback": _on(lambda t: M.scaled_features(_frame(t, True), True)),
    "scaled_features_report_only": _on(lambda t: M.scaled_features(feature_frame(t.report), False)),
    "scaled_features_fitted_on_train": _on(lambda t: M.scaled_features(M.with_split(feature_frame(t.report)), False, fit_on="train")),
    "fusion_check_report_only": _on(lambda t: M.fusion_check(_run(t, False)[0])),
    "streamed_scoring_report_only": _on(_streamed_scoring),
    "baseline_model_metrics": _on(lambda t: M.baseline_metrics(feature_frame(t.report))),
    "delivery_predictions_with_feedback": _predictions(True),
    "delivery_predictions_report_only": _predictions(False),
    "model_metrics_with_feedback": _metrics(True),
    "model_metrics_report_only": _metrics(False),
}


# Mergeable daily summaries (A-2, A-8, T-3) and text clocks (P-4)
SUMMARIES: dict[str, Query] = {
    "distinct_counts_by_day_prefix": _on(_distinct_by_day),
    "work_quantiles_by_day_prefix": _on(_quantiles_by_day),
    "courier_final_from_days": _on(lambda t: daily.courier_final(daily.courier_days(t.report, t.feedback), "exact")),
    "top_lists_from_summaries": _on(_top_lists),
    "text_clock_durations": _on(_dirty_clocks),
}

# S-1 .. S-10 and K-1 .. K-3: sources and sinks, round trip
STORAGE: dict[str, Query] = {
    "csv_round_trip_courier_device": _on(_csv_round_trip),
    "csv_rejects_courier_report": _on(_csv_rejects),
    "csv_checked_rows_courier_report": _on(_csv_rows),
    "catalog_round_trip_merchant_device": _on(_catalog_round_trip),
    "sql_view_orders_by_city_day": _on(_sql_view),
    "orc_result_shop_top_by_day": _on(_orc_result),
}


def all_queries() -> dict[str, Query]:
    return {**ANALYTICS, **QUALITY, **MODELS, **SUMMARIES, **STORAGE}
