"""Model feature frames (M-1, M-2) and train/test splits (M-6).

``feature_frame(report, feedback)`` (variant A) enriches every clean report
row with the notification sent for the same order (a left join on the
7-column order key), flags whether one was sent, fills the gaps, and turns
each stage time into minutes of day with the evening wrap. Variant B
(``feedback=None``) uses the report alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeops import stage_minutes_columns
from ..operators.cleaning import NO_NOTIFICATION_FILL, fill_missing
from ..operators.joins import skew_safe_join
from ..schemas import FEEDBACK_JOIN_KEYS, TIME_PARTS

STAGES_WITH_FEEDBACK = ("acceptance", "arrier", "pickup", "feedback", "delivery")
STAGES_REPORT_ONLY = ("acceptance", "arrier", "pickup", "delivery")
LABEL = "delivery_time"

FEATURES_WITH_FEEDBACK = ["city_id_encoded", "day", "acceptance_time", "arrier_time", "pickup_time",
                          "feedback_time", "feedback", "distance_to_merchant", "gps_measure_offset",
                          "has_system_notification"]
FEATURES_REPORT_ONLY = ["city_id_encoded", "day", "acceptance_time", "arrier_time", "pickup_time"]

# Key columns kept next to predictions so rows can be traced back.
ROW_KEYS = ["city_id", "day", "courier_id", "shop_id", "acceptance_time"]


def join_fanout(report: DataFrame, feedback: DataFrame) -> DataFrame:
    """How the left join on the order key multiplies rows (one row): report
    rows, joined rows, keys with several notifications, and the most of one."""
    per_key = feedback.groupBy(*FEEDBACK_JOIN_KEYS).agg(F.count(F.lit(1)).alias("_n"))
    keys = per_key.agg(F.count_if(F.col("_n") > 1).alias("fanout_keys"), F.max("_n").alias("most_per_key"))
    rows = report.join(per_key, FEEDBACK_JOIN_KEYS, "left").agg(
        F.count(F.lit(1)).alias("report_rows"), F.sum(F.coalesce("_n", F.lit(1))).alias("joined_rows"))
    return rows.select("report_rows", "joined_rows",
                       keys.select("fanout_keys").scalar().alias("fanout_keys"),
                       keys.select("most_per_key").scalar().alias("most_per_key"))


def feature_frame(report: DataFrame, feedback: DataFrame | None = None,
                  accepted_after: int = 1080, stage_before: int = 120,
                  skew_safe: bool = True) -> DataFrame:
    data = report.drop("no")
    if feedback is not None:
        if skew_safe:
            data = skew_safe_join(data, feedback, FEEDBACK_JOIN_KEYS, "left")
        else:
            data = data.join(feedback, FEEDBACK_JOIN_KEYS, "left")
        # P-9: presence indicator of the left join's right side
        data = data.withColumn("has_system_notification",
                               F.when(F.col("feedback_hour").isNull(), F.lit(0)).otherwise(F.lit(1)))
        data = fill_missing(data, NO_NOTIFICATION_FILL)
        stages = STAGES_WITH_FEEDBACK
    else:
        stages = STAGES_REPORT_ONLY
    data = data.withColumn("city_id", F.col("city_id").try_cast("int"))   # P-8
    times = stage_minutes_columns(stages, accepted_after, stage_before)
    hms = {f"{s}_{p}" for s in stages for p in TIME_PARTS}
    kept = [c for c in data.columns if c not in hms]
    return data.select(*kept, *[col.alias(name) for name, col in times.items()])


def hash_split_column(cols, train_percent: int = 80, seed: int = 42) -> Column:
    """'train' / 'test' from the md5 of the row as text: the same row always
    lands on the same side, and any SQL engine can check it. The first eight
    hex digits are compared with the share of their range."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    bound = f"{train_percent * 16**8 // 100:08x}" if train_percent < 100 else "g"
    return F.when(F.substring(F.md5(text), 1, 8) < bound, F.lit("train")).otherwise(F.lit("test"))


def exact_split(df: DataFrame, strata, train_percent: int = 80, seed: int = 42) -> DataFrame:
    """``df`` with ``split``: of each stratum's n rows exactly
    ``ceil(n * train_percent / 100)`` are "train" (M-6).

    Rows are ordered by the md5 of their text, so the split follows from the
    rows alone. A stratum is never sorted whole: rows are counted by the first
    four hex digits, running counts over these at most 65,536 numbers find the
    digits at which the share is reached, and only the rows with those digits
    are ranked. Rows with smaller digits are train, with larger ones test.
    """
    strata = [strata] if isinstance(strata, str) else list(strata)
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    rows = df.withColumn("_hash", F.md5(text)).withColumn("_head", F.substring("_hash", 1, 4))
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_s{i}") for i, c in enumerate(strata)]
    keys += [F.col(c).isNull().alias(f"_z{i}") for i, c in enumerate(strata)]
    names = [f"_{k}{i}" for k in "sz" for i in range(len(strata))]
    rows = rows.select("*", *keys)
    counts = rows.groupBy(*names, "_head").agg(F.count(F.lit(1)).alias("_n"))
    stratum = Window.partitionBy(*names)
    upto = F.sum("_n").over(stratum.orderBy("_head").rowsBetween(Window.unboundedPreceding, 0))
    share = F.ceil(F.sum("_n").over(stratum) * train_percent / F.lit(100))
    cuts = (counts.select(*names, F.col("_head").alias("_cut"), (upto - F.col("_n")).alias("_before"), upto.alias("_upto"), share.alias("_share"))
            .where((F.col("_before") < F.col("_share")) & (F.col("_share") <= F.col("_upto")))
            .select(*names, "_cut", (F.col("_share") - F.col("_before")).alias("_take")))
    placed = rows.join(cuts, names, "left")
    at = F.col("_head") == F.col("_cut")
    side = placed.where(~F.coalesce(at, F.lit(False))).withColumn("split", F.when(F.col("_head") < F.col("_cut"), "train").otherwise("test"))
    order = Window.partitionBy(*names).orderBy("_hash")
    ranked = placed.where(at).withColumn("split", F.when(F.row_number().over(order) <= F.col("_take"), "train").otherwise("test"))
    return side.select(*df.columns, "split").union(ranked.select(*df.columns, "split"))


def split(df: DataFrame, method: str = "hash", train_fraction: float = 0.8, seed: int = 42):
    """Return (train, test). ``method="random"`` is ``randomSplit`` (what the
    source job does); ``"hash"`` is stable under recomputation."""
    if method == "random":
        train, test = df.randomSplit([train_fraction, 1 - train_fraction], seed=seed)
        return train, test
    if method == "hash":
        tagged = df.withColumn("_split", hash_split_column(df.columns, int(round(train_fraction * 100)), seed))
        return (tagged.where(F.col("_split") == "train").drop("_split"),
                tagged.where(F.col("_split") == "test").drop("_split"))
    raise ValueError(f"unknown split method {method!r}")
