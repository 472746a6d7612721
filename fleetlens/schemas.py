"""Fixed schemas of the four courier tables (S-1) and the column groups
that the cleaning rules, time conversions and joins are generated from."""

from __future__ import annotations

from pyspark.sql import types as T

# Stage prefixes of the report table, in pipeline order. The column name
# ``arrier_*`` (arrival) is spelt that way in the source data; it is kept.
REPORT_STAGES = ("acceptance", "arrier", "pickup", "delivery")
FEEDBACK_STAGES = ("acceptance", "feedback")
TIME_PARTS = ("hour", "minute", "second")


def stage_columns(stages) -> list[str]:
    return [f"{s}_{p}" for s in stages for p in TIME_PARTS]


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_I, _S, _D = T.IntegerType(), T.StringType(), T.DoubleType()

COURIER_DEVICE = _struct([
    ("no", _I), ("city_id", _S), ("day", _I), ("courier_id", _S),
    ("os_version", _S), ("phone_mode", _S),
])

MERCHANT_DEVICE = _struct([
    ("no", _I), ("city_id", _S), ("day", _I), ("shop_id", _S),
    ("beacon_id", _S), ("manufacturer", _S), ("brand", _S), ("model", _S),
])

COURIER_REPORT = _struct(
    [("no", _I), ("city_id", _S), ("day", _I), ("courier_id", _S), ("shop_id", _S)]
    + [(c, _I) for c in stage_columns(REPORT_STAGES)]
)

COURIER_FEEDBACK = _struct(
    [("city_id", _S), ("day", _I), ("courier_id", _S), ("shop_id", _S)]
    + [(c, _I) for c in stage_columns(FEEDBACK_STAGES)]
    + [("feedback", _I), ("distance_to_merchant", _D), ("gps_measure_offset", _I)]
)

SCHEMAS: dict[str, T.StructType] = {
    "courier_device": COURIER_DEVICE,
    "merchant_device": MERCHANT_DEVICE,
    "courier_report": COURIER_REPORT,
    "courier_feedback": COURIER_FEEDBACK,
}

TABLES = tuple(SCHEMAS)

# Key of the report ⟕ feedback enrichment join (J-5).
FEEDBACK_JOIN_KEYS = ["city_id", "day", "courier_id", "shop_id",
                      "acceptance_hour", "acceptance_minute", "acceptance_second"]
