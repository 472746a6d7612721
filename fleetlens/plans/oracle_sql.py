"""Independent SQL texts for every checkable query, runnable by DuckDB over
the driver's tables (views ``lineitem``, ``customer``, ``part`` …).

The courier tables are re-derived here in SQL (FIXTURES.md §2) and cleaned
with ``SELECT DISTINCT`` + ``WHERE``, so the oracle shares no code with the
Spark implementation. Every computed column is aliased to the Spark name.
"""

from __future__ import annotations

# Fixed values, written out here so that the oracle shares none with the
# engine: stages, city names and feedback labels of the source data.
REPORT_STAGES = ("acceptance", "arrier", "pickup", "delivery")
FEEDBACK_STAGES = ("acceptance", "feedback")
CITY_NAMES = {1: "上海", 2: "杭州", 3: "深圳", 4: "北京", 5: "潍坊", 6: "广州", 7: "遂宁", 8: "西宁", 9: "定安", 10: "廊坊"}
FEEDBACK_LABELS = {0: "稍后尝试", 1: "确认"}


def stage_columns(stages):
    return [f"{s}_{p}" for s in stages for p in ("hour", "minute", "second")]


def _h(x):
    return f"cast(floor(({x}) / 3600.0) as int)"


def _m(x):
    return f"cast(floor((({x}) % 3600) / 60.0) as int)"


def _s(x):
    return f"cast(({x}) % 60 as int)"


def _clock(prefix, x, hour=None):
    return [f"{hour or _h(x)} AS {prefix}_hour", f"{_m(x)} AS {prefix}_minute",
            f"{_s(x)} AS {prefix}_second"]


def _values(mapping, key, value, key_type):
    rows = ", ".join(f"(cast({k} as {key_type}), '{v}')" for k, v in mapping.items())
    return f"SELECT * FROM (VALUES {rows}) AS t({key}, {value})"


_REPORT_COLS = ["no", "city_id", "day", "courier_id", "shop_id"] + stage_columns(REPORT_STAGES)
_FEEDBACK_COLS = (["city_id", "day", "courier_id", "shop_id"] + stage_columns(FEEDBACK_STAGES)
                  + ["feedback", "distance_to_merchant", "gps_measure_offset"])
_CDEV_COLS = ["no", "city_id", "day", "courier_id", "os_version", "phone_mode"]
_MDEV_COLS = ["no", "city_id", "day", "shop_id", "beacon_id", "manufacturer", "brand", "model"]


def _not_null(cols, doubles=()):
    preds = [f"{c} IS NOT NULL" for c in cols] + [f"NOT isnan({c})" for c in doubles]
    return " AND ".join(preds)


_ge0 = lambda cols: " AND ".join(f"{c} >= 0" for c in cols)

_ACC, _ARR, _PICK, _DLV = "a0", "(a0 + d1) % 86400", "(a0 + d1 + d2) % 86400", "(a0 + d1 + d2 + d3) % 86400"

BASE_CTES = f"""
li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag,
         (l_orderkey * 7919 + l_linenumber * 1009) % 86400 AS a0,
         60 + (l_partkey * 31) % 900 AS d1,
         30 + (l_orderkey * 13) % 600 AS d2,
         300 + (l_partkey * 17 + l_orderkey) % 1800 AS d3,
         5 + (l_partkey * 7) % 240 AS dfb
  FROM lineitem),
report_once AS (
  SELECT cast(l_orderkey % 2147483647 as int) AS no,
         cast(1 + l_suppkey % 9 as varchar) AS city_id,
         cast(1 + l_orderkey % 7 as int) AS day,
         'c' || cast(l_suppkey as varchar) AS courier_id,
         's' || cast(l_partkey % 200 as varchar) AS shop_id,
         {", ".join(_clock("acceptance", _ACC, f"case when l_returnflag = 'R' and l_linenumber = 7 then -100 else {_h(_ACC)} end"))},
         {", ".join(_clock("arrier", _ARR))},
         {", ".join(_clock("pickup", _PICK))},
         {", ".join(_clock("delivery", _DLV, f"case when l_returnflag = 'A' and l_linenumber = 6 then null else {_h(_DLV)} end"))}
  FROM li),
courier_report AS (
  SELECT * FROM report_once UNION ALL SELECT * FROM report_once WHERE no % 50 = 0),
feedback_once AS (
  SELECT cast(1 + l_suppkey % 9 as varchar) AS city_id,
         cast(1 + l_orderkey % 7 as int) AS day,
         'c' || cast(l_suppkey as varchar) AS courier_id,
         's' || cast(l_partkey % 200 as varchar) AS shop_id,
         {", ".join(_clock("acceptance", "a0"))},
         {", ".join(_clock("feedback", "(a0 + dfb) % 86400"))},
         cast(case when l_orderkey % 10 = 0 then 2 when l_orderkey % 10 < 4 then 0 else 1 end as int) AS feedback,
         l_quantity * 24.0 AS distance_to_merchant,
         cast(l_linenumber - 4 as int) AS gps_measure_offset
  FROM li
  WHERE (l_orderkey + l_linenumber) % 3 = 0 AND l_suppkey % 9 < 8),
courier_feedback AS (
  SELECT * FROM feedback_once UNION ALL SELECT * FROM feedback_once WHERE gps_measure_offset = 3),
courier_device AS (
  SELECT cast(c_custkey % 2147483647 as int) AS no,
         cast(1 + c_custkey % 10 as varchar) AS city_id,
         cast(1 + c_custkey % 7 as int) AS day,
         'c' || cast(c_custkey as varchar) AS courier_id,
         'v' || cast(c_nationkey % 5 as varchar) AS os_version,
         c_mktsegment AS phone_mode
  FROM customer),
merchant_device AS (
  SELECT cast(p_partkey % 2147483647 as int) AS no,
         case when p_partkey % 500 = 499 then 'error' else cast(1 + p_partkey % 10 as varchar) end AS city_id,
         cast(1 + p_partkey % 7 as int) AS day,
         's' || cast(p_partkey % 200 as varchar) AS shop_id,
         'b' || cast(p_partkey as varchar) AS beacon_id,
         p_type AS manufacturer,
         p_brand AS brand,
         p_type || ' ' || cast(p_size as varchar) AS model
  FROM part),
report_clean AS (
  SELECT DISTINCT * FROM courier_report
  WHERE {_not_null(_REPORT_COLS)} AND {_ge0(stage_columns(REPORT_STAGES))}),
feedback_clean AS (
  SELECT DISTINCT * FROM courier_feedback
  WHERE {_not_null(_FEEDBACK_COLS, ["distance_to_merchant"])}
    AND {_ge0(stage_columns(FEEDBACK_STAGES) + ["feedback"])}
    AND distance_to_merchant >= 0 AND distance_to_merchant <= 1000),
courier_device_clean AS (SELECT DISTINCT * FROM courier_device WHERE {_not_null(_CDEV_COLS)}),
merchant_device_clean AS (SELECT DISTINCT * FROM merchant_device WHERE {_not_null(_MDEV_COLS)}),
city_dim AS ({_values(CITY_NAMES, "city_id", "city_name", "bigint")}),
feedback_dim AS ({_values(FEEDBACK_LABELS, "feedback", "feedback_tran", "bigint")}),
labelled AS (
  SELECT f.*, d.feedback_tran,
         (cast(feedback_hour as bigint) * 3600 + feedback_minute * 60 + feedback_second)
         - (cast(acceptance_hour as bigint) * 3600 + acceptance_minute * 60 + acceptance_second) AS response_time_seconds
  FROM feedback_clean f JOIN feedback_dim d ON cast(f.feedback as bigint) = d.feedback),
timed AS (
  SELECT *,
         case when delivery_hour between 0 and 23 and delivery_minute between 0 and 59 and delivery_second between 0 and 59
               and acceptance_hour between 0 and 23 and acceptance_minute between 0 and 59 and acceptance_second between 0 and 59
              then (cast(delivery_hour as bigint) * 3600 + delivery_minute * 60 + delivery_second)
                 - (cast(acceptance_hour as bigint) * 3600 + acceptance_minute * 60 + acceptance_second) end AS diff
  FROM report_clean)
"""


def with_base(body: str) -> str:
    return f"WITH {BASE_CTES.strip()}\n{body.strip()}\n"


def _fmt(prefix):
    ok = (f"{prefix}_hour between 0 and 23 and {prefix}_minute between 0 and 59 "
          f"and {prefix}_second between 0 and 59")
    return (f"case when {ok} then lpad(cast({prefix}_hour as varchar), 2, '0') || ':' || "
            f"lpad(cast({prefix}_minute as varchar), 2, '0') || ':' || "
            f"lpad(cast({prefix}_second as varchar), 2, '0') end")


_WORK = "case when diff < 0 then diff + 86400 else diff end"

BUSY_HOURS = """
busy AS (
  SELECT city_id, acceptance_hour, avg(diff) AS avg_delivery_time_seconds, count(diff) AS "count"
  FROM timed GROUP BY city_id, acceptance_hour HAVING count(diff) > {min_count}),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY city_id ORDER BY avg_delivery_time_seconds DESC) AS rk FROM busy)
"""


def busy_hours_sql(min_count: int) -> str:
    return with_base(f""", {BUSY_HOURS.format(min_count=min_count).strip()}
SELECT c.city_name, r.acceptance_hour, r.avg_delivery_time_seconds, r."count"
FROM ranked r JOIN city_dim c ON try_cast(r.city_id as bigint) = c.city_id
WHERE r.rk <= 3""")


def city_hour_sql(min_count: int) -> str:
    return with_base(f"""
SELECT city_id, acceptance_hour, avg(diff) AS avg_delivery_time_seconds, count(diff) AS "count"
FROM timed GROUP BY city_id, acceptance_hour HAVING count(diff) > {min_count}""")


def _favourite_sql(table: str, item: str) -> str:
    return with_base(f""", fav AS (
  SELECT try_cast(city_id as int) AS city_id, {item}, count(*) AS "count",
         row_number() OVER (PARTITION BY try_cast(city_id as int) ORDER BY count(*) DESC, {item} ASC) AS rn
  FROM {table} GROUP BY try_cast(city_id as int), {item})
SELECT c.city_name, f.{item}, f."count"
FROM fav f JOIN city_dim c ON cast(f.city_id as bigint) = c.city_id
WHERE f.rn = 1 ORDER BY f.city_id LIMIT 20""")


def _topn_sql(table: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return with_base(f"""
SELECT {k}, count(*) AS "count" FROM {table} GROUP BY {k}
ORDER BY "count" DESC, {k} LIMIT 20""")


def courier_final_sql() -> str:
    return with_base(""", orders AS (
  SELECT courier_id, count(*) AS order_count FROM labelled GROUP BY courier_id),
work AS (
  SELECT courier_id, avg(case when diff < 0 then diff + 86400 else diff end) AS avg_work_duration_seconds
  FROM timed GROUP BY courier_id),
pc AS (SELECT o.courier_id, o.order_count, w.avg_work_duration_seconds FROM orders o JOIN work w USING (courier_id)),
q AS (
  SELECT quantile_disc(avg_work_duration_seconds, 0.01) AS w01, quantile_disc(avg_work_duration_seconds, 0.99) AS w99,
         quantile_disc(cast(order_count as double), 0.01) AS o01, quantile_disc(cast(order_count as double), 0.99) AS o99
  FROM pc),
s AS (
  SELECT pc.*,
    case when avg_work_duration_seconds <= w01 then 100.0 when avg_work_duration_seconds >= w99 then 0.0
         else 100.0 * (w99 - avg_work_duration_seconds) / (w99 - w01) end AS ws,
    case when cast(order_count as double) <= o01 then 0.0 when cast(order_count as double) >= o99 then 100.0
         else 100.0 * (cast(order_count as double) - o01) / (o99 - o01) end AS os
  FROM pc, q)
SELECT courier_id, order_count, avg_work_duration_seconds,
       ws * cast(0.4 as double) + os * cast(0.6 as double) AS final_score
FROM s""")


def _audit_part(name: str, raw: str, complete: str, rule: str) -> str:
    return f"""SELECT '{name}' AS table_name,
       (SELECT count(*) FROM {raw}) AS raw_rows,
       (SELECT count(*) FROM {raw} WHERE NOT ({complete})) AS null_rows,
       (SELECT count(*) FROM {raw} WHERE {complete})
         - (SELECT count(*) FROM (SELECT DISTINCT * FROM {raw} WHERE {complete})) AS duplicate_rows,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM {raw} WHERE {complete}) WHERE NOT ({rule})) AS invalid_rows,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM {raw} WHERE {complete}) WHERE {rule}) AS clean_rows"""


def clean_audit_sql() -> str:
    fb_rule = (_ge0(stage_columns(FEEDBACK_STAGES) + ["feedback"])
               + " AND distance_to_merchant >= 0 AND distance_to_merchant <= 1000")
    parts = [
        _audit_part("courier_device", "courier_device", _not_null(_CDEV_COLS), "true"),
        _audit_part("merchant_device", "merchant_device", _not_null(_MDEV_COLS), "true"),
        _audit_part("courier_feedback", "courier_feedback",
                    _not_null(_FEEDBACK_COLS, ["distance_to_merchant"]), fb_rule),
        _audit_part("courier_report", "courier_report", _not_null(_REPORT_COLS),
                    _ge0(stage_columns(REPORT_STAGES))),
    ]
    return with_base("\nUNION ALL\n".join(parts))


def _minutes(prefix):
    return f"cast({prefix}_hour * 60 + {prefix}_minute as int)"


def _evening(prefix):
    t, a = _minutes(prefix), _minutes("acceptance")
    return f"case when {a} > 1080 and {t} < 120 then {t} + 1440 else {t} end"


def feature_frame_sql(with_feedback: bool) -> str:
    if not with_feedback:
        return with_base(f"""
SELECT try_cast(city_id as int) AS city_id, day, courier_id, shop_id,
       {_minutes("acceptance")} AS acceptance_time, {_evening("arrier")} AS arrier_time,
       {_evening("pickup")} AS pickup_time, {_evening("delivery")} AS delivery_time
FROM report_clean""")
    on = " AND ".join(f"r.{k} = f.{k}" for k in ["city_id", "day", "courier_id", "shop_id",
                                                 "acceptance_hour", "acceptance_minute", "acceptance_second"])
    return with_base(f""", joined AS (
  SELECT r.city_id, r.day, r.courier_id, r.shop_id,
         r.acceptance_hour, r.acceptance_minute, r.acceptance_second,
         r.arrier_hour, r.arrier_minute, r.arrier_second, r.pickup_hour, r.pickup_minute, r.pickup_second,
         r.delivery_hour, r.delivery_minute, r.delivery_second,
         case when f.feedback_hour is null then 0 else 1 end AS has_system_notification,
         coalesce(f.feedback_hour, 24) AS feedback_hour, coalesce(f.feedback_minute, 0) AS feedback_minute,
         coalesce(f.feedback_second, 0) AS feedback_second, coalesce(f.feedback, 2) AS feedback,
         coalesce(f.distance_to_merchant, 0.0) AS distance_to_merchant,
         coalesce(f.gps_measure_offset, 0) AS gps_measure_offset
  FROM report_clean r LEFT JOIN feedback_clean f ON {on})
SELECT try_cast(city_id as int) AS city_id, day, courier_id, shop_id, feedback, distance_to_merchant,
       gps_measure_offset, has_system_notification,
       {_minutes("acceptance")} AS acceptance_time, {_evening("arrier")} AS arrier_time,
       {_evening("pickup")} AS pickup_time, {_evening("feedback")} AS feedback_time,
       {_evening("delivery")} AS delivery_time
FROM joined""")


def baseline_metrics_sql() -> str:
    ff = feature_frame_sql(False)
    body = ff[ff.index("SELECT try_cast"):]
    return with_base(f""", ff AS ({body}),
g AS (SELECT avg(delivery_time - pickup_time) AS gap FROM ff),
p AS (SELECT cast(delivery_time as double) AS y, pickup_time + g.gap AS p FROM ff, g)
SELECT 'all' AS split, 'pickup_plus_mean_gap' AS model,
       avg(abs(y - p)) AS mae, avg((y - p) * (y - p)) AS mse, sqrt(avg((y - p) * (y - p))) AS rmse,
       1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2
FROM p""")


def _feature_select(with_feedback: bool) -> tuple[str, str]:
    """(CTEs after the base ones, final select) of the feature frame."""
    text = feature_frame_sql(with_feedback)
    at = text.rindex("SELECT try_cast")
    return text[:at], text[at:]


_SPLIT_COLS = {
    True: ["city_id", "day", "courier_id", "shop_id", "feedback", "distance_to_merchant", "gps_measure_offset",
           "has_system_notification", "acceptance_time", "arrier_time", "pickup_time", "feedback_time", "delivery_time"],
    False: ["city_id", "day", "courier_id", "shop_id", "acceptance_time", "arrier_time", "pickup_time", "delivery_time"],
}


def split_sql(with_feedback: bool, seed: int = 42) -> str:
    """80 of 100: the first eight hex digits of the row's md5 under 0xcccccccc."""
    head, select = _feature_select(with_feedback)
    text = " || '|' || ".join([f"'{seed}'"] + [f"coalesce(cast({c} as varchar), '')" for c in _SPLIT_COLS[with_feedback]])
    return f"""{head.rstrip()}, ff AS ({select.strip()})
SELECT *, case when substr(md5({text}), 1, 8) < 'cccccccc' then 'train' else 'test' end AS split FROM ff"""


def scaled_sql(with_feedback: bool) -> str:
    """One slot per city id 0..8, then the other features, each scaled to its
    own range (a constant slot is 0.5)."""
    head, select = _feature_select(with_feedback)
    rest = (["day", "acceptance_time", "arrier_time", "pickup_time", "feedback_time", "feedback", "distance_to_merchant",
             "gps_measure_offset", "has_system_notification"] if with_feedback
            else ["day", "acceptance_time", "arrier_time", "pickup_time"])
    raw = [f"case when city_id = {k} then 1.0 else 0.0 end" for k in range(9)] + [f"cast({c} as double)" for c in rest]
    values = ", ".join(f"cast({x} as double) AS v{i}" for i, x in enumerate(raw))
    scaled = ", ".join(f"case when max(v{i}) OVER () = min(v{i}) OVER () then 0.5 else (v{i} - min(v{i}) OVER ())"
                       f" * (1.0::double / (max(v{i}) OVER () - min(v{i}) OVER ())) end AS f{i}" for i in range(len(raw)))
    return f"""{head.rstrip()}, ff AS ({select.strip()}),
raw AS (SELECT city_id, day, courier_id, shop_id, acceptance_time, {values} FROM ff)
SELECT city_id, day, courier_id, shop_id, acceptance_time, {scaled} FROM raw"""


def scaled_on_train_sql() -> str:
    """As ``scaled_sql`` of the report alone, ranges from the training rows."""
    raw = [f"case when city_id = {k} then 1.0 else 0.0 end" for k in range(9)] + [
        f"cast({c} as double)" for c in ("day", "acceptance_time", "arrier_time", "pickup_time")]
    top = lambda i: f"(max(v{i}) FILTER (WHERE split = 'train') OVER ())"
    low = lambda i: f"(min(v{i}) FILTER (WHERE split = 'train') OVER ())"
    scaled = ", ".join(f"case when {top(i)} = {low(i)} then 0.5 else (v{i} - {low(i)}) * (1.0::double / ({top(i)} - {low(i)})) end AS f{i}"
                       for i in range(len(raw)))
    values = ", ".join(f"cast({x} as double) AS v{i}" for i, x in enumerate(raw))
    return f"""WITH s AS ({split_sql(False)}),
raw AS (SELECT city_id, day, courier_id, shop_id, acceptance_time, split, {values} FROM s)
SELECT city_id, day, courier_id, shop_id, acceptance_time, {scaled} FROM raw"""


def fusion_check_sql() -> str:
    return f"""SELECT split, count(*) AS predictions, 0::bigint AS off_mean
FROM ({split_sql(False, 20)}) GROUP BY split"""


def streamed_scoring_sql() -> str:
    return f"""SELECT split, count(*) AS predictions, 0::bigint AS differing
FROM ({split_sql(False, 20)}) GROUP BY split"""


def _line(cols, **other) -> str:
    return " || ',' || ".join(f"'{other[c]}'" if c in other else f"coalesce(cast({c} as varchar), '')" for c in cols)


def csv_rejects_sql() -> str:
    """The broken lines of one row in 41; which fault follows from the row number."""
    faults = {0: (_line(_REPORT_COLS[:-1]), "too_few_fields", ""), 1: (_line(_REPORT_COLS) + " || ',more'", "too_many_fields", ""),
              2: (_line(_REPORT_COLS, acceptance_hour="x7", pickup_minute="1.5"), "bad_value", "acceptance_hour,pickup_minute"),
              3: (_line(_REPORT_COLS, shop_id='"open'), "unclosed_quote", "")}
    return with_base("\nUNION ALL\n".join(f"""
SELECT {text} AS line, '{reason}' AS reason, '{bad}' AS bad_columns
FROM courier_report WHERE no % 41 = 0 AND no % 5 = {k}""" for k, (text, reason, bad) in faults.items()))


def distinct_by_day_sql() -> str:
    return with_base("""
, days AS (SELECT DISTINCT day AS d FROM report_clean)
SELECT d AS day, count(*) AS orders, count(DISTINCT courier_id) AS couriers, count(DISTINCT shop_id) AS shops,
       true AS couriers_within, true AS shops_within
FROM days JOIN report_clean r ON r.day <= d GROUP BY d""")


def quantiles_by_day_sql() -> str:
    return with_base("""
, days AS (SELECT DISTINCT day AS d FROM timed WHERE diff IS NOT NULL)
SELECT d AS day, count(diff) AS timed_orders, true AS p01_within, true AS p50_within, true AS p99_within
FROM days JOIN timed t ON t.day <= d GROUP BY d""")


def top_lists_sql() -> str:
    lists = {"phone_mode": ("courier_device_clean", ["phone_mode"]), "os_version": ("courier_device_clean", ["phone_mode", "os_version"]),
             "brand": ("merchant_device_clean", ["brand"]), "model": ("merchant_device_clean", ["model"])}
    return with_base("\nUNION ALL\n".join(f"""
SELECT '{name}' AS list, {" || '/' || ".join(keys)} AS item, "count"
FROM (SELECT {", ".join(keys)}, count(*) AS "count" FROM {table} GROUP BY ALL ORDER BY "count" DESC, {", ".join(keys)} LIMIT 20)"""
                                            for name, (table, keys) in lists.items()))


def exact_split_sql() -> str:
    """ceil(80%) of each city's rows, in the order of their md5, are train."""
    head, select = _feature_select(False)
    text = " || '|' || ".join(["'42'"] + [f"coalesce(cast({c} as varchar), '')" for c in _SPLIT_COLS[False]])
    return f"""{head.rstrip()}, ff AS ({select.strip()})
SELECT *, case when row_number() OVER (PARTITION BY city_id ORDER BY md5({text})) * 100 < count(*) OVER (PARTITION BY city_id) * 80 + 100
          then 'train' else 'test' end AS split FROM ff"""


def text_clocks_sql() -> str:
    ok = lambda c: f"regexp_full_match({c}, '([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]')"
    sec = lambda c: (f"case when {ok(c)} then cast(substr({c}, 1, 2) as bigint) * 3600 + cast(substr({c}, 4, 2) as bigint) * 60 "  # noqa: E731
                     f"+ cast(substr({c}, 7, 2) as bigint) end")
    return with_base(f"""
, texts AS (SELECT no, day, courier_id, shop_id, {_fmt("acceptance")} AS a, {_fmt("delivery")} AS b FROM report_clean),
dirty AS (SELECT no, day, courier_id, shop_id, b AS delivery_text,
  case no % 17 when 0 then '24:00:00' when 1 then substr(a, 2, 7) when 2 then ' ' || a when 3 then substr(a, 1, 5)
               when 4 then substr(a, 1, 6) || '60' when 5 then 'noon' else a end AS acceptance_text FROM texts),
timed2 AS (SELECT *, {sec("acceptance_text")} AS acceptance_seconds, {sec("delivery_text")} AS delivery_seconds FROM dirty)
SELECT no, day, courier_id, shop_id, acceptance_text, delivery_text, acceptance_seconds,
       delivery_seconds - acceptance_seconds + case when delivery_seconds < acceptance_seconds then 86400 else 0 end AS work_duration_seconds
FROM timed2""")


def filtered_join_sql() -> str:
    keys = ["city_id", "day", "courier_id", "shop_id", "acceptance_hour", "acceptance_minute", "acceptance_second"]
    rest = [f"r.{c}" for c in _REPORT_COLS if c not in keys] + [f"f.{c}" for c in _FEEDBACK_COLS if c not in keys]
    return with_base(f"""
SELECT {", ".join(f"r.{k}" for k in keys)}, {", ".join(rest)}
FROM report_clean r LEFT JOIN feedback_clean f ON {" AND ".join(f"r.{k} = f.{k}" for k in keys)}""")


def csv_checked_rows_sql() -> str:
    return with_base(f"""
SELECT {", ".join(_REPORT_COLS)} FROM courier_report
UNION ALL
SELECT {", ".join("cast(null as int) AS day" if c == "day" else c for c in _REPORT_COLS)}
FROM courier_report WHERE no % 41 = 0 AND no % 5 = 4""")


_FAULT_KINDS = {
    "courier_feedback": "s i s s i i i i i i i d i".split(),
    "courier_report": "i s i s s".split() + ["i"] * 12,
    "merchant_device": "i s i s s s s s".split(),
}


def inject_faults_sql(table: str, seed: int = 7) -> str:
    """The raw table, the incomplete rows and the sentinel rows, by the rules of FIXTURES.md §3 in integers."""
    cols = {"courier_feedback": _FEEDBACK_COLS, "courier_report": _REPORT_COLS, "merchant_device": _MDEV_COLS}[table]
    nulls, sentinels = [], []
    for i, (c, kind) in enumerate(zip(cols, _FAULT_KINDS[table], strict=True)):
        x = f"(id * 7919 + {i * 104729 + seed * 1299709})"
        nulls.append({"s": f"cast(null as varchar) AS {c}", "i": f"cast({x} % 100 + 1 as int) AS {c}",
                      "d": f"cast({x} % 10000 as double) / 100.0 AS {c}"}[kind])
        sentinels.append({"s": f"'error' AS {c}", "i": f"cast(-100 as int) AS {c}", "d": f"cast(-100.0 as double) AS {c}"}[kind])
    n_null, n_sent = (1000 + (seed * 7919 + k * 104729) % 1001 for k in (0, 1))
    return with_base(f"""
SELECT {", ".join(cols)} FROM {table}
UNION ALL SELECT {", ".join(nulls)} FROM range({n_null}) AS t(id)
UNION ALL SELECT {", ".join(sentinels)} FROM range({n_sent}) AS t(id)""")


def _clean_after_faults_sql(table: str) -> str:
    if table == "merchant_device":
        # the sentinel rows are complete and pass (no rule): one survives the dedupe
        return with_base("""
SELECT * FROM merchant_device_clean
UNION ALL
SELECT -100, 'error', -100, 'error', 'error', 'error', 'error', 'error'""")
    return with_base(f"SELECT * FROM {'report_clean' if table == 'courier_report' else 'feedback_clean'}")


def oracle_queries() -> dict[str, str]:
    q = {
        "dataset_summary": with_base("""
SELECT count(*) AS orders, count(DISTINCT city_id) AS cities,
       count(DISTINCT courier_id) AS couriers, count(DISTINCT shop_id) AS shops
FROM report_clean"""),
        "avg_response_time": with_base("""
SELECT avg(response_time_seconds) AS avg_response_second,
       avg(response_time_seconds) / 60 AS avg_response_minute
FROM labelled"""),
        "courier_response_counts": with_base("""
SELECT courier_id, feedback_tran, count(*) AS feedback_count FROM labelled
GROUP BY courier_id, feedback_tran"""),
        "retry_leaderboard": with_base(f"""
SELECT courier_id, feedback_tran, count(*) AS feedback_count FROM labelled
WHERE feedback_tran = '{FEEDBACK_LABELS[0]}' GROUP BY courier_id, feedback_tran"""),
        "confirm_leaderboard": with_base(f"""
SELECT courier_id, feedback_tran, count(*) AS feedback_count FROM labelled
WHERE feedback_tran = '{FEEDBACK_LABELS[1]}' GROUP BY courier_id, feedback_tran"""),
        "courier_order_counts": with_base("""
SELECT courier_id, count(*) AS order_count FROM labelled GROUP BY courier_id"""),
        "order_work_duration": with_base(f"""
SELECT {", ".join(_REPORT_COLS)},
       {_fmt("acceptance")} AS acceptance_time,
       {_fmt("delivery")} AS delivery_time,
       {_WORK} AS work_duration_seconds
FROM timed"""),
        "courier_avg_work_duration": with_base(f"""
SELECT courier_id, avg({_WORK}) AS avg_work_duration_seconds FROM timed GROUP BY courier_id"""),
        "courier_final": courier_final_sql(),
        "average_delivery_time": with_base("""
SELECT avg(diff) AS average_delivery_second, avg(diff) / 60 AS average_delivery_minute FROM timed"""),
        "delivery_time_by_city_hour": city_hour_sql(260),
        "top_busy_hours_per_city": busy_hours_sql(260),
        "top_busy_hours_per_city_min1000": busy_hours_sql(1000),
        "courier_phone_mode_counts": _topn_sql("courier_device_clean", ["phone_mode"]),
        "courier_os_version_counts": _topn_sql("courier_device_clean", ["phone_mode", "os_version"]),
        "courier_city_phone_mode_favourite": _favourite_sql("courier_device_clean", "phone_mode"),
        "shop_brand_counts": _topn_sql("merchant_device_clean", ["brand"]),
        "shop_model_counts": _topn_sql("merchant_device_clean", ["model"]),
        "shop_city_model_favourite": _favourite_sql("merchant_device_clean", "model"),
        "city_courier_merchant_counts": with_base("""
, cc AS (SELECT try_cast(city_id as int) AS city_id, count(*) AS courier_count FROM courier_device_clean GROUP BY 1),
  mc AS (SELECT try_cast(city_id as int) AS city_id, count(*) AS merchant_count FROM merchant_device_clean GROUP BY 1)
SELECT d.city_name, cc.courier_count, mc.merchant_count
FROM cc JOIN mc ON cc.city_id = mc.city_id JOIN city_dim d ON cast(cc.city_id as bigint) = d.city_id"""),
        "average_delivery_time_wrapped": with_base(f"""
SELECT avg({_WORK}) AS average_delivery_second, avg({_WORK}) / 60 AS average_delivery_minute FROM timed"""),
        "courier_final_approx": courier_final_sql(),
        "city_distinct_entity_counts": with_base("""
, cc AS (SELECT try_cast(city_id as int) AS city_id, count(DISTINCT courier_id) AS courier_count FROM courier_device_clean GROUP BY 1),
  mc AS (SELECT try_cast(city_id as int) AS city_id, count(DISTINCT shop_id) AS merchant_count FROM merchant_device_clean GROUP BY 1)
SELECT d.city_name, cc.courier_count, mc.merchant_count
FROM cc JOIN mc ON cc.city_id = mc.city_id JOIN city_dim d ON cast(cc.city_id as bigint) = d.city_id"""),
        "feedback_join_fanout": with_base("""
, k AS (SELECT city_id, day, courier_id, shop_id, acceptance_hour, acceptance_minute, acceptance_second, count(*) AS n
        FROM feedback_clean GROUP BY ALL),
  j AS (SELECT coalesce(k.n, 1) AS n FROM report_clean r LEFT JOIN k USING
        (city_id, day, courier_id, shop_id, acceptance_hour, acceptance_minute, acceptance_second))
SELECT count(*) AS report_rows, cast(sum(n) as bigint) AS joined_rows,
       (SELECT count(*) FROM k WHERE n > 1) AS fanout_keys, (SELECT max(n) FROM k) AS most_per_key
FROM j"""),
        "hot_key_join": with_base("""
, d AS (SELECT city_id, count(*) AS devices FROM courier_device_clean GROUP BY city_id)
SELECT r.city_id, d.devices, r.no, r.courier_id FROM d JOIN report_clean r ON d.city_id = r.city_id"""),
        "train_test_split_with_feedback": split_sql(True),
        "train_test_split_report_only": split_sql(False),
        "scaled_features_with_feedback": scaled_sql(True),
        "scaled_features_report_only": scaled_sql(False),
        "fusion_check_report_only": fusion_check_sql(),
        "inject_faults_courier_feedback": inject_faults_sql("courier_feedback"),
        "inject_faults_courier_report": inject_faults_sql("courier_report"),
        "inject_faults_merchant_device": inject_faults_sql("merchant_device"),
        "csv_round_trip_courier_device": with_base("SELECT * FROM courier_device"),
        "catalog_round_trip_merchant_device": with_base(
            "SELECT *, 1::bigint AS tables_listed, 8::bigint AS columns_described FROM merchant_device"),
        "sql_view_orders_by_city_day": with_base("""
SELECT city_id, day, count(*) AS orders, count(DISTINCT courier_id) AS couriers
FROM report_clean GROUP BY city_id, day HAVING count(*) > 100"""),
        "shop_order_counts": with_base("""
SELECT shop_id, count(*) AS order_count FROM feedback_clean GROUP BY shop_id"""),
        "shop_top_by_day": with_base("""
, c AS (SELECT day, shop_id, count(*) AS shop_day_count FROM feedback_clean GROUP BY day, shop_id),
  r AS (SELECT *, rank() OVER (PARTITION BY day ORDER BY shop_day_count DESC) AS rk FROM c)
SELECT day, shop_id, shop_day_count FROM r WHERE rk <= 3"""),
        "clean_courier_device": with_base("SELECT * FROM courier_device_clean"),
        "clean_merchant_device": with_base("SELECT * FROM merchant_device_clean"),
        "clean_courier_feedback": with_base("SELECT * FROM feedback_clean"),
        "clean_courier_report": with_base("SELECT * FROM report_clean"),
        "clean_audit": clean_audit_sql(),
        "clean_audit_while_writing": clean_audit_sql(),
        "incremental_clean_courier_report": with_base("""
SELECT *, case day when 3 then 'changed' when 7 then 'new' else 'unchanged' end AS status FROM report_clean"""),
        "streamed_clean_courier_feedback": with_base("SELECT * FROM feedback_clean"),
        "corrupted_table_merchant_device": inject_faults_sql("merchant_device"),
        "scaled_features_fitted_on_train": scaled_on_train_sql(),
        "csv_rejects_courier_report": csv_rejects_sql(),
        "csv_checked_rows_courier_report": csv_checked_rows_sql(),
        "streamed_scoring_report_only": streamed_scoring_sql(),
        "distinct_counts_by_day_prefix": distinct_by_day_sql(),
        "work_quantiles_by_day_prefix": quantiles_by_day_sql(),
        "courier_final_from_days": courier_final_sql(),
        "top_lists_from_summaries": top_lists_sql(),
        "text_clock_durations": text_clocks_sql(),
        "exact_split_report_only": exact_split_sql(),
        "filtered_feedback_join": filtered_join_sql(),
        "clean_after_faults_courier_feedback": _clean_after_faults_sql("courier_feedback"),
        "clean_after_faults_courier_report": _clean_after_faults_sql("courier_report"),
        "clean_after_faults_merchant_device": _clean_after_faults_sql("merchant_device"),
        "feature_frame_with_feedback": feature_frame_sql(True),
        "feature_frame_report_only": feature_frame_sql(False),
        "baseline_model_metrics": baseline_metrics_sql(),
    }
    q["orc_result_shop_top_by_day"] = q["shop_top_by_day"]
    return q
