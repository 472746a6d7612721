"""Property tests: column expressions against plain-Python definitions."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.functions import timeops as T
from fleetlens.functions.scoring import clamped_score

clock = st.tuples(st.integers(-2, 30), st.integers(-2, 65), st.integers(-2, 65))


def _py_seconds(c):
    h, m, s = c
    return h * 3600 + m * 60 + s if (0 <= h <= 23 and 0 <= m <= 59 and 0 <= s <= 59) else None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(clock, clock), min_size=1, max_size=60))
def test_durations_match_python(spark, pairs):
    rows = [(*a, *d) for a, d in pairs]
    df = spark.createDataFrame(rows, "acceptance_hour int, acceptance_minute int, acceptance_second int, "
                                     "delivery_hour int, delivery_minute int, delivery_second int")
    got = df.select(T.duration_seconds("acceptance", "delivery", "none").alias("n"),
                    T.duration_seconds("acceptance", "delivery", "midnight").alias("w"),
                    T.time_text("delivery").alias("t")).collect()
    for (a, d), r in zip(pairs, got):
        sa, sd = _py_seconds(a), _py_seconds(d)
        want = None if sa is None or sd is None else sd - sa
        assert r.n == want
        assert r.w == (None if want is None else (want + 86400 if want < 0 else want))
        assert r.t == (None if sd is None else "%02d:%02d:%02d" % d)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1439), st.integers(0, 1439)), min_size=1, max_size=80))
def test_evening_wrap_matches_python(spark, pairs):
    df = spark.createDataFrame(pairs, "acc int, stage int")
    got = [r.w for r in df.select(T.evening_wrap(F.col("stage"), F.col("acc")).alias("w")).collect()]
    assert got == [s + 1440 if a > 1080 and s < 120 else s for a, s in pairs]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-50, 150, allow_nan=False), min_size=1, max_size=50),
       st.floats(0, 50), st.floats(0, 100))
def test_scores_clamped_and_monotone(spark, values, lo, width):
    hi = lo + width
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", clamped_score(F.col("v"), F.lit(lo), F.lit(hi), True).alias("up"),
                     clamped_score(F.col("v"), F.lit(lo), F.lit(hi), False).alias("down")).collect()
    for r in rows:
        assert 0.0 <= r.up <= 100.0 and 0.0 <= r.down <= 100.0
        if hi > lo and lo < r.v < hi:
            assert abs(r.up + r.down - 100.0) < 1e-9
    ordered = sorted(rows, key=lambda r: r.v)
    assert all(a.up <= b.up and a.down >= b.down for a, b in zip(ordered, ordered[1:]))
