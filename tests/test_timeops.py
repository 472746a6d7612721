"""Time-of-day rules: the three overnight conventions and range handling."""

from pyspark.sql import functions as F

from fleetlens.functions import timeops as T


def _clock_row(spark, acc, dlv):
    (ah, am, as_), (dh, dm, ds) = acc, dlv
    return spark.createDataFrame(
        [(ah, am, as_, dh, dm, ds)],
        "acceptance_hour int, acceptance_minute int, acceptance_second int, "
        "delivery_hour int, delivery_minute int, delivery_second int")


def test_midnight_wrap_and_no_wrap(spark):
    df = _clock_row(spark, (23, 50, 0), (0, 10, 0))
    r = df.select(T.duration_seconds("acceptance", "delivery", "none").alias("a"),
                  T.duration_seconds("acceptance", "delivery", "midnight").alias("b")).first()
    assert (r.a, r.b) == (-85200, 1200)


def test_zero_duration(spark):
    df = _clock_row(spark, (10, 0, 0), (10, 0, 0))
    r = df.select(T.duration_seconds("acceptance", "delivery", "none").alias("a"),
                  T.duration_seconds("acceptance", "delivery", "midnight").alias("b")).first()
    assert (r.a, r.b) == (0, 0)


def test_rules_differ(spark):
    df = _clock_row(spark, (17, 0, 0), (0, 30, 0))
    r = df.select(T.duration_seconds("acceptance", "delivery", "midnight").alias("w"),
                  T.stage_minutes_columns(["acceptance", "delivery"])["delivery_time"].alias("m")).first()
    assert r.w == 27000
    assert r.m == 30          # accepted 17:00 is not "evening": no wrap


def test_out_of_range_hour_gives_null(spark):
    for hour in (24, 100):
        df = _clock_row(spark, (10, 0, 0), (hour, 0, 0))
        r = df.select(T.duration_seconds("acceptance", "delivery", "midnight").alias("d"),
                      T.time_text("delivery").alias("t")).first()
        assert r.d is None and r.t is None


def test_time_text(spark):
    df = _clock_row(spark, (7, 5, 9), (23, 59, 59))
    r = df.select(T.time_text("acceptance").alias("a"), T.time_text("delivery").alias("d")).first()
    assert (r.a, r.d) == ("07:05:09", "23:59:59")


def test_evening_wrap_edges(spark):
    rows = [(1080, 60), (1081, 60), (1200, 119), (1200, 120)]
    df = spark.createDataFrame(rows, "acc int, stage int")
    got = [r.w for r in df.select(T.evening_wrap(F.col("stage"), F.col("acc")).alias("w")).collect()]
    assert got == [60, 1500, 1559, 120]


def test_response_seconds_no_wrap(spark):
    df = spark.createDataFrame([(23, 59, 0, 0, 1, 0)],
                               "acceptance_hour int, acceptance_minute int, acceptance_second int, "
                               "feedback_hour int, feedback_minute int, feedback_second int")
    assert df.select(T.response_seconds().alias("r")).first().r == 60 - 86340
