"""Time-of-day column expressions (P-1 .. P-7).

Times are stored as separate hour / minute / second integers. Everything
here is column arithmetic, so it stays inside whole-stage codegen. Time
text from other sources goes through ``parse_clock``, which gives NULL where
plain parsing would raise under ANSI mode ("24:00:00").

Three different overnight rules exist and are kept apart on purpose:

* ``wrap="none"``     difference as is, can be negative (response and
                      delivery times);
* ``wrap="midnight"`` a negative difference gains one day (work duration);
* ``evening_wrap``    minute-of-day + 1440 when accepted after 18:00 and the
                      stage is before 02:00 (model features).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400
MINUTES_PER_DAY = 1440


def _parts(prefix: str):
    return (F.col(f"{prefix}_hour").cast("long"),
            F.col(f"{prefix}_minute").cast("long"),
            F.col(f"{prefix}_second").cast("long"))


def in_clock_range(prefix: str) -> Column:
    """True when hour is 0..23 and minute, second are 0..59."""
    h, m, s = _parts(prefix)
    return h.between(0, 23) & m.between(0, 59) & s.between(0, 59)


def seconds_of_day(prefix: str, validate: bool = False) -> Column:
    """h*3600 + m*60 + s as bigint (P-1). With ``validate`` an out-of-range
    clock reading gives NULL instead of a number."""
    h, m, s = _parts(prefix)
    total = h * 3600 + m * 60 + s
    return F.when(in_clock_range(prefix), total) if validate else total


def duration_seconds(start: str, end: str, wrap: str = "none",
                     validate: bool = True) -> Column:
    """Seconds from stage ``start`` to stage ``end`` (P-4, P-5)."""
    return wrapped(seconds_of_day(end, validate) - seconds_of_day(start, validate), wrap)


def wrapped(diff: Column, wrap: str) -> Column:
    """A difference in seconds under one of the overnight rules."""
    if wrap == "none":
        return diff
    if wrap == "midnight":
        return F.when(diff < 0, diff + SECONDS_PER_DAY).otherwise(diff)
    raise ValueError(f"unknown wrap rule {wrap!r}")


def response_seconds() -> Column:
    """Notification response time: feedback minus acceptance, no wrap (P-1)."""
    return duration_seconds("acceptance", "feedback", wrap="none", validate=False)


def time_text(prefix: str) -> Column:
    """``HH:mm:ss`` text of a stage (P-3); NULL when out of clock range (so
    the two-character pad never truncates)."""
    parts = [F.lpad(F.col(f"{prefix}_{p}").cast("string"), 2, "0") for p in ("hour", "minute", "second")]
    return F.when(in_clock_range(prefix), F.concat_ws(":", *parts))


def parse_clock(text: Column) -> Column:
    """Seconds of day of ``HH:mm:ss`` text (P-4). What is no time of day in
    exactly that form ("24:00:00", "7:05:00", "07:05", blanks, other text) is
    NULL; nothing raises under ANSI mode."""
    # a fixed day without a clock change anywhere; the fields are read back in
    # the time zone that they were parsed in, so the zone doesn't matter
    t = F.try_to_timestamp(F.concat(F.lit("2001-01-03 "), text), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.when(text.rlike("^[0-9]{2}:[0-9]{2}:[0-9]{2}$"), F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("long")


def text_duration_seconds(start: Column, end: Column, wrap: str = "none") -> Column:
    """Seconds between two ``HH:mm:ss`` texts (P-4, P-5), by the rules of ``duration_seconds``."""
    return wrapped(parse_clock(end) - parse_clock(start), wrap)


def minutes_of_day(prefix: str) -> Column:
    """h*60 + m as int (P-2)."""
    return (F.col(f"{prefix}_hour") * 60 + F.col(f"{prefix}_minute")).cast("int")


def evening_wrap(stage_minutes: Column, acceptance_minutes: Column,
                 accepted_after: int = 1080, stage_before: int = 120) -> Column:
    """Add a day to a stage that falls after midnight for an order accepted in
    the evening (P-6). Both comparisons are strict."""
    return F.when((acceptance_minutes > accepted_after) & (stage_minutes < stage_before),
                  stage_minutes + MINUTES_PER_DAY).otherwise(stage_minutes)


def stage_minutes_columns(stages, accepted_after: int = 1080,
                          stage_before: int = 120) -> dict[str, Column]:
    """``{stage}_time`` minute-of-day columns for each stage (P-7). The
    acceptance stage is never wrapped; every other stage is compared with it."""
    acceptance = minutes_of_day("acceptance")
    out = {}
    for stage in stages:
        raw = minutes_of_day(stage)
        out[f"{stage}_time"] = raw if stage == "acceptance" else evening_wrap(
            raw, acceptance, accepted_after, stage_before)
    return out
