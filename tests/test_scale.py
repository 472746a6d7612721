"""Work that must be done once, or must not grow with the rows."""

import io
from contextlib import redirect_stdout

from fleetlens.plans import models as M
from fleetlens.plans import registry as R
from fleetlens.plans.features import feature_frame
from fleetlens.schemas import FEEDBACK_JOIN_KEYS


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_one_shuffle_serves_dedupe_and_join(spark, tables):
    clean = tables.placed("courier_feedback", FEEDBACK_JOIN_KEYS)
    assert plan(clean).count("Exchange hashpartitioning") == 1
    per_key = clean.groupBy(*FEEDBACK_JOIN_KEYS).count()
    assert plan(per_key).count("Exchange hashpartitioning") == 1
    for name in ("courier_feedback", "courier_report"):
        placed = tables.placed(name, FEEDBACK_JOIN_KEYS)
        assert sorted(map(repr, placed.collect())) == sorted(map(repr, tables.clean(name).collect()))


def test_scaled_features_build_the_frame_once(spark, tables):
    out = M.scaled_features(feature_frame(tables.report), False)
    assert "Aggregate" not in plan(out) and "parquet" in plan(out).lower()
    assert out.count() == tables.report.count()


def test_partitions_of_a_fit_are_bounded():
    assert [M.partitions_for(n) for n in (0, 50_000, 50_001, 430_000)] == [1, 1, 2, 9]
    assert M.partitions_for(4_300_000) == 48 and M.partitions_for(173_000_000) == 173


def test_quantiles_clean_the_report_once(spark, tables, monkeypatch):
    seen = []
    check = R.daily.quantile_bound_check
    monkeypatch.setattr(R.daily, "quantile_bound_check", lambda rows, *rest: seen.append(plan(rows)) or check(rows, *rest))
    got = R._quantiles_by_day(tables).collect()
    assert "Aggregate" not in seen[0] and got and all(r.p01_within and r.p50_within and r.p99_within for r in got)
