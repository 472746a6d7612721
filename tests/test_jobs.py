"""Sources, sinks, jobs and streaming ingestion against a scratch warehouse."""

import os

from fleetlens.plans import jobs
from fleetlens.plans.tables import CourierTables
from fleetlens.schemas import TABLES
from fleetlens.sources import catalog, csv_files
from fleetlens.streaming.ingest import ingest_stream


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _write_csv(tables, scratch, parts=2):
    paths = {}
    for t in TABLES:
        out = os.path.join(scratch, t)
        csv_files.write_table(tables.raw(t).repartition(parts), out)
        paths[t] = [os.path.join(out, f) for f in sorted(os.listdir(out)) if f.endswith(".csv")]
    return paths


def test_csv_round_trip_and_jobs(spark, tables, scratch_dir):
    paths = _write_csv(tables, scratch_dir)
    assert all(len(p) >= 1 for p in paths.values())
    jobs.ingest_job(spark, "raw_db", paths)
    for t in TABLES:
        assert _same(catalog.table(spark, "raw_db", t), tables.raw(t))

    for _ in range(2):                          # the job can be run again
        audit = jobs.clean_job(CourierTables.from_catalog(spark, "raw_db"), "raw_db")
        assert audit.count() == 4
    for t in TABLES:
        assert _same(catalog.table(spark, "raw_db", t + "_clean"), tables.clean(t))

    from_catalog = CourierTables.from_catalog(spark, "raw_db", clean_suffix="_clean")
    written = jobs.analysis_job(from_catalog, "result_db", min_count=26)
    assert len(written) == 14
    listed = {r.tableName for r in catalog.list_tables(spark, "result_db").collect()}
    assert set(written) <= listed
    prov = spark.sql("DESCRIBE TABLE EXTENDED result_db.shop_top_by_day").where("col_name = 'Provider'").first()
    assert prov.data_type.lower() == "orc"

    before = catalog.table(spark, "raw_db", "merchant_device").count()
    jobs.fault_job(spark, "raw_db", tables=("merchant_device",), seed=1)
    after = catalog.table(spark, "raw_db", "merchant_device").count()
    assert 2000 <= after - before <= 4000
    # clean tables are read only when asked for, so appended rows are seen
    seen = CourierTables.from_catalog(spark, "raw_db").merchants
    assert seen.where("city_id = 'error' and no = -100").count() == 1


def test_only_asked_results_are_built(spark, tables, monkeypatch):
    from fleetlens.plans import analytics as A
    held = lambda: {r for r in spark.sparkContext._jsc.getPersistentRDDs()}
    before = held()
    monkeypatch.setattr(A, "courier_final", lambda *a, **k: 1 / 0)
    assert jobs.analysis_job(tables, "only_db", only=["shop_order_counts"]) == ["shop_order_counts"]
    monkeypatch.undo()
    jobs.analysis_job(tables, "only_db", min_count=26, only=["avg_response_time", "shop_top_by_day"])
    assert held() <= before


def test_clean_once_prunes_and_drops_the_full_row_shuffle(spark, tables, scratch_dir):
    from fleetlens.plans import analytics as A
    once = tables.write_clean(scratch_dir + "/clean")
    got = A.dataset_summary(once.report)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "acceptance_hour" not in plan and "ReadSchema: struct<city_id:string,courier_id:string,shop_id:string>" in plan
    assert _same(got, A.dataset_summary(tables.report))


RESTART = """
import sys
from fleetlens.session import build_session
from fleetlens.sources import csv_files
from fleetlens.streaming.ingest import ingest_stream
root, step = sys.argv[1], int(sys.argv[2])
spark = build_session("local[2]", 2, extra={"spark.checkpoint.dir": root + "/ckpt", "spark.sql.warehouse.dir": root + "/wh"})
rows = [(i, str(step), 1, "c", "v", "m") for i in range(step * 10)]
df = spark.createDataFrame(rows, "no int, city_id string, day int, courier_id string, os_version string, phone_mode string")
csv_files.write_table(df.coalesce(1), f"{root}/landing/batch{step}")
if step > 1:         # the catalog of a local session is in memory: name the table's old place again
    spark.sql("CREATE DATABASE IF NOT EXISTS restart_db")
    spark.catalog.createTable("restart_db.courier_device", path=root + "/wh/restart_db.db/courier_device", source="parquet")
ingest_stream(spark, "courier_device", root + "/landing/*", "restart_db").awaitTermination()
print("ROWS", spark.table("restart_db.courier_device").count())
"""


def test_stream_ingest_goes_on_in_a_new_application(scratch_dir):
    import subprocess
    import sys
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    for step, want in ((1, 10), (2, 30), (3, 60)):
        out = subprocess.run([sys.executable, "-c", RESTART, scratch_dir, str(step)], env=env, capture_output=True,
                             text=True, timeout=300, cwd=scratch_dir)
        assert f"ROWS {want}\n" in out.stdout, out.stderr[-2000:]


def test_no_machine_local_checkpoint_on_a_cluster(spark):
    import pytest
    from fleetlens import session

    class Cluster:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Cluster(), Conf()

    for fn in (session.ensure_checkpoint_dir, lambda s: session.stable_folder(s, "x")):
        with pytest.raises(ValueError):
            fn(Session())
    assert session.is_local("local[4]") and not session.is_local("local-cluster[1,1,1024]")
    assert session.ensure_checkpoint_dir(spark)


def test_result_orders(tables):
    from fleetlens.plans import analytics as A
    final = [r.final_score for r in A.courier_final(tables.report, tables.feedback).collect()]
    assert final == sorted(final, reverse=True)
    counts = [(-r.order_count, r.shop_id) for r in A.shop_order_counts(tables.feedback).collect()]
    assert counts == sorted(counts)
    busy = [r.avg_delivery_time_seconds for r in A.top_busy_hours_per_city(tables.report, 26).collect()]
    assert busy == sorted(busy, reverse=True) and len(busy) > 5


def test_sql_text_over_views(spark, tables):
    df = catalog.sql(spark, """
        SELECT phone_mode, COUNT(*) AS count FROM courier_view
        GROUP BY phone_mode ORDER BY count DESC, phone_mode LIMIT 20""",
                     views={"courier_view": tables.couriers})
    from fleetlens.plans import analytics as A
    assert _same(df, A.courier_phone_mode_counts(tables.couriers))


def test_stream_ingest_is_incremental(spark, tables, scratch_dir):
    landing = os.path.join(scratch_dir, "landing")
    src = tables.raw("courier_feedback").repartition(2)
    csv_files.write_table(src, os.path.join(landing, "batch1"))
    ckpt = os.path.join(scratch_dir, "ckpt")
    q = ingest_stream(spark, "courier_feedback", os.path.join(landing, "*"), "stream_db", checkpoint_location=ckpt)
    q.awaitTermination()
    assert spark.table("stream_db.courier_feedback").count() == src.count()
    # a second arrival: only the new files are loaded
    csv_files.write_table(src.limit(10), os.path.join(landing, "batch2"))
    q = ingest_stream(spark, "courier_feedback", os.path.join(landing, "*"), "stream_db", checkpoint_location=ckpt)
    q.awaitTermination()
    assert spark.table("stream_db.courier_feedback").count() == src.count() + 10


def test_catalog_source_is_lazy(spark):
    t = CourierTables.from_catalog(spark, "no_such_db")   # nothing resolved yet
    import pytest
    with pytest.raises(Exception):
        t.raw("courier_report").count()


def test_spread_only_when_scan_is_narrow_and_small(spark, scratch_dir, monkeypatch):
    from fleetlens.sources import adapter
    path = os.path.join(scratch_dir, "one")
    spark.range(1000).coalesce(1).write.parquet(path)
    narrow = spark.read.parquet(path)
    want = spark.sparkContext.defaultParallelism
    assert adapter.spread(narrow).rdd.getNumPartitions() == want
    wide = spark.range(0, 1000, numPartitions=want * 2)
    assert adapter.spread(wide).rdd.getNumPartitions() == want * 2
    assert sorted(r.id for r in adapter.spread(narrow).collect()) == list(range(1000))
    monkeypatch.setattr(adapter, "SPREAD_BYTES", 10)
    assert adapter.spread(narrow).rdd.getNumPartitions() == 1


def test_keys_beyond_32_bits(spark):
    from fleetlens.sources import adapter
    big = spark.createDataFrame([(3_000_000_000, 1, 1, 1, 5.0, "N"), (7, 1, 1, 1, 5.0, "N")],
                                "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string")
    assert sorted({r.no for r in adapter.courier_report(big).collect()}) == [7, 3_000_000_000 % 2147483647]


def test_bucketed_clean_tables_join_without_shuffle(spark, tables):
    from fleetlens.plans.features import feature_frame
    jobs.clean_job(tables, "bucket_db", fact_buckets=8)
    t = CourierTables.from_catalog(spark, "bucket_db", clean_suffix="_clean")
    # the tiny test tables would otherwise be broadcast; check the large-table path
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = feature_frame(t.report, t.feedback, skew_safe=False)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "Exchange hashpartitioning" not in plan
        assert _same(joined, feature_frame(tables.report, tables.feedback))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
