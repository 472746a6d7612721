"""Session construction and shared-storage helpers.

Library code never builds its own session: jobs receive the caller's
``SparkSession``. ``build_session`` exists for tests, the bench and local runs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans shuffles at runtime
# (partition coalescing, skew-join splitting, broadcast conversion from
# measured sizes), and ANSI mode stays on, so dirty keys go through try_cast.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of frames no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Split generated expression code into smaller methods, so most of it
    # stays under HotSpot's 8000-byte JIT limit and compiles quickly (about
    # 20% faster on the wide clean-and-aggregate stages here).
    "spark.sql.codegen.methodSplitThreshold": "256",
    # Full-row dedupe of the wide fact tables still fuses generator, filter
    # and a 17-key partial aggregate into one method above that limit;
    # without this flag the stage runs interpreted (about 5x slower).
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "fleetlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def stable_folder(spark: SparkSession, name: str) -> str:
    """A path under the folder *named* by ``spark.checkpoint.dir``: the same in
    every application (Spark's own checkpoint folder gets a new name in each)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("progress that survives restarts needs spark.checkpoint.dir or an explicit location")
    return base.rstrip("/") + "/" + name


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage and is used as is. With a
    local master (tests) an unset setting gets a scratch folder; on a cluster
    that would be one machine's own folder, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise ValueError("spark.checkpoint.dir is not set; name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="fleetlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def kept_folder(spark: SparkSession, name: str) -> str:
    """``stable_folder`` where ``spark.checkpoint.dir`` names one, else (a local
    master) a folder that this application keeps."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return stable_folder(spark, name)
    return f"{ensure_checkpoint_dir(spark)}/{name}"


def materialize(df, checkpoint: bool = True):
    """Cut the lineage of a frame that several jobs read: a reliable
    checkpoint into the shared checkpoint folder (survives executor loss),
    or a cache when ``checkpoint`` is off."""
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df.cache()


def kept_rows(df):
    """``df`` stored once as Parquet in the shared checkpoint folder and read
    from there: for wide frames that several jobs read a few columns of, a
    fraction of a checkpoint's bytes. The folder stays until the checkpoint
    folder is emptied."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
