"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import key_filter, may_match

# Largest Arrow batch handed to a Python task, in bytes and rows.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Limit the Arrow batches of the session by bytes as well as rows, so a
    batch of very long texts fits a small worker. Results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, shared by driver and executors: that of
    ``spark.checkpoint.dir``, or a scratch folder if that is unset and the
    master is local."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of ``df`` in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def full_text(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)],
                                      schema=schema)


def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """First two columns of each batch as Python lists."""
    for b in batches:
        yield b.column(0).to_pylist(), b.column(1).to_pylist()


def arrow_id(df: DataFrame, name: str) -> tuple[str, pa.DataType]:
    """Spark and Arrow type of an identifier column, kept in the result."""
    kind = df.schema[name].dataType.simpleString()
    return kind, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


# Lists of ids up to this length are broadcast (1.9 million of them: about 230 MB of the driver's heap, as measured).
BROADCAST_IDS = 2_000_000
# Where several lists are alive at once, up to this length (about 25 MB); longer ones are joined by shuffle.
FEW_IDS = 200_000


def small(df: DataFrame, rows: int = BROADCAST_IDS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` (short) rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def by_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` whose doc_id is ("left_semi") or is not ("left_anti") among the
    distinct ``ids`` (stored, without null). A short list is broadcast; a longer
    one joins by shuffle, from which a broadcast filter of at most 16 MB keeps
    the rows whose id cannot be listed."""
    count = ids.count()
    if count <= FEW_IDS:
        return docs.join(F.broadcast(ids), "doc_id", how)
    found = key_filter(ids, ["doc_id"], count)
    if found is None:
        return docs.join(ids, "doc_id", how)
    flagged = may_match(docs, found, ["doc_id"])
    joined = flagged.where("_may").join(ids, "doc_id", how).select(docs.columns)
    return joined if how == "left_semi" else joined.union(flagged.where("not _may").select(docs.columns))


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``ids``; null ids stay."""
    ids = stored(ids.where("doc_id is not null").select("doc_id").distinct())
    return by_ids(docs, ids, "left_anti").select(docs.columns)
