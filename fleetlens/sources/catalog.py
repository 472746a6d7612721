"""Catalog operations (S-3, S-4, S-6, S-7, S-9, S-10) and table sinks
(K-1 .. K-3). Only the session's own catalog is used; Hive support is
optional and comes from the caller's session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def qualified(database: str | None, name: str) -> str:
    return f"{database}.{name}" if database else name


def create_database(spark: SparkSession, database: str) -> None:
    """S-4: ``CREATE DATABASE IF NOT EXISTS``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def table(spark: SparkSession, database: str | None, name: str) -> DataFrame:
    """S-3: lazy scan of a catalog table."""
    return spark.table(qualified(database, name))


def table_exists(spark: SparkSession, database: str | None, name: str) -> bool:
    return spark.catalog.tableExists(qualified(database, name))


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """S-10: the catalog listing as a DataFrame (namespace, tableName, isTemporary)."""
    return spark.sql(f"SHOW TABLES IN `{database}`" if database else "SHOW TABLES")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """S-6: expose a DataFrame to SQL text."""
    df.createOrReplaceTempView(name)
    return df


def sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """S-7: run SQL text over named DataFrames; Catalyst plans it exactly like
    the equivalent DataFrame code."""
    for name, df in (views or {}).items():
        register_view(df, name)
    return spark.sql(text)


def describe(spark: SparkSession, database: str | None, name: str) -> DataFrame:
    """S-9: the schema of a table as rows (position, column, type)."""
    fields = table(spark, database, name).schema.fields
    return spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)],
                                 "position int, column_name string, data_type string")


def write_table(df: DataFrame, database: str | None, name: str, fmt: str | None = None,
                mode: str = "overwrite", partition_by=None, bucket_by: tuple | None = None) -> None:
    """K-1 (default provider) and K-2 (``fmt="orc"``): managed-table write.

    The database is created on first use; results are written into a result
    namespace that is otherwise never created.
    """
    if database:
        create_database(df.sparkSession, database)
    w = df.write.mode(mode)
    if fmt:
        w = w.format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if bucket_by:
        # (buckets, columns): rows hashed into a fixed number of sorted
        # buckets, so joins / aggregates on those columns skip the shuffle
        buckets, cols = bucket_by
        w = w.bucketBy(buckets, *cols).sortBy(*cols)
    w.saveAsTable(qualified(database, name))


def append_table(df: DataFrame, database: str | None, name: str) -> None:
    """K-3: append into an existing table, matching columns by position in
    the table's own column order."""
    target = qualified(database, name)
    cols = df.sparkSession.table(target).columns
    df.select(*cols).write.insertInto(target, overwrite=False)
