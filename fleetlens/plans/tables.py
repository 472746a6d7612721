"""Where the courier tables come from, raw and clean.

A ``CourierTables`` holds the four raw tables as lazy DataFrames from one
source (the driver's parquet tables through the adapter, a catalog
database, or delimited files) and hands out the cleaned version of each.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.cleaning import clean_placed, clean_table
from ..schemas import TABLES
from ..sources import adapter, catalog, csv_files


@dataclass
class CourierTables:
    spark: SparkSession
    raw_frames: dict[str, DataFrame]
    clean_frames: dict[str, DataFrame] = field(default_factory=dict)
    raw_builders: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)
    stored_clean: set[str] = field(default_factory=set)     # clean tables that are read, not computed

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "CourierTables":
        """Raw tables derived from the driver's parquet tables, built on first use."""
        builders = {t: (lambda t=t: adapter.raw_table(spark, sf_dir, t)) for t in TABLES}
        return cls(spark, {}, raw_builders=builders)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, clean_suffix: str | None = None) -> "CourierTables":
        """Raw tables ``{database}.{name}``, resolved on first use, and cleaned
        from the raw rows. With ``clean_suffix`` the clean tables that exist
        are read instead: whoever asks for them knows that ``clean_job`` ran
        after the last load."""
        builders = {t: (lambda t=t: catalog.table(spark, database, t)) for t in TABLES}
        out = cls(spark, {}, raw_builders=builders)
        if clean_suffix:
            for t in TABLES:
                if catalog.table_exists(spark, database, t + clean_suffix):
                    out.clean_frames[t] = catalog.table(spark, database, t + clean_suffix)
                    out.stored_clean.add(t)
        return out

    @classmethod
    def from_clean(cls, spark: SparkSession, folder: str) -> "CourierTables":
        """Clean tables written by ``write_clean``; there are no raw ones."""
        frames = {t: spark.read.parquet(f"{folder.rstrip('/')}/{t}") for t in TABLES}
        return cls(spark, {}, frames, stored_clean=set(TABLES))

    def write_clean(self, folder: str) -> "CourierTables":
        """Clean once: store the four clean tables as Parquet under ``folder``
        and return tables that read them, with pruned columns and pushed
        filters and without the full-row shuffle."""
        for t in TABLES:
            self.clean(t).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{t}")
        return CourierTables.from_clean(self.spark, folder)

    @classmethod
    def from_csv(cls, spark: SparkSession, paths: dict[str, list[str] | str]) -> "CourierTables":
        return cls(spark, {t: csv_files.read_table(spark, t, p) for t, p in paths.items()})

    def raw(self, name: str) -> DataFrame:
        if name not in self.raw_frames:
            self.raw_frames[name] = self.raw_builders[name]()
        return self.raw_frames[name]

    def clean(self, name: str) -> DataFrame:
        if name not in self.clean_frames:
            self.clean_frames[name] = clean_table(self.raw(name), name)
        return self.clean_frames[name]

    def placed(self, name: str, keys: list[str]) -> DataFrame:
        """The cleaned table, shuffled by ``keys`` if it is still to be cleaned."""
        return self.clean(name) if name in self.stored_clean else clean_placed(self.raw(name), name, keys)

    # shorthands for the two fact tables and two device tables
    @property
    def report(self) -> DataFrame:
        return self.clean("courier_report")

    @property
    def feedback(self) -> DataFrame:
        return self.clean("courier_feedback")

    @property
    def couriers(self) -> DataFrame:
        return self.clean("courier_device")

    @property
    def merchants(self) -> DataFrame:
        return self.clean("merchant_device")
