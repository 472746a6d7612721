"""Inline dimensions (S-5) and their lookup joins (J-1 .. J-3).

An inline dimension is a literal mapping, so its row count is known when the
plan is built. That bound is what makes the explicit broadcast safe: the hash
table shipped to every executor holds at most ``MAX_INLINE_ROWS`` rows, no
matter how large the fact side grows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_INLINE_ROWS = 10_000   # larger mappings are joined without a broadcast hint

# Fixed values. These must equal the source data's own labels.
# Notification feedback code → label: 0 "try later", 1 "confirm".
FEEDBACK_LABELS = {0: "稍后尝试", 1: "确认"}
# City id → city name.
CITY_NAMES = {1: "上海", 2: "杭州", 3: "深圳", 4: "北京", 5: "潍坊",
              6: "广州", 7: "遂宁", 8: "西宁", 9: "定安", 10: "廊坊"}

TRY_LATER = FEEDBACK_LABELS[0]
CONFIRM = FEEDBACK_LABELS[1]


@dataclass(frozen=True)
class InlineDim:
    key: str
    value: str
    mapping: dict

    def frame(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([T.StructField(self.key, T.LongType(), False),
                               T.StructField(self.value, T.StringType(), False)])
        return spark.createDataFrame([(int(k), v) for k, v in self.mapping.items()], schema)

    def join(self, df: DataFrame, key: str | None = None, how: str = "inner") -> DataFrame:
        """Join ``df`` to this dimension on its key column (USING semantics).

        The fact key is converted with ``try_cast``: a non-numeric key such as
        ``"error"`` becomes NULL and falls out of an inner join instead of
        failing the job under ANSI mode.
        """
        key = key or self.key
        fact = df.withColumn(key, F.col(key).try_cast("long"))
        dim = self.frame(df.sparkSession)
        if key != self.key:
            dim = dim.withColumnRenamed(self.key, key)
        return fact.join(F.broadcast(dim) if len(self.mapping) <= MAX_INLINE_ROWS else dim, on=[key], how=how)


FEEDBACK_DIM = InlineDim("feedback", "feedback_tran", FEEDBACK_LABELS)
CITY_DIM = InlineDim("city_id", "city_name", CITY_NAMES)
