"""Group counts, HAVING, top-k, rank-within-group and favourites
(A-4 .. A-7, F-3 .. F-5, W-1 .. W-3, T-1 .. T-4).

Every operator that keeps a bounded number of rows per group is written as
a window rank with a filter, which Catalyst plans as a *partial*
``WindowGroupLimit`` before the shuffle and a final one after it: no task
ever holds a whole group, however hot. Global top-k plans as
``TakeOrderedAndProject`` (per-partition top-k, then a k-way merge).
Whenever a limit or ``row_number`` picks rows, ties are broken on the group
key so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(by, ascending: bool = False) -> list[Column]:
    by = [by] if isinstance(by, (str, Column)) else list(by)
    cols = [F.col(c) if isinstance(c, str) else c for c in by]
    return [c.asc() if ascending else c.desc() for c in cols]


def count_by(df: DataFrame, keys, name: str = "count") -> DataFrame:
    """COUNT(*) per key (A-4, A-5)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_k(df: DataFrame, by, k: int, tie_break=()) -> DataFrame:
    """Top ``k`` rows by ``by`` descending, ties broken by ``tie_break``
    ascending (T-3, T-4)."""
    return df.orderBy(*_order(by), *_order(tie_break, ascending=True)).limit(k)


def sort_desc(df: DataFrame, by, tie_break=()) -> DataFrame:
    """Full sort, descending (T-1): a range-partitioned distributed sort."""
    return df.orderBy(*_order(by), *_order(tie_break, ascending=True))


def rank_within(df: DataFrame, partition_by, order_by, k: int, method: str = "rank",
                tie_break=(), rank_col: str = "rank") -> DataFrame:
    """Keep rows ranked ≤ ``k`` inside each partition (W-1, W-2, F-4, F-5).

    ``method="rank"`` keeps every row tied at the cut; ``"row_number"``
    keeps exactly ``k`` rows per group, ties broken by ``tie_break``.
    """
    partition_by = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    order = _order(order_by) + _order(tie_break, ascending=True)
    w = Window.partitionBy(*partition_by).orderBy(*order)
    return df.withColumn(rank_col, fn().over(w)).where(F.col(rank_col) <= k)


def favourite(df: DataFrame, group: str, item: str, count_col: str = "count") -> DataFrame:
    """The most frequent ``item`` per ``group`` (W-3): count per pair, then
    ``row_number() = 1`` ordered by count descending and item ascending."""
    counts = count_by(df, [group, item], count_col)
    return (rank_within(counts, group, count_col, 1, method="row_number",
                        tie_break=[item], rank_col="_rn").drop("_rn"))
