"""Shared plan helpers: size-checked broadcast, rounding, ranking windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows a side may have and still be broadcast. Above it the join shuffles
# (and AQE may still pick a broadcast at run time from real sizes).
BROADCAST_MAX_ROWS = 2_000_000
SCORE_DIGITS = 6


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only after counting it; beyond the bound, leave it to
    a shuffle join. The count is one cheap job over the small side."""
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def rounded(col: Column) -> Column:
    """Scores are compared after rounding so that summation order across
    partitions (or engines) does not reorder ties."""
    return F.round(col, SCORE_DIGITS)


def rank_window(partition: str | list[str], *order: Column) -> Window:
    parts = [partition] if isinstance(partition, str) else partition
    return Window.partitionBy(*parts).orderBy(*order)


def top_n(df: DataFrame, partition, order: list[Column], n: int,
          rank_col: str = "rank") -> DataFrame:
    """row_number() <= n per group. Spark plans this as WindowGroupLimit, so
    every map partition keeps only its own n best rows per group before the
    shuffle; a group holding a third of all rows costs n rows per partition."""
    w = rank_window(partition, *order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
