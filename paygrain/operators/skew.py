"""Splitting hot keys of a join, decided from counts.

Runtime re-planning splits an oversized join partition only where nothing after the join
relies on its partitioning. These helpers do not depend on that: they name the hot keys,
give each of their rows one of several parts, and repeat the other side once per part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 5_000_000
#: Below this bound on a task's rows the list of hot keys may be long.
FEWEST_ROWS = 1_000_000
PART = "_part"


def hot_keys(df: DataFrame, key: str, weight: str | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more rows than one task should take, and how many parts to cut them into.

    One pass over the key column with partial counts. At most one key in
    ``rows_per_task`` rows can qualify: a few thousand for billions of rows, 200,000 for
    a trillion. That bound is what makes the result fit to be broadcast. With ``weight``
    the rows are already counted per group, and the counts are in that column.
    """
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(size.alias("_rows"))
    parts = F.ceil(F.col("_rows") / F.lit(rows_per_task)).cast("int")
    hot = counts.where(F.col("_rows") > rows_per_task).select(key, parts.alias("_parts"))
    hot.few = rows_per_task >= FEWEST_ROWS
    return hot


def _sent(hot: DataFrame) -> DataFrame:
    """The list for a join: broadcast if it is known to be short, else as its measured size has it."""
    return F.broadcast(hot) if getattr(hot, "few", False) else hot


def split_rows(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Add the part of each row: fixed by the row's content for hot keys, 0 for the others."""
    marked = df.join(_sent(hot), key, "left")
    part = F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*df.columns), F.col("_parts")))
    return marked.select(*df.columns, part.cast("int").alias(PART))


def repeat_rows(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Repeat the rows of a hot key once per part."""
    marked = df.join(_sent(hot), key, "left")
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    return marked.select(*df.columns, F.explode(parts).alias(PART))
