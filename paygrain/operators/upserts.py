"""Write semantics as DataFrame expressions: the result is the table's new content."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import moment
from .sequences import latest_per_key


def lookback_start(target: DataFrame, updated_at: str, days: int = 3) -> datetime | None:
    """Lower bound of an incremental batch: the target's newest change less ``days``.

    One scalar reaches the driver, so the bound can be pushed into the source scan.
    None for an empty target, which means "take everything".
    """
    newest = target.agg(F.max(updated_at)).first()[0]
    return None if newest is None else newest - timedelta(days=days)


def lookback(source: DataFrame, target: DataFrame, updated_at: str, days: int = 3) -> DataFrame:
    """The source rows an incremental run has to process again."""
    start = lookback_start(target, updated_at, days)
    return source if start is None else source.where(F.col(updated_at) >= moment(start))


def delete_insert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` replace those with the same key; other rows stay."""
    return target.join(batch.select(key), key, "left_anti").unionByName(batch)


def insert_missing(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()
) -> DataFrame:
    """Add the batch rows whose natural key the target lacks; nothing is changed or removed."""
    known = target.select(*keys, *null_safe).alias("t")
    b = batch.alias("b")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"b.{k}") == F.col(f"t.{k}"))
    for k in null_safe:
        same = same & F.col(f"b.{k}").eqNullSafe(F.col(f"t.{k}"))
    return target.unionByName(b.join(known, same, "left_anti"), allowMissingColumns=True)


def update_from(
    target: DataFrame, source: DataFrame, key: str, assign: Mapping[str, Column]
) -> DataFrame:
    """Overwrite columns of the target rows that match ``source`` (unique on ``key``).

    Expressions in ``assign`` refer to the sides as ``t`` and ``s``.
    """
    marked = source.withColumn("_hit", F.lit(True))
    joined = target.alias("t").join(marked.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "left")
    return joined.select(
        *[
            (F.when(F.col("s._hit"), assign[c]).otherwise(F.col(f"t.{c}")) if c in assign else F.col(f"t.{c}")).alias(c)
            for c in target.columns
        ]
    )


def delete_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Drop child rows whose parent is gone."""
    return child.join(parent.select(key), key, "left_semi")


def update_where(df: DataFrame, predicate: Column, assign: Mapping[str, Column]) -> DataFrame:
    """Set columns where the predicate is true; false and NULL leave the row alone."""
    return df.withColumns({c: F.when(predicate, v).otherwise(F.col(c)) for c, v in assign.items()})


def update_top_n(
    df: DataFrame,
    key: str,
    predicate: Column,
    order: Sequence[Column],
    n: int,
    assign: Mapping[str, Column],
) -> DataFrame:
    """Set columns on the first ``n`` rows (by ``order``) that satisfy the predicate."""
    chosen = df.where(predicate).orderBy(*order).limit(n).select(key).withColumn("_chosen", F.lit(True))
    return (
        df.join(chosen, key, "left")
        .transform(lambda d: update_where(d, F.col("_chosen"), assign))
        .select(*df.columns)
    )


def newest_wins(target: DataFrame, batch: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Merge replayed or late rows: per key the newest row of target and batch."""
    return latest_per_key(target.unionByName(batch), key, order)
