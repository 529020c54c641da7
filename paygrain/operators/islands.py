"""Runs of equal values that are kept, not rebuilt: what a batch changes, and only that.

An island is a maximal run of one entity's rows, in their order, with one value. The stored islands carry everything
a later row needs: value and last moment of each entity's last island. Rows behind that moment extend the last island
or open the next. A row that comes late may split an island or join two, so its entity, and no other, is made again
from its history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Columns of islands beside the entity.
COLUMNS = ("version", "value", "first_at", "last_at", "n")


def islands(rows: DataFrame, entity: str, at: str, value: str) -> DataFrame:
    """entity, version (from 1), value, first_at, last_at, n. A null value equals a null. One row per entity and moment."""
    order = Window.partitionBy(entity).orderBy(at)
    opens = F.lag(F.lit(True)).over(order).isNull() | ~F.col(value).eqNullSafe(F.lag(value).over(order))
    marked = rows.select(entity, F.col(at).alias("_at"), F.col(value).alias("value"), opens.cast("long").alias("_opens"))
    running = Window.partitionBy(entity).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.withColumn("version", F.sum("_opens").over(running))
    found = numbered.groupBy(entity, "version").agg(
        F.first("value").alias("value"), F.min("_at").alias("first_at"), F.max("_at").alias("last_at"), F.count(F.lit(1)).alias("n")
    )
    return found.select(entity, *COLUMNS)


def last_islands(stored: DataFrame, entity: str) -> DataFrame:
    """The state a batch needs: each entity's last island."""
    last = stored.groupBy(entity).agg(F.max(F.struct("version", *[c for c in COLUMNS if c != "version"])).alias("last"))
    return last.select(entity, *[F.col(f"last.{c}").alias(c) for c in COLUMNS])


def late_entities(stored: DataFrame, batch: DataFrame, entity: str, at: str) -> DataFrame:
    """Entities with a row of the batch at or before their last stored moment."""
    first = batch.groupBy(entity).agg(F.min(at).alias("_first"))
    return first.join(last_islands(stored, entity), entity).where("_first <= last_at").select(entity)


def _extended(last: DataFrame, fresh: DataFrame, entity: str) -> DataFrame:
    """Islands of rows that all lie behind what is stored, numbered on; the first may be the stored last one, longer."""
    own = last.select(entity, *[F.col(c).alias(f"_{c}") for c in COLUMNS])
    joined = fresh.join(own, entity, "left")
    joins = (F.col("version") == 1) & F.col("_version").isNotNull() & F.col("value").eqNullSafe(F.col("_value"))
    same = F.max(joins.cast("int")).over(Window.partitionBy(entity))
    return joined.select(
        entity,
        (F.col("version") + F.coalesce("_version", F.lit(0)) - same).alias("version"),
        "value",
        F.when(joins, F.col("_first_at")).otherwise(F.col("first_at")).alias("first_at"),
        "last_at",
        F.when(joins, F.col("n") + F.col("_n")).otherwise(F.col("n")).alias("n"),
    )


def changed_islands(stored: DataFrame, batch: DataFrame, history: DataFrame, entity: str, at: str, value: str) -> tuple[DataFrame, DataFrame]:
    """What a batch of rows makes of stored islands: the islands to write, and the (entity, version) they replace.

    ``history`` has all rows, the batch's included; it is read only for entities with late rows, by a semi-join. Every
    row of the batch is new, or replaces the row of its moment in the history.
    """
    late = late_entities(stored, batch, entity, at)
    inorder = batch.join(late, entity, "left_anti")
    touched = last_islands(stored, entity).join(inorder.select(entity).distinct(), entity, "left_semi")
    extended = _extended(touched, islands(inorder, entity, at, value), entity)
    again = islands(history.join(late, entity, "left_semi"), entity, at, value)
    replaced = stored.join(late, entity, "left_semi").select(entity, "version")
    return extended.unionByName(again), replaced.unionByName(touched.join(extended, [entity, "version"], "left_semi").select(entity, "version"))


def refresh(stored: DataFrame, batch: DataFrame, history: DataFrame, entity: str, at: str, value: str) -> DataFrame:
    """The stored islands after a batch; equal to ``islands(history)``."""
    fresh, replaced = changed_islands(stored, batch, history, entity, at, value)
    return stored.join(replaced, [entity, "version"], "left_anti").select(entity, *COLUMNS).unionByName(fresh)
