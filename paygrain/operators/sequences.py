"""Ordered operators: latest version, previous/next row, running totals, change islands.

A plain window puts all rows of one entity into one task. That is right where a calendar
bounds the rows per entity (one per pay period, say). Where it does not, pass ``chunk``:
an expression that never decreases along the order, such as the month of the ordering
date. The window then runs per (entity, chunk), and what has to cross a chunk border is
carried by a summary of one row per (entity, chunk). The result is the same, and a hot
entity is spread over its chunks. Entity and chunk must not be NULL then.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import open_end

_CHUNK = "_chunk"


def _names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``order``, which must be a total order.

    Spark limits each map partition to one row per key before the shuffle, so a key
    with very many versions sends one row per input partition, not all of them.
    """
    ranked = Window.partitionBy(*_names(keys)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def _neighbour(df, entity, order, columns, chunk, forward):
    entity, order = _names(entity), _names(order)
    step = F.lead if forward else F.lag
    if chunk is None:
        window = Window.partitionBy(*entity).orderBy(*order)
        return df.withColumns({out: step(src).over(window) for out, src in columns.items()})

    chunked = df.withColumn(_CHUNK, chunk)
    window = Window.partitionBy(*entity, _CHUNK).orderBy(*order)
    back = F.lag if forward else F.lead
    local = chunked.withColumns(
        {"_edge": step(F.lit(True)).over(window).isNull(), "_facing": back(F.lit(True)).over(window).isNull()}
        | {f"_near_{i}": step(src).over(window) for i, src in enumerate(columns.values())}
    )
    # One row per chunk: the one that faces the neighbouring chunk.
    values = F.struct(*[F.col(src).alias(f"_v{i}") for i, src in enumerate(columns.values())])
    across = Window.partitionBy(*entity).orderBy(_CHUNK)
    carried = local.where("_facing").select(*entity, _CHUNK, step(values).over(across).alias("_carried"))
    joined = local.join(carried, [*entity, _CHUNK], "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[
            F.when(F.col("_edge"), F.col(f"_carried._v{i}")).otherwise(F.col(f"_near_{i}")).alias(out)
            for i, out in enumerate(columns)
        ],
    )


def with_previous(
    df: DataFrame,
    entity: str | Sequence[str],
    order: str | Sequence[str],
    columns: Mapping[str, str],
    chunk: Column | None = None,
) -> DataFrame:
    """Add ``{new: source}`` columns holding the previous row's values of each entity."""
    return _neighbour(df, entity, order, columns, chunk, forward=False)


def with_next(
    df: DataFrame,
    entity: str | Sequence[str],
    order: str | Sequence[str],
    columns: Mapping[str, str],
    chunk: Column | None = None,
) -> DataFrame:
    """Add ``{new: source}`` columns holding the next row's values of each entity."""
    return _neighbour(df, entity, order, columns, chunk, forward=True)


def with_running_sum(
    df: DataFrame,
    entity: str | Sequence[str],
    order: str | Sequence[str],
    value: str | Column,
    out: str,
    chunk: Column | None = None,
) -> DataFrame:
    """Add the running total of ``value`` within each entity, current row included.

    ``value`` must not be NULL: a NULL would make the total of its whole chunk NULL.
    """
    entity, order = _names(entity), _names(order)
    value = F.col(value) if isinstance(value, str) else value
    rows = (Window.unboundedPreceding, Window.currentRow)
    if chunk is None:
        window = Window.partitionBy(*entity).orderBy(*order).rowsBetween(*rows)
        return df.withColumn(out, F.sum(value).over(window))

    chunked = df.withColumns({_CHUNK: chunk, "_value": value})
    window = Window.partitionBy(*entity, _CHUNK).orderBy(*order).rowsBetween(*rows)
    local = chunked.withColumn("_local", F.sum("_value").over(window))
    before = Window.partitionBy(*entity).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(*entity, _CHUNK)
        .agg(F.sum("_value").alias("_total"))
        .withColumn("_offset", F.sum("_total").over(before))
        .drop("_total")
    )
    joined = local.join(offsets, [*entity, _CHUNK], "left")
    total = F.when(F.col("_offset").isNull(), F.col("_local")).otherwise(F.col("_local") + F.col("_offset"))
    return joined.select(*[F.col(c) for c in df.columns], total.alias(out))


def with_position(
    df: DataFrame,
    entity: str | Sequence[str],
    order: str | Sequence[str],
    out: str,
    chunk: Column | None = None,
) -> DataFrame:
    """Number the rows of each entity from 1 along ``order``."""
    if chunk is None:
        window = Window.partitionBy(*_names(entity)).orderBy(*_names(order))
        return df.withColumn(out, F.row_number().over(window).cast("long"))
    return with_running_sum(df, entity, order, F.lit(1).cast("long"), out, chunk)


def change_marks(
    df: DataFrame,
    entity: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    out: str = "is_change",
    chunk: Column | None = None,
) -> DataFrame:
    """1 where ``value`` differs from the entity's previous row (the first row counts), else 0."""
    marked = with_previous(df, entity, order, {"_before": value}, chunk)
    mark = F.when(F.col(value) == F.col("_before"), 0).otherwise(1).cast("int")
    return marked.withColumn(out, mark).drop("_before")


def islands(
    df: DataFrame,
    entity: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    out: str = "version",
    chunk: Column | None = None,
) -> DataFrame:
    """Number the runs of equal ``value``; a return to an old value opens a new run."""
    entity, order = _names(entity), _names(order)
    if chunk is None:
        marked = change_marks(df, entity, order, value, "_mark")
        numbered = with_running_sum(marked, entity, order, "_mark", out)
        return numbered.withColumn(out, F.col(out).cast("int")).drop("_mark")

    # Within a chunk, changes are counted from its first row on. What a chunk needs from
    # the ones before it is their number of changes, and their last value to tell whether
    # its own first row is one: one row per chunk, from one pass over the rows.
    window = Window.partitionBy(*entity, _CHUNK).orderBy(*order)
    before = F.lag(value).over(window)
    marked = df.withColumn(_CHUNK, chunk).withColumns(
        {
            "_head": F.lag(F.lit(True)).over(window).isNull(),
            "_tail": F.lead(F.lit(True)).over(window).isNull(),
            "_mark": F.when(F.col(value) == before, 0).otherwise(1),
        }
    )
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = marked.withColumn("_inner", F.sum(F.when(F.col("_head"), 0).otherwise(F.col("_mark"))).over(upto))
    chunks = (
        local.where("_head or _tail")
        .groupBy(*entity, _CHUNK)
        .agg(
            F.max("_inner").alias("_changes"),
            F.max(F.when(F.col("_head"), F.col(value))).alias("_first"),
            F.max(F.when(F.col("_tail"), F.col(value))).alias("_last"),
        )
    )
    across = Window.partitionBy(*entity).orderBy(_CHUNK)
    opens = F.when(F.col("_first") == F.lag("_last").over(across), 0).otherwise(1)
    total = F.sum(F.col("_changes") + F.col("_opens")).over(
        across.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    starts = chunks.withColumn("_opens", opens).select(*entity, _CHUNK, (total - F.col("_changes")).alias("_start"))
    return local.join(starts, [*entity, _CHUNK], "left").select(
        *[F.col(c) for c in df.columns], (F.col("_start") + F.col("_inner")).cast("int").alias(out)
    )


def validity(
    df: DataFrame,
    entity: str | Sequence[str],
    start: str,
    end_out: str = "valid_to",
    current_out: str = "is_current",
    chunk: Column | None = None,
) -> DataFrame:
    """Close each version the day before the next one starts; the last stays open."""
    following = with_next(df, entity, start, {"_next": start}, chunk)
    return following.withColumns(
        {
            end_out: F.coalesce(F.date_sub("_next", 1), open_end()),
            current_out: F.col("_next").isNull(),
        }
    ).drop("_next")


def left_censored(df: DataFrame, entity: str, start: str, known_since: str, out: str) -> DataFrame:
    """True where an entity's first known version starts after the entity itself did.

    Meant for versions, of which a calendar bounds the number per entity.
    """
    first = F.min(start).over(Window.partitionBy(entity))
    return df.withColumn(out, first > F.col(known_since))
