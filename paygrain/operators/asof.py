"""Point-in-time join as a merge: facts and versions in one order, the last version carried forward.

An equi-join with the dates as a residual condition compares every fact of a key with every version of it. Here both
sides are put into one relation, sorted by key and date, and each fact takes the last version seen before it: one
shuffle, one sort, one comparison a row, however many versions a key has. Keys with more rows than a task should take
are cut along their order into ranges of about equal counts; a range gets one row more, the version it opens with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .skew import ROWS_PER_TASK, hot_keys

CHUNK = "_range"
#: The most ranges that one key is cut into; beyond it they get longer.
MAX_RANGES = 1000
_AT, _KIND, _ROW, _VERSION = "_at", "_kind", "_fact", "_found"
_CARRIED, _STARTS, _ASKS = 0, 1, 2


def range_edges(df: DataFrame, key: str, at: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``key``, _edges: ascending values of ``at`` that cut the rows of each hot key into ranges of about equal counts.

    Only keys with more than ``rows_per_task`` rows are listed, at most one in that many rows. The second pass reads
    their rows only and keeps a sketch of bounded size for each. Rows with one ``at`` stay together.
    """
    hot = hot_keys(df, key, rows_per_task=rows_per_task)
    rows = df.select(key, at).join(F.broadcast(hot) if hot.few else hot, key)
    # One sketch a key gives all ranks; a key takes those that its number of parts asks for.
    ranks = [i / MAX_RANGES for i in range(1, MAX_RANGES)]
    grid = rows.groupBy(key).agg(F.percentile_approx(at, ranks, 10 * MAX_RANGES).alias("_grid"), F.max("_parts").alias("_parts"))
    parts = F.least("_parts", F.lit(MAX_RANGES))
    place = lambda i: F.floor(i * MAX_RANGES / parts).cast("int")
    picked = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.element_at("_grid", place(i)))
    return grid.select(key, F.array_sort(F.array_distinct(picked)).alias("_edges"))


def range_number(edges: Column, at: Column) -> Column:
    """How many edges lie at or before ``at``; 0 where there are no edges."""
    return F.coalesce(F.size(F.filter(edges, lambda e: e <= at)), F.lit(0))


def asof_join(
    fact: DataFrame,
    versions: DataFrame,
    on: str,
    at: str,
    start: str = "valid_from",
    end: str = "valid_to",
    how: str = "inner",
    edges: DataFrame | None = None,
) -> DataFrame:
    """Each fact row with the version of ``on`` in force at ``at``; equal to ``intervals.point_in_time_join``.

    Both ends are inclusive, an end of NULL is open, and the versions of a key must not overlap. ``at`` is a column of
    the facts and of the type of ``start``. Facts whose key or ``at`` is NULL match nothing: ``inner`` drops them,
    ``left`` keeps them. Repeated facts stay repeated. Names that occur on both sides are the facts'. ``edges`` (see
    ``range_edges``) cuts hot keys.
    """
    if how not in ("inner", "left"):
        raise ValueError("the join is inner or left")
    names = fact.columns
    extra = [c for c in versions.columns if c != on and c not in names]
    whole = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(names)])
    kept = F.struct(F.col(end).alias("until"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(extra)])
    asked = F.col(on).isNotNull() & F.col(at).isNotNull()

    asks = fact.where(asked).select(F.col(on).alias("_key"), F.col(at).alias(_AT), F.lit(_ASKS).alias(_KIND), whole.alias(_ROW))
    starts = versions.where(F.col(on).isNotNull() & F.col(start).isNotNull()).select(
        F.col(on).alias("_key"), F.col(start).alias(_AT), F.lit(_STARTS).alias(_KIND), kept.alias(_VERSION)
    )
    if edges is not None:
        cut = edges.select(F.col(on).alias("_key"), "_edges")
        asks, starts = (
            df.join(cut, "_key", "left").withColumn(CHUNK, range_number(F.col("_edges"), F.col(_AT))).drop("_edges") for df in (asks, starts)
        )
        starts = starts.unionByName(_opening(starts, cut), allowMissingColumns=True)
    else:
        asks, starts = asks.withColumn(CHUNK, F.lit(0)), starts.withColumn(CHUNK, F.lit(0))

    order = Window.partitionBy("_key", CHUNK).orderBy(F.when(F.col(_KIND) == _CARRIED, 0).otherwise(1), _AT, _KIND)
    carried = F.last(_VERSION, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    every = asks.unionByName(starts, allowMissingColumns=True)
    met = every.withColumn(_VERSION, carried).where(F.col(_KIND) == _ASKS)
    holds = F.col(_VERSION).isNotNull() & (F.col(f"{_VERSION}.until").isNull() | (F.col(_AT) <= F.col(f"{_VERSION}.until")))
    if how == "inner":
        met = met.where(holds)
    found = [F.when(holds, F.col(f"{_VERSION}.v{i}")).alias(c) for i, c in enumerate(extra)]
    out = met.select(*[F.col(f"{_ROW}.f{i}").alias(c) for i, c in enumerate(names)], *found)
    if how == "left":
        none = [F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in extra]
        out = out.unionByName(fact.where(~asked).select(*names, *none))
    return out


def _opening(starts: DataFrame, cut: DataFrame) -> DataFrame:
    """The version that each range of a hot key opens with: the last one that starts in a range before it."""
    own = starts.join(cut, "_key", "left_semi").groupBy("_key", CHUNK).agg(F.max_by(_VERSION, _AT).alias(_VERSION))
    ranges = cut.select("_key", F.explode(F.sequence(F.lit(0), F.size("_edges"))).alias(CHUNK))
    before = Window.partitionBy("_key").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(_VERSION, ignorenulls=True).over(before)
    opened = ranges.join(own, ["_key", CHUNK], "left").withColumn(_VERSION, last)
    return opened.where(F.col(_VERSION).isNotNull()).withColumn(_KIND, F.lit(_CARRIED))
