"""Differences of two version histories, as date ranges: which facts still carry a version that no longer holds.

Late history renumbers versions. Facts tied to the old numbers are not late themselves, so no lookback finds them.
Both histories are cut at one another's edges; where a stretch has another version key than before, its facts are stale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _edges(df: DataFrame, entity: str, start: str, end: str, version: str, side: str) -> DataFrame:
    """One row where a version starts and one behind its end, the latter with no version."""
    begins = df.select(entity, F.col(start).alias("lo"), F.struct(F.lit(1).alias("open"), F.col(version).alias("v")).alias(side))
    # The day after the open end does not exist: an open version just goes on.
    over = df.where(F.col(end) < F.lit("9999-12-31").cast("date"))
    ends = over.select(entity, F.date_add(end, 1).alias("lo"), F.struct(F.lit(0).alias("open"), F.lit(None).cast(df.schema[version].dataType).alias("v")).alias(side))
    both = begins.unionByName(ends)
    # Where one version ends and the next starts on one day, the start counts.
    return both.groupBy(entity, "lo").agg(F.max(side).alias(side))


def changed_ranges(before: DataFrame, after: DataFrame, entity: str, start: str, end: str, version: str) -> DataFrame:
    """``entity``, lo, hi: the closed ranges in which another version is in force than before, none included.

    Versions of an entity do not overlap. One sort per entity over both histories, whose sizes a calendar bounds;
    neighbouring changed ranges are given as one. Entities and starts of NULL are left out.
    """
    clean = [df.where(F.col(entity).isNotNull() & F.col(start).isNotNull()) for df in (before, after)]
    old, new = (_edges(df, entity, start, end, version, side) for df, side in zip(clean, ("_old", "_new"), strict=True))
    points = old.unionByName(new, allowMissingColumns=True).groupBy(entity, "lo").agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    order = Window.partitionBy(entity).orderBy("lo")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    held = points.select(
        entity, "lo", F.lead("lo").over(order).alias("_next"),
        *[F.last(side, ignorenulls=True).over(upto)["v"].alias(side) for side in ("_old", "_new")],
    )
    differs = held.withColumn("_differs", ~F.col("_old").eqNullSafe(F.col("_new")))
    opens = F.when(F.col("_differs") & F.coalesce(F.lag("_differs").over(order), F.lit(False)), 0).otherwise(1)
    runs = differs.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(upto)).where("_differs")
    until = F.coalesce(F.date_sub("_next", 1), F.lit("9999-12-31").cast("date"))
    return runs.groupBy(entity, "_run").agg(F.min("lo").alias("lo"), F.max(until).alias("hi")).select(entity, "lo", "hi")


def stale_facts(fact: DataFrame, changed: DataFrame, entity: str, at: str) -> DataFrame:
    """The facts that lie in changed ranges; few entities change, so their list decides how the facts are met."""
    c = changed.select(F.col(entity).alias("_entity"), "lo", "hi")
    return fact.join(c, (F.col(entity) == F.col("_entity")) & F.col(at).between(F.col("lo"), F.col("hi")), "left_semi")
