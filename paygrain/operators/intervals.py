"""Date ranges: point-in-time joins, overlap joins, expansion to days, overlap resolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import month_start, open_end
from .sequences import latest_per_key
from .skew import PART, repeat_rows, split_rows


def point_in_time_join(
    fact: DataFrame,
    versions: DataFrame,
    on: str,
    at: Column,
    start: str = "valid_from",
    end: str = "valid_to",
    how: str = "inner",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Attach to each fact row the version of ``on`` in force on the date ``at``.

    Both ends are inclusive. The key is an equi-join key and the dates a residual
    condition, so the fact side is shuffled once at most. ``at`` may use columns of both
    sides; refer to the sides as ``f`` and ``v`` where a name occurs in both. The
    versions' own key is dropped. With ``hot`` (see ``skew.hot_keys``) the fact rows of
    a hot key are split into parts, and its versions repeated for each.
    """
    if how not in ("inner", "left"):
        raise ValueError("repeated versions would show in other joins than inner and left")
    wanted = fact.columns
    kept = [c for c in versions.columns if c != on and c not in wanted]
    if hot is not None:
        fact, versions = split_rows(fact, hot, on), repeat_rows(versions, hot, on)
    matches = (F.col(f"f.{on}") == F.col(f"v.{on}")) & at.between(F.col(f"v.{start}"), F.col(f"v.{end}"))
    if hot is not None:
        matches = matches & (F.col(f"f.{PART}") == F.col(f"v.{PART}"))
    return fact.alias("f").join(versions.alias("v"), matches, how).select(
        *[F.col(f"f.{c}") for c in wanted], *[F.col(f"v.{c}") for c in kept]
    )


def interval_overlap_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    by_month: tuple[str | date, str | date] | None = None,
) -> DataFrame:
    """Pairs with equal ``on`` whose closed date ranges overlap; a NULL end is open.

    Without ``by_month`` the dates are a residual condition on the equi-join, which is
    right while one side is small per key (a calendar). If both sides can be large, pass
    the first and last date that matter: both are cut into months, joined on key and
    month, and a pair is kept in the first month the two share, hence exactly once.
    """
    (ls, le), (rs, re) = left_range, right_range
    a, b = left.alias("l"), right.alias("r")
    a_end, b_end = F.coalesce(F.col(f"l.{le}"), open_end()), F.coalesce(F.col(f"r.{re}"), open_end())
    meets = (F.col(f"l.{ls}") <= b_end) & (a_end >= F.col(f"r.{rs}"))
    extra = [F.col(f"r.{c}") for c in right.columns if c != on]
    if by_month is None:
        return a.join(b, (F.col(f"l.{on}") == F.col(f"r.{on}")) & meets).select("l.*", *extra)

    first, last = (F.lit(d).cast("date") for d in by_month)

    def months(df: DataFrame, start: str, end: str) -> DataFrame:
        lo = month_start(F.greatest(F.col(start), first))
        hi = month_start(F.least(F.coalesce(F.col(end), open_end()), last))
        spans = df.withColumns({"_lo": lo, "_hi": hi}).where("_hi >= _lo")
        series = F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 month")))
        return spans.withColumn("_month", series)

    a = months(left, ls, le).alias("l")
    b = months(right, rs, re).alias("r")
    same = (F.col(f"l.{on}") == F.col(f"r.{on}")) & (F.col("l._month") == F.col("r._month"))
    once = F.col("l._month") == F.greatest(F.col("l._lo"), F.col("r._lo"))
    return a.join(b, same & once & meets).select(*[F.col(f"l.{c}") for c in left.columns], *extra)


def clip_interval(
    df: DataFrame, start: str, end: str, low: Column, high: Column, out: tuple[str, str]
) -> DataFrame:
    """Cut each range to [low, high] (NULL bounds are ignored) and drop what is left empty."""
    lo, hi = out
    return df.withColumns(
        {lo: F.greatest(F.col(start), low), hi: F.least(F.col(end), high)}
    ).where(F.col(lo) <= F.col(hi))


def explode_days(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """One row per day of the closed range; an inverted or NULL range gives none."""
    return df.where(F.col(end) >= F.col(start)).withColumn(out, F.explode(F.sequence(start, end)))


def resolve_by_priority(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    priority: Mapping[str, int] | Sequence[str],
    tie_breakers: Sequence[str],
) -> DataFrame:
    """Keep one row per key: the best-ranked ``column``, then the lowest tie-breakers.

    A value without a rank loses to every ranked one. The rows are spread by all keys:
    if they come from a join on the first key only, Spark would otherwise keep them
    where that join left them, with everything of a hot first key in one task.
    """
    if not isinstance(priority, Mapping):
        priority = {name: i for i, name in enumerate(priority, start=1)}
    rank = F.lit(None).cast("int")
    for name, place in priority.items():
        rank = F.when(F.col(column) == name, F.lit(place)).otherwise(rank)
    order = [rank.asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_breakers]]
    return latest_per_key(df.repartition(*keys), keys, order)


def elementary_ranges(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """``keys``, place, lo, hi: each entity's time cut at every start and end of its ranges, gaps included."""
    edges = df.where(F.col(end) >= F.col(start)).select(*keys, F.explode(F.array(F.col(start), F.date_add(end, 1))).alias("lo")).distinct()
    order = Window.partitionBy(*keys).orderBy("lo")
    return edges.withColumns({"place": F.row_number().over(order), "_next": F.lead("lo").over(order)}).select(
        *keys, "place", "lo", F.date_sub("_next", 1).alias("hi")
    )


def resolve_ranges(df: DataFrame, keys: Sequence[str], start: str, end: str, rank: Column, winner: Sequence[str]) -> DataFrame:
    """``keys``, ``winner``, lo, hi: who counts when, one row per stretch in which the same range wins.

    Of the ranges over a stretch the lowest ``rank`` wins, then the lowest ``winner`` columns. Ranges are cut at one
    another's edges and compared there, never day by day: the work grows with the number of overlaps, not of days. Both
    edges of a range are found by equi-joins; the best of a stretch is taken before and after the shuffle.
    """
    cuts = elementary_ranges(df, keys, start, end)
    best = F.struct(rank.alias("rank"), *winner)
    own = df.where(F.col(end) >= F.col(start)).select(*keys, F.col(start).alias("lo"), F.date_add(end, 1).alias("_stop"), best.alias("_best"))
    begun = own.join(cuts.select(*keys, "lo", F.col("place").alias("_from")), [*keys, "lo"])
    ended = begun.join(cuts.select(*keys, F.col("lo").alias("_stop"), F.col("place").alias("_to")), [*keys, "_stop"])
    covered = ended.select(*keys, F.explode(F.sequence("_from", F.col("_to") - 1)).alias("place"), "_best")
    chosen = covered.groupBy(*keys, "place").agg(F.min("_best").alias("_best")).join(cuts, [*keys, "place"])
    # Neighbouring stretches of one winner are one.
    order = Window.partitionBy(*keys).orderBy("lo")
    follows = F.lag("_best").over(order).eqNullSafe(F.col("_best")) & (F.lag("hi").over(order) == F.date_sub("lo", 1))
    marked = chosen.withColumn("_opens", F.when(follows, 0).otherwise(1))
    numbered = marked.withColumn("_run", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy(*keys, "_run").agg(F.first("_best").alias("_best"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return runs.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in winner], "lo", "hi")


def overlap_figures(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """n_pairs (pairs of overlapping ranges of one entity), n_days (of all ranges), excess_days (counted more than once).

    A sweep over starts and ends: a range that opens overlaps all that are open, so no pair is ever made.
    """
    ranges = df.where(F.col(end) >= F.col(start))
    steps = ranges.select(
        *keys,
        F.explode(F.array(F.struct(F.col(start).alias("day"), F.lit(1).alias("step")), F.struct(F.date_add(end, 1).alias("day"), F.lit(-1).alias("step")))).alias("e"),
    ).select(*keys, "e.day", "e.step")
    order = Window.partitionBy(*keys).orderBy("day", "step")  # what ends before a day is gone when another starts on it
    swept = steps.withColumns(
        {
            "before": F.coalesce(F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "until": F.lead("day").over(order),
        }
    ).withColumn("open", F.col("before") + F.col("step"))
    width = F.when(F.col("open") > 0, F.datediff("until", "day")).otherwise(0)
    return swept.agg(
        F.coalesce(F.sum(F.when(F.col("step") == 1, F.col("before"))), F.lit(0)).alias("n_pairs"),
        F.coalesce(F.sum(width * F.col("open")), F.lit(0)).alias("n_days"),
        F.coalesce(F.sum(width * (F.col("open") - 1)), F.lit(0)).alias("excess_days"),
    )
