"""Weighted and positional assignment of rows to choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .sequences import with_position


def cumulative_ranges(weights: DataFrame, order: str, weight: str) -> DataFrame:
    """Consecutive half-open ranges [range_from, range_to) whose lengths are the weights.

    ``weights`` is a configuration table (one row per choice), so one task can order it.
    """
    upto = Window.partitionBy().orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum(weight).over(upto)
    return weights.withColumns({"range_from": total - F.col(weight), "range_to": total})


def weighted_bucket(
    rows: DataFrame, draw: str, weights: DataFrame, choice: str, weight: str, slots: int
) -> DataFrame:
    """Give each row the choice whose range holds its draw (a whole number 0..slots-1).

    Weights may be fractions of a slot (decimals; sums of doubles would blur the bounds). A range holds the whole
    numbers from its start up to, but not including, its end, so neighbours share no slot and a range between two
    whole numbers holds none. The ranges are cut into these slots, at most ``slots`` rows, and the lookup is an
    equi-join on the draw rather than a comparison with every range. A draw beyond the last range finds no choice
    and is dropped, as in the range join. A negative weight would make ranges overlap and raises.
    """
    exact = F.col(weight).cast("decimal(28,10)")
    checked = F.when(exact < 0, F.raise_error(F.lit("a weight is negative")).cast("decimal(28,10)")).otherwise(exact)
    table = cumulative_ranges(weights.select(choice, checked.alias(weight)), choice, weight)
    first, behind = F.ceil("range_from").cast("long"), F.least(F.ceil("range_to").cast("long"), F.lit(slots))
    lookup = table.where(first < behind).select(choice, F.explode(F.sequence(first, behind - 1)).alias(draw))
    return rows.join(lookup, draw)


def nth_element(
    rows: DataFrame,
    pool: DataFrame,
    group: str,
    order: str,
    draw: str,
    slots: int,
    take: Sequence[str],
    chunk: Column | None = None,
) -> DataFrame:
    """Give each row the pool member number ``1 + draw * size div slots`` of its group.

    ``draw`` is a whole number 0..slots-1, so the position is exact. With ``chunk`` the numbering of a large group is spread over chunks of its order.
    The sizes are partial counts, one row per group; the lookup is by (group, number).
    """
    numbered = with_position(pool.select(group, order, *[c for c in take if c != order]), group, order, "_n", chunk)
    sizes = pool.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    drawn = rows.join(sizes, group).withColumn("_n", F.expr(f"1 + (`{draw}` * _size) div {slots}"))
    return drawn.join(numbered.select(group, "_n", *take), [group, "_n"]).drop("_n", "_size")
