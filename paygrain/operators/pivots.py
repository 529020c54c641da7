"""Pivots by conditional aggregation: one pass, partial sums before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_pivot(
    df: DataFrame, keys: Sequence[str], outputs: Mapping[str, tuple[Column | None, Column]], as_type: str = "decimal(18,2)"
) -> DataFrame:
    """Sum each output's value where its predicate holds; a key without such rows gets zero."""

    def term(predicate: Column | None, value: Column) -> Column:
        return value if predicate is None else F.when(predicate, value).otherwise(F.lit(0))

    return df.groupBy(*keys).agg(*[F.sum(term(p, v)).cast(as_type).alias(out) for out, (p, v) in outputs.items()])
