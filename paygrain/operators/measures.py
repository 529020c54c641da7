"""Report measures over the star schema, with the currency guard.

Amounts of different countries are in different currencies. A guarded measure therefore
has a value only where the *filter context* leaves exactly one country: the context is
what slicers and group keys of the country dimension leave visible, whatever countries
the fact rows happen to have. Elsewhere it is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GUARD = "country_code"


def one_country(countries: DataFrame, by: Sequence[str]) -> Column:
    """The guard for a report grouped by ``by``, ``countries`` being the sliced dimension."""
    if GUARD in by:
        return F.lit(True)
    return countries.agg(F.count_distinct(GUARD)).scalar() == 1


def guarded(value: Column, guard: Column) -> Column:
    return F.when(guard, value)


def gross() -> Column:
    return F.sum("amount").cast("decimal(18,2)")


def net(guard: Column) -> Column:
    return guarded(F.sum("signed_amount").cast("decimal(18,2)"), guard)


def earnings(guard: Column) -> Column:
    return guarded(F.sum(F.when(F.col("concept_type") == "EARNING", F.col("amount"))).cast("decimal(18,2)"), guard)


def deductions(guard: Column) -> Column:
    return guarded(F.sum(F.when(F.col("concept_type") == "DEDUCTION", F.col("amount"))).cast("decimal(18,2)"), guard)


def distinct_employments() -> Column:
    return F.count_distinct("employment_id")


def rows() -> Column:
    return F.count(F.lit(1))


def paid_indemnity(guard: Column) -> Column:
    return guarded(F.sum(F.when(F.col("status") == "PAID", F.col("indemnity_amount"))).cast("decimal(18,2)"), guard)


def business_days() -> Column:
    """Days that are not on a weekend; needs is_weekend of the date dimension.

    Blank, not zero, where there are none: that is what a count over no rows shows.
    """
    n = F.count(F.when(~F.col("is_weekend"), F.lit(1)))
    return F.when(n > 0, n)


def measure(df: DataFrame, by: Sequence[str], **columns: Column) -> DataFrame:
    """Aggregate the measures by the group keys, or over all rows when there are none."""
    exprs = [c.alias(name) for name, c in columns.items()]
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


def star(fact: DataFrame, *dims: tuple[DataFrame, str, str]) -> DataFrame:
    """Join a fact many-to-one to dimensions given as (dimension, fact key, dimension key).

    A fact row without a partner stays. Only dimension columns the fact lacks are added.
    """
    for dim, fact_key, dim_key in dims:
        extra = [c for c in dim.columns if c not in fact.columns and c != dim_key]
        right = dim.select(F.col(dim_key).alias("_dim_key"), *extra)
        fact = fact.join(right, F.col(fact_key) == F.col("_dim_key"), "left").drop("_dim_key")
    return fact


def slice_by(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, predicate: Column) -> DataFrame:
    """Keep the fact rows whose dimension row satisfies a slicer.

    The dimension is filtered first, so the fact meets only the rows that are left.
    """
    chosen = dim.where(predicate).select(F.col(dim_key).alias(fact_key)).distinct()
    return fact.join(chosen, fact_key, "left_semi")
