"""The queries behind the report pages.

Amounts are guarded: without a country in the group keys or a slicer that leaves one
country, they are NULL. Facts are summed to the grain of the report first; totals and
pivots are built from those few rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import money
from ..operators import measures as m


def _dates(date_dim: DataFrame, *columns: str) -> DataFrame:
    return date_dim.select("date_key", *columns)


def sliced(fact: DataFrame, countries: DataFrame, predicate: Column | None) -> tuple[DataFrame, DataFrame]:
    """Fact and country dimension under a country slicer."""
    if predicate is None:
        return fact, countries
    return m.slice_by(fact, countries, "country_code", "country_code", predicate), countries.where(predicate)


def one_row(*parts: DataFrame) -> DataFrame:
    """Several one-row aggregates side by side, without joining them."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def _net_cells(movements: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Net pay by year, day and country. A day the date dimension lacks stays, as an unknown day."""
    dated = movements.join(_dates(date_dim, "year", "full_date"), F.col("pay_date_key") == F.col("date_key"), "left")
    return dated.groupBy("year", "full_date", "country_code").agg(F.sum("signed_amount").alias("_net"))


def net_long(movements: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Net pay by country, with totals over days and years: every country there is, one row per cell."""
    cells = _net_cells(movements, date_dim)
    sets = [["country_code", "year", "full_date"], ["country_code", "year"], ["country_code"]]
    level = sum((F.grouping(c) for c in ("year", "full_date")), F.lit(0))
    return cells.groupingSets(sets, "country_code", "year", "full_date").agg(
        level.cast("int").alias("totals"), money(F.sum("_net")).alias("net")
    )


def net_matrix(movements: DataFrame, date_dim: DataFrame, countries: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Net pay by year and day, one column per country, with totals over the days and years.

    There is no total over the countries: their currencies differ. ``other`` is the net of a country that is
    not among ``columns``; it is NULL where there are several, as their currencies differ too (``net_long`` has them).
    """
    cells = _net_cells(movements, date_dim)
    unlisted = ~F.col("country_code").isin(list(columns))
    return cells.rollup("year", "full_date").agg(
        *[money(F.sum(F.when(F.col("country_code") == c, F.col("_net")))).alias(c) for c in columns],
        m.guarded(
            money(F.sum(F.when(unlisted, F.col("_net")))), F.count_distinct(F.when(unlisted, F.col("country_code"))) == 1
        ).alias("other"),
        m.guarded(money(F.sum("_net")), m.one_country(countries, [])).alias("total"),
    )


def net_by_month(movements: DataFrame, date_dim: DataFrame, countries: DataFrame, predicate: Column | None) -> DataFrame:
    fact, visible = sliced(movements, countries, predicate)
    dated = fact.join(_dates(date_dim, "year", "month", "month_name"), F.col("pay_date_key") == F.col("date_key"), "left")
    by = ["year", "month", "month_name"]
    return m.measure(dated, by, net=m.net(m.one_country(visible, by))).orderBy("year", "month")


def net_by_concept(movements: DataFrame, concepts: DataFrame, countries: DataFrame, predicate: Column | None) -> DataFrame:
    fact, visible = sliced(movements, countries, predicate)
    named = m.star(fact, (concepts.select("concept_key", "concept_name"), "concept_key", "concept_key"))
    by = ["concept_name"]
    return m.measure(named, by, net=m.net(m.one_country(visible, by))).orderBy(F.col("net").desc_nulls_last(), "concept_name")


def settlements_by_reason(settlements: DataFrame, countries: DataFrame, predicate: Column | None) -> DataFrame:
    fact, visible = sliced(settlements, countries, predicate)
    by = ["termination_reason"]
    return m.measure(fact, by, settlements=m.rows(), paid_indemnity=m.paid_indemnity(m.one_country(visible, by)))


def absence_matrix(absences: DataFrame, date_dim: DataFrame, employee_dim: DataFrame, types: Sequence[str]) -> DataFrame:
    """Business days by department and absence type, types that are not listed under ``other``, with both totals."""
    described = m.star(
        absences,
        (_dates(date_dim, "is_weekend"), "date_key", "date_key"),
        (employee_dim.select("employee_sk", "department_name"), "employee_sk", "employee_sk"),
    )
    cells = described.groupBy("department_name", "absence_type").agg(m.business_days().alias("_days"))
    return cells.rollup("department_name").agg(
        F.grouping("department_name").cast("int").alias("is_total"),
        *[F.sum(F.when(F.col("absence_type") == k, F.col("_days"))).alias(k.lower()) for k in types],
        F.sum(F.when(~F.col("absence_type").isin(list(types)), F.col("_days"))).alias("other"),
        F.sum("_days").alias("total"),
    )


def absence_by_month(absences: DataFrame, date_dim: DataFrame) -> DataFrame:
    dated = m.star(absences, (_dates(date_dim, "year", "month", "month_name", "is_weekend"), "date_key", "date_key"))
    return m.measure(dated, ["year", "month", "month_name", "absence_type"], business_days=m.business_days()).where(
        "business_days is not null"
    )


def kpis(
    movements: DataFrame,
    settlements: DataFrame,
    absences: DataFrame,
    date_dim: DataFrame,
    countries: DataFrame,
    predicate: Column | None,
) -> DataFrame:
    """The cards: one row of totals under a country slicer."""
    paid, visible = sliced(movements, countries, predicate)
    ended, _ = sliced(settlements, countries, predicate)
    away, _ = sliced(absences, countries, predicate)
    guard = m.one_country(visible, [])
    days = m.star(away, (_dates(date_dim, "is_weekend"), "date_key", "date_key"))
    return one_row(
        m.measure(paid, [], net=m.net(guard), paid_employees=m.distinct_employments()),
        m.measure(ended, [], settlements=m.rows()),
        m.measure(
            days, [], calendar_days=m.rows(), business_days=m.business_days(), absent_employees=m.distinct_employments()
        ),
    )
