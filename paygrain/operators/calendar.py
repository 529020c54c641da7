"""Calendars: the date dimension, date spines and pay periods."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import OPEN_END, date_key, month_end, sunday_zero_dow

# The span that the date dimension has at least.
DIM_DATE_FROM, DIM_DATE_TO = "2015-01-01", "2026-12-31"


def _month_name(day: str) -> Column:
    return F.date_format(day, "MMMM")


def describe_days(days: DataFrame, day: str = "full_date") -> DataFrame:
    """The columns of the date dimension for a column of days."""
    return days.select(
        date_key(day).alias("date_key"),
        F.col(day).alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        _month_name(day).alias("month_name"),
        F.dayofmonth(day).alias("day"),
        sunday_zero_dow(day).alias("day_of_week"),
        sunday_zero_dow(day).isin(0, 6).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str = DIM_DATE_FROM, end: str = DIM_DATE_TO) -> DataFrame:
    span = spark.range(1).select(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")).alias("days"))
    return describe_days(span.select(F.explode("days").alias("full_date")))


def dim_date_for(spark: SparkSession, dates: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """The date dimension over its usual span and all whole years in which one of the columns has a date."""
    usual = spark.sql(f"SELECT DATE '{DIM_DATE_FROM}' AS day UNION ALL SELECT DATE '{DIM_DATE_TO}'")
    edges = [
        df.select(F.col(column).cast("date").alias("day"))
        .where(F.col("day") < F.lit(OPEN_END).cast("date"))
        .agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
        .select(F.explode(F.array("lo", "hi")).alias("day"))
        for df, column in dates
    ]
    return describe_days(years_spanned(reduce(DataFrame.unionByName, edges, usual), "day"))


def years_spanned(df: DataFrame, column: str, out: str = "full_date") -> DataFrame:
    """Every day from Jan 1 of the column's first year to Dec 31 of its last.

    Open ends are left out: they would stretch the calendar to the year 9999.
    """
    day = F.col(column).cast("date")
    bounds = df.where(day < F.lit(OPEN_END).cast("date")).agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    first, last = F.trunc("lo", "year"), F.make_date(F.year("hi"), F.lit(12), F.lit(31))
    # The sequence is empty, not an error, when the column holds no date at all.
    return bounds.where("lo is not null").select(F.explode(F.sequence(first, last)).alias(out))


def column_calendar(df: DataFrame, column: str) -> DataFrame:
    """The date hierarchy a report builds over one column."""
    return years_spanned(df, column, "date").select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month_no"),
        _month_name("date").alias("month"),
        ((F.month("date") + 2) / 3).cast("int").alias("quarter_no"),
        F.concat(F.lit("Qtr "), ((F.month("date") + 2) / 3).cast("int").cast("string")).alias("quarter"),
        F.dayofmonth("date").alias("day"),
    )


def pay_periods(countries: DataFrame, first_month: Column, last_month: Column) -> DataFrame:
    """Pay periods per country: halves of a month (1-15, 16-end) or whole months.

    ``countries`` needs pay_frequency; its columns are kept. Months and halves are exploded
    from literals, so no cross join is planned. Pay day is the last day of the period.
    """
    months = countries.withColumn(
        "_month", F.explode(F.sequence(F.trunc(first_month, "month"), F.trunc(last_month, "month"), F.expr("interval 1 month")))
    )
    biweekly = F.col("pay_frequency") == "BIWEEKLY"
    halves = months.withColumn("half", F.explode(F.when(biweekly, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    start = F.when(F.col("half") == 1, F.col("_month")).otherwise(F.date_add("_month", 15))
    end = F.when(biweekly & (F.col("half") == 1), F.date_add("_month", 14)).otherwise(month_end("_month"))
    return halves.select(
        *countries.columns,
        "half",
        start.alias("start_date"),
        end.alias("end_date"),
        end.alias("pay_date"),
    )
