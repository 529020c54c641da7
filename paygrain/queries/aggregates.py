"""Aggregations: totals, pivots, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import inclusive_days
from ..functions.money import money
from ..functions.text import is_dirty, normalize_text
from ..operators.quality import row_counts
from ..plans import marts
from . import roles
from .base import Tables, query


@query(
    "yearly_totals",
    """
    SELECT p.country_code, CAST(year(p.start_date) AS INTEGER) AS pay_year, count(*) AS movements,
           CAST(sum(m.amount) AS DECIMAL(18,2)) AS total_amount
    FROM r_line_movement m JOIN r_period p USING (period_id) GROUP BY ALL ORDER BY ALL
    """,
)
def yearly_totals(t: Tables) -> DataFrame:
    """Movements and amount per country and year.

    The movements are summed per period before they meet the calendar.
    """
    per_period = roles.line_movement(t).groupBy("period_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )
    calendar = roles.period(t).select("period_id", "country_code", F.year("start_date").alias("pay_year"))
    return (
        per_period.join(calendar, "period_id")
        .groupBy("country_code", "pay_year")
        .agg(F.sum("n").alias("movements"), money(F.sum("amount")).alias("total_amount"))
        .orderBy("country_code", "pay_year", "movements", "total_amount")
    )


@query(
    "settlement_pivot",
    """
    SELECT settlement_id,
           CAST(sum(CASE WHEN concept_code = 'F002' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS vacation_amount,
           CAST(sum(CASE WHEN concept_code = 'F001' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS indemnity_amount,
           CAST(sum(CASE WHEN concept_type = 'DEDUCTION' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS deductions_amount,
           CAST(sum(amount * CASE concept_type WHEN 'EARNING' THEN 1 ELSE -1 END) AS DECIMAL(18,2)) AS net_amount
    FROM r_settlement_line JOIN r_concept USING (concept_id) GROUP BY 1
    """,
)
def settlement_pivot(t: Tables) -> DataFrame:
    return marts.settlement_amounts(roles.settlement_line(t), roles.concept(t))


@query(
    "summary_counts",
    """
    SELECT (SELECT count(*) FROM m_dim_employee) AS versions, (SELECT count(DISTINCT employment_id) FROM m_dim_employee) AS employments,
           (SELECT count(*) FROM m_dim_employee WHERE is_current) AS current_versions,
           (SELECT count(DISTINCT employment_id) FROM m_dim_employee WHERE history_truncated) AS truncated
    """,
)
def summary_counts(t: Tables) -> DataFrame:
    """Size of the employee dimension, in one pass over it."""
    return roles.dim_employee(t).agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_distinct("employment_id").alias("employments"),
        F.count(F.when(F.col("is_current"), 1)).alias("current_versions"),
        F.count_distinct(F.when(F.col("history_truncated"), F.col("employment_id"))).alias("truncated"),
    )


@query(
    "distinct_years",
    "SELECT DISTINCT make_date(CAST(year(start_date) AS BIGINT), 1, 1) AS event_date FROM r_period",
)
def distinct_years(t: Tables) -> DataFrame:
    """January 1 of every year the pay calendar touches."""
    return roles.period(t).select(F.trunc("start_date", "year").alias("event_date")).distinct()


@query(
    "absence_profile",
    """
    SELECT absence_type, status, count(*) AS absences, CAST(sum(end_date - start_date + 1) AS BIGINT) AS calendar_days
    FROM r_absence GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def absence_profile(t: Tables) -> DataFrame:
    return (
        roles.absence(t)
        .groupBy("absence_type", "status")
        .agg(F.count(F.lit(1)).alias("absences"), F.sum(inclusive_days("start_date", "end_date")).alias("calendar_days"))
        .orderBy("absence_type", "status")
    )


@query(
    "dirty_text_profile",
    """
    SELECT '[' || v || ']' AS visible_value, CAST(strlen(v) AS INTEGER) AS n_bytes, v <> upper(trim(v)) AS is_dirty, count(*) AS n_rows
    FROM (SELECT CASE c_custkey % 20 WHEN 0 THEN 'TEMPORARY' WHEN 1 THEN 'temporary ' WHEN 2 THEN NULL ELSE 'INDEFINITE' END AS v FROM customer)
    GROUP BY ALL
    """,
)
def dirty_text_profile(t: Tables) -> DataFrame:
    """Contract types as they are stored: with brackets, length in bytes and whether they need tidying."""
    value = roles.contract_text().alias("v")
    return (
        t.customer.select(value)
        .groupBy(
            F.concat(F.lit("["), F.col("v"), F.lit("]")).alias("visible_value"),
            F.octet_length("v").alias("n_bytes"),
            is_dirty("v").alias("is_dirty"),
        )
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(
    "text_repair",
    """
    SELECT c_custkey, coalesce(upper(trim(v)), 'INDEFINITE') AS contract_type, v IS NULL OR v <> upper(trim(v)) AS repaired
    FROM (SELECT c_custkey, CASE c_custkey % 20 WHEN 0 THEN 'TEMPORARY' WHEN 1 THEN 'temporary ' WHEN 2 THEN NULL ELSE 'INDEFINITE' END AS v
          FROM customer)
    """,
)
def text_repair(t: Tables) -> DataFrame:
    """Dirty values normalized and missing ones filled, as an update that touches only those rows."""
    from ..operators.upserts import update_where

    rows = t.customer.select("c_custkey", roles.contract_text().alias("contract_type")).withColumn("repaired", F.lit(False))
    dirty, missing = is_dirty("contract_type"), F.col("contract_type").isNull()
    tidied = update_where(rows, dirty, {"contract_type": normalize_text("contract_type"), "repaired": F.lit(True)})
    return update_where(tidied, missing, {"contract_type": F.lit("INDEFINITE"), "repaired": F.lit(True)})


@query(
    "layer_counts",
    """
    SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events
    """,
)
def layer_counts(t: Tables) -> DataFrame:
    """One row per table with its count."""
    return row_counts({"customer": t.customer, "orders": t.orders, "lineitem": t.lineitem, "events": t.events})
