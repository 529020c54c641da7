"""Calendars, dimensions, facts and the ordered operators behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import completed_years, date_key, days_since_anniversary
from ..functions.keys import surrogate_key
from ..functions.money import money, sign_of, signed
from ..functions.text import normalize_text
from ..operators import calendar, intervals, sequences
from ..plans import checks, marts
from . import roles
from .base import Tables, query

query("dim_country", "SELECT country_code, country_name, currency_code, pay_frequency FROM r_country")(
    lambda t: marts.dim_country(roles.country(t))
)
query("dim_concept", "SELECT * FROM m_dim_concept")(roles.dim_concept)
query("dim_employee", "SELECT * FROM m_dim_employee")(roles.dim_employee)
query("fct_payroll_movement", "SELECT * FROM m_fct_payroll_movement")(roles.fct_payroll_movement)
query("fct_settlement", "SELECT * FROM m_fct_settlement")(roles.fct_settlement)
query("fct_absence_day", "SELECT * FROM m_fct_absence_day")(roles.fct_absence_day)
query("int_absence_days", "SELECT * FROM m_absence_day")(roles.absence_days)

_DATE_COLUMNS = """
    CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
    monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
    dayofweek(d) IN (0, 6) AS is_weekend
"""
_YEAR_SPAN = """
    FROM (SELECT date_trunc('year', min({c})) AS lo, CAST(year(max({c})) || '-12-31' AS DATE) AS hi FROM {t}) AS b,
         LATERAL generate_series(b.lo, b.hi, INTERVAL 1 DAY) AS s(d)
"""


@query("dim_date", f"SELECT {_DATE_COLUMNS} {_YEAR_SPAN.format(c='o_orderdate', t='orders')}")
def dim_date(t: Tables) -> DataFrame:
    """The date dimension over the years the orders span."""
    return calendar.describe_days(calendar.years_spanned(t.orders, "o_orderdate"))


@query(
    "column_calendar",
    f"""
    SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_no,
           monthname(d) AS month, CAST((month(d) + 2) // 3 AS INTEGER) AS quarter_no,
           'Qtr ' || ((month(d) + 2) // 3) AS quarter, CAST(day(d) AS INTEGER) AS day
    {_YEAR_SPAN.format(c='l_shipdate', t='lineitem')}
    """,
)
def column_calendar(t: Tables) -> DataFrame:
    return calendar.column_calendar(t.lineitem, "l_shipdate")


@query(
    "period_calendar",
    "SELECT p.*, c.pay_frequency FROM r_period p JOIN r_country c USING (country_code)",
)
def period_calendar(t: Tables) -> DataFrame:
    """Pay periods of every country over the months the orders span."""
    return roles.period(t).join(roles.country(t).select("country_code", "pay_frequency"), "country_code")


@query(
    "date_key",
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders",
)
def date_keys(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", date_key("o_orderdate").alias("date_key"))


@query(
    "signed_amount",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CASE WHEN l_returnflag IN ('A', 'R') THEN 1 ELSE -1 END AS DECIMAL(18,2))
             AS signed_amount
    FROM lineitem
    """,
)
def signed_amount(t: Tables) -> DataFrame:
    kind = F.when(F.col("l_returnflag").isin("A", "R"), "EARNING").otherwise("DEDUCTION")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        signed(money("l_extendedprice"), sign_of(kind)).alias("signed_amount"),
    )


@query("surrogate_key", "SELECT o_orderkey, md5(concat_ws('|', o_custkey, o_orderkey)) AS sk FROM orders")
def surrogate_keys(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", surrogate_key("o_custkey", "o_orderkey").alias("sk"))


@query(
    "normalize_text",
    """
    SELECT c_custkey, CASE c_custkey % 20 WHEN 0 THEN 'TEMPORARY' WHEN 1 THEN 'TEMPORARY' WHEN 2 THEN NULL ELSE 'INDEFINITE' END
             AS contract_type,
           upper(trim(lower(c_mktsegment) || ' ')) AS segment
    FROM customer
    """,
)
def normalized_text(t: Tables) -> DataFrame:
    dirty = F.concat(F.lower("c_mktsegment"), F.lit(" "))
    return t.customer.select(
        "c_custkey",
        normalize_text(roles.contract_text()).alias("contract_type"),
        normalize_text(dirty).alias("segment"),
    )


@query(
    "full_years",
    """
    SELECT employment_id, CAST(years AS INTEGER) AS full_years,
           CAST(termination_date - CAST(hire_date + to_years(CAST(years AS INTEGER)) AS DATE) AS INTEGER) AS anniversary_days
    FROM (SELECT *, year(termination_date) - year(hire_date)
                    - CASE WHEN hire_date + to_years(CAST(year(termination_date) - year(hire_date) AS INTEGER)) > termination_date
                           THEN 1 ELSE 0 END AS years
          FROM r_employment WHERE termination_date IS NOT NULL)
    """,
)
def full_years(t: Tables) -> DataFrame:
    return roles.employment(t).where("termination_date is not null").select(
        "employment_id",
        completed_years("hire_date", "termination_date").alias("full_years"),
        days_since_anniversary("hire_date", "termination_date").alias("anniversary_days"),
    )


# Ordered operators. Salaries per customer and month are bounded by the calendar; the
# others, per customer and order or per event, are cut into months.

def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus")


_ORDERS = "(SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus FROM orders)"


@query(
    "change_marks",
    f"""
    SELECT o_custkey, o_orderkey, day, o_orderstatus,
           CAST(CASE WHEN o_orderstatus = lag(o_orderstatus) OVER w THEN 0 ELSE 1 END AS INTEGER) AS is_change
    FROM {_ORDERS} WINDOW w AS (PARTITION BY o_custkey ORDER BY day, o_orderkey)
    """,
)
def change_marks(t: Tables) -> DataFrame:
    """Orders whose status differs from the customer's previous one."""
    return sequences.change_marks(
        _orders(t), "o_custkey", ["day", "o_orderkey"], "o_orderstatus", chunk=F.trunc("day", "month")
    )


@query(
    "gaps_islands",
    f"""
    SELECT o_custkey, CAST(version AS INTEGER) AS version, o_orderstatus, min(day) AS first_day, max(day) AS last_day, count(*) AS n_orders
    FROM (SELECT *, sum(chg) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey ROWS UNBOUNDED PRECEDING) AS version
          FROM (SELECT *, CASE WHEN o_orderstatus = lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey)
                               THEN 0 ELSE 1 END AS chg
                FROM {_ORDERS}))
    GROUP BY 1, 2, 3
    """,
)
def gaps_islands(t: Tables) -> DataFrame:
    """Runs of equal status per customer."""
    numbered = sequences.islands(
        _orders(t), "o_custkey", ["day", "o_orderkey"], "o_orderstatus", chunk=F.trunc("day", "month")
    )
    return numbered.groupBy("o_custkey", "version", "o_orderstatus").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n_orders")
    )


@query(
    "validity_intervals",
    """
    SELECT o_custkey, day, n_orders, coalesce(lead(day) OVER w - 1, DATE '9999-12-31') AS valid_to, lead(day) OVER w IS NULL AS is_current
    FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders FROM orders GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY o_custkey ORDER BY day)
    """,
)
def validity_intervals(t: Tables) -> DataFrame:
    """Each order day of a customer holds until the day before the next."""
    days = _orders(t).groupBy("o_custkey", "day").agg(F.count(F.lit(1)).alias("n_orders"))
    return sequences.validity(days, "o_custkey", "day")


@query(
    "history_truncated",
    """
    SELECT v.employment_id, v.version, v.first_period_start,
           min(v.first_period_start) OVER (PARTITION BY v.employment_id) > e.hire_date AS history_truncated
    FROM m_version v JOIN r_employment e USING (employment_id)
    """,
)
def history_truncated(t: Tables) -> DataFrame:
    salaries = marts.salary_by_period(roles.base_movement(t), roles.concept(t), roles.period(t), roles.country(t))
    versions = marts.salary_versions(salaries).join(
        roles.employment(t).select("employment_id", "hire_date"), "employment_id"
    )
    return sequences.left_censored(
        versions, "employment_id", "first_period_start", "hire_date", "history_truncated"
    ).select("employment_id", "version", "first_period_start", "history_truncated")


@query(
    "latest_per_key",
    """
    SELECT user_id, event_id, event_type, value, load_id
    FROM (SELECT *, strftime(ts, '%Y%m%d') AS load_id FROM events)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, load_id DESC, event_id DESC) = 1
    """,
)
def latest_per_key(t: Tables) -> DataFrame:
    """The newest event of each user, the newest load deciding between equals."""
    loads = t.events.withColumn("load_id", F.date_format("ts", "yyyyMMdd"))
    order = [F.col("ts").desc(), F.col("load_id").desc(), F.col("event_id").desc()]
    return sequences.latest_per_key(loads, "user_id", order).select(
        "user_id", "event_id", "event_type", "value", "load_id"
    )


@query(
    "last_per_group",
    """
    SELECT o_custkey, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
    FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
)
def last_per_group(t: Tables) -> DataFrame:
    """Each customer's last order."""
    last = sequences.latest_per_key(t.orders, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return last.select("o_custkey", "o_orderkey", money("o_totalprice").alias("amount"))


@query(
    "lag_check",
    """
    SELECT * FROM (
      SELECT employee_id, employment_id, hire_date, lag(employment_id) OVER w AS prev_employment_id,
             lag(termination_date) OVER w AS prev_termination_date
      FROM r_employment WINDOW w AS (PARTITION BY employee_id ORDER BY hire_date, employment_id))
    WHERE prev_employment_id IS NOT NULL AND (prev_termination_date IS NULL OR hire_date <= prev_termination_date)
    """,
)
def lag_check(t: Tables) -> DataFrame:
    """Rehires that start before the employee's previous employment ended."""
    return checks.rehired_too_early(roles.employment(t))


@query(
    "most_versions",
    """
    SELECT employment_id, full_name, version, monthly_salary, valid_from, valid_to, is_current, history_truncated
    FROM m_dim_employee
    WHERE employment_id = (SELECT employment_id FROM m_dim_employee WHERE country_code = 'NATION_7'
                           GROUP BY employment_id ORDER BY count(*) DESC, employment_id LIMIT 1)
    ORDER BY version
    """,
)
def most_versions(t: Tables) -> DataFrame:
    """The salary history of the person with most versions in one country."""
    dim = roles.dim_employee(t)
    chosen = (
        dim.where("country_code = 'NATION_7'")
        .groupBy("employment_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "employment_id")
        .limit(1)
        .select("employment_id")
    )
    return (
        dim.join(chosen, "employment_id", "left_semi")
        .select(
            "employment_id",
            "full_name",
            "version",
            "monthly_salary",
            "valid_from",
            "valid_to",
            "is_current",
            "history_truncated",
        )
        .orderBy("version")
    )


# Ranges.


@query(
    "explode_days",
    """
    SELECT a.absence_id, a.employment_id, CAST(g.day AS DATE) AS absence_date
    FROM r_absence a CROSS JOIN LATERAL generate_series(a.start_date, a.end_date, INTERVAL 1 DAY) AS g(day)
    WHERE a.status = 'APPROVED'
    """,
)
def explode_days(t: Tables) -> DataFrame:
    approved = roles.absence(t).where("status = 'APPROVED'")
    return intervals.explode_days(approved, "start_date", "end_date", "absence_date").select(
        "absence_id", "employment_id", "absence_date"
    )


@query("resolve_overlaps", "SELECT * FROM m_resolved")
def resolve_overlaps(t: Tables) -> DataFrame:
    return marts.resolve_absence_days(roles.absence_days(t))


@query(
    "clip_interval",
    """
    SELECT employment_id, greatest(hire_date, DATE '1997-01-01') AS active_start,
           least(coalesce(termination_date, DATE '1999-12-31'), DATE '1999-12-31') AS active_end
    FROM r_employment
    WHERE greatest(hire_date, DATE '1997-01-01') <= least(coalesce(termination_date, DATE '1999-12-31'), DATE '1999-12-31')
    """,
)
def clip_interval(t: Tables) -> DataFrame:
    """Employments cut to a three-year window."""
    return active_window(t).select("employment_id", "active_start", "active_end")


def active_window(t: Tables) -> DataFrame:
    low, high = (F.lit(d).cast("date") for d in ("1997-01-01", "1999-12-31"))
    return intervals.clip_interval(
        roles.employment(t), "hire_date", "termination_date", low, high, ("active_start", "active_end")
    )
