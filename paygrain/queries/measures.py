"""Measures and report queries over the facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import money
from ..operators import calendar, measures as m
from ..plans import reports
from . import roles
from .base import Tables, cte, query, role


@role
def date_dim(t: Tables) -> DataFrame:
    """The date dimension over the years of the orders and the year after, for late absences."""
    days = t.dated_orders.select(F.col("o_orderdate").cast("date").alias("d"))
    bounds = days.agg(F.min("d").alias("lo"), F.add_months(F.max("d"), 12).alias("hi"))
    edges = bounds.select(F.explode(F.array("lo", "hi")).alias("d"))
    return calendar.describe_days(calendar.years_spanned(edges, "d"))


cte(
    "m_dim_date",
    """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
           CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT date_trunc('year', min(o_orderdate)) AS lo, CAST(year(max(o_orderdate)) + 1 || '-12-31' AS DATE) AS hi FROM orders) AS b,
         LATERAL generate_series(b.lo, b.hi, INTERVAL 1 DAY) AS s(d)
    """,
)

_COUNTRY = "NATION_7"


def _slicer() -> Column:
    return F.col("country_code") == _COUNTRY


def _sliced(t: Tables) -> Tables:
    """The tables of the slicer's country: an employment belongs to one country for good."""
    chosen = roles.country(t).where(_slicer()).select(F.col("country_no").alias("c_nationkey"))
    return t.only(t.customer.join(chosen, "c_nationkey", "left_semi").select(*t.customer.columns))


def with_total(fact: DataFrame, t: Tables, make) -> DataFrame:
    """Measures per country and in total; ``make`` gets the guard, which fails on the total."""
    guard = (F.grouping("country_code") == 0) | m.one_country(roles.country(t), [])
    return fact.rollup("country_code").agg(*[c.alias(name) for name, c in make(guard).items()])


def summed_with_total(fact: DataFrame, t: Tables, name: str, measure: Column, one_currency: bool = True) -> DataFrame:
    """An additive measure per country and in total: summed per country, then rolled up from those few rows."""
    cells = fact.groupBy("country_code").agg(measure.alias(name))
    if not one_currency:
        return cells.rollup("country_code").agg(F.sum(name).alias(name))
    return with_total(cells, t, lambda guard: {name: m.guarded(money(F.sum(name)), guard)})


def with_concept(t: Tables) -> DataFrame:
    concepts = roles.dim_concept(t).select("concept_key", "concept_type", "concept_code")
    return m.star(roles.fct_payroll_movement(t), (concepts, "concept_key", "concept_key"))


def _absences(t: Tables) -> DataFrame:
    return m.star(roles.fct_absence_day(t), (date_dim(t).select("date_key", "is_weekend"), "date_key", "date_key"))


_WITH_TOTAL = "SELECT country_code, {x} FROM {f} GROUP BY country_code UNION ALL SELECT NULL, {y} FROM {f}"
_WITH_BLANK = "SELECT country_code, {x} FROM {f} GROUP BY country_code UNION ALL SELECT NULL, CAST(NULL AS DECIMAL(18,2))"


@query(
    "m_gross",
    """
    SELECT dc.concept_code, CAST(sum(f.amount) AS DECIMAL(18,2)) AS gross
    FROM m_fct_payroll_movement f JOIN m_dim_concept dc USING (concept_key) GROUP BY 1
    """,
)
def gross(t: Tables) -> DataFrame:
    return m.measure(with_concept(t), ["concept_code"], gross=m.gross())


@query(
    "m_net_guarded",
    """
    WITH f AS (SELECT f.*, dc.concept_code FROM m_fct_payroll_movement f JOIN m_dim_concept dc USING (concept_key))
    SELECT 'country' AS context, country_code AS member, CAST(sum(signed_amount) AS DECIMAL(18,2)) AS net FROM f GROUP BY country_code
    UNION ALL SELECT DISTINCT 'concept', concept_code, CAST(NULL AS DECIMAL(18,2)) FROM f
    UNION ALL SELECT 'total', NULL, CAST(NULL AS DECIMAL(18,2))
    UNION ALL SELECT 'slicer', 'NATION_7', CAST(sum(signed_amount) AS DECIMAL(18,2)) FROM f WHERE country_code = 'NATION_7'
    """,
)
def net_guarded(t: Tables) -> DataFrame:
    """Net pay in four contexts: per country, per concept, in total, under a country slicer.

    All of them come from one pass that sums the movements by country and concept.
    """
    cells = with_concept(t).groupBy("country_code", "concept_code").agg(F.sum("signed_amount").alias("signed_amount"))
    everywhere = m.one_country(roles.country(t), [])
    sets = cells.groupingSets([["country_code"], ["concept_code"], []], "country_code", "concept_code")
    by_country, by_concept = F.grouping("country_code") == 0, F.grouping("concept_code") == 0
    contexts = sets.agg(
        F.when(by_country, "country").when(by_concept, "concept").otherwise("total").alias("context"),
        m.net(by_country | everywhere).alias("net"),
    ).select("context", F.coalesce("country_code", "concept_code").alias("member"), "net")
    visible = roles.country(t).where(_slicer())
    one = m.measure(cells.where(_slicer()), [], net=m.net(m.one_country(visible, []))).select(
        F.lit("slicer").alias("context"), F.lit(_COUNTRY).alias("member"), "net"
    )
    return contexts.unionByName(one)


@query(
    "m_earnings",
    _WITH_BLANK.format(
        x="CAST(sum(CASE WHEN concept_type = 'EARNING' THEN amount END) AS DECIMAL(18,2)) AS earnings",
        f="m_fct_payroll_movement JOIN (SELECT concept_key, concept_type FROM m_dim_concept) USING (concept_key)",
    ),
)
def earnings(t: Tables) -> DataFrame:
    return summed_with_total(with_concept(t), t, "earnings", m.earnings(F.lit(True)))


@query(
    "m_deductions",
    _WITH_BLANK.format(
        x="CAST(sum(CASE WHEN concept_type = 'DEDUCTION' THEN amount END) AS DECIMAL(18,2)) AS deductions",
        f="m_fct_payroll_movement JOIN (SELECT concept_key, concept_type FROM m_dim_concept) USING (concept_key)",
    ),
)
def deductions(t: Tables) -> DataFrame:
    return summed_with_total(with_concept(t), t, "deductions", m.deductions(F.lit(True)))


def _counted(name: str, what: str, fact: str) -> str:
    return _WITH_TOTAL.format(x=f"{what} AS {name}", y=what, f=fact)


query("m_paid_employees", _counted("paid_employees", "count(DISTINCT employment_id)", "m_fct_payroll_movement"))(
    lambda t: with_total(roles.fct_payroll_movement(t), t, lambda g: {"paid_employees": m.distinct_employments()})
)
query("m_settlements", _counted("settlements", "count(*)", "m_fct_settlement"))(
    lambda t: summed_with_total(roles.fct_settlement(t), t, "settlements", m.rows(), one_currency=False)
)
query(
    "m_paid_indemnity",
    _WITH_BLANK.format(
        x="CAST(sum(CASE WHEN status = 'PAID' THEN indemnity_amount END) AS DECIMAL(18,2)) AS paid_indemnity",
        f="m_fct_settlement",
    ),
)(lambda t: summed_with_total(roles.fct_settlement(t), t, "paid_indemnity", m.paid_indemnity(F.lit(True))))
_AWAY = "m_fct_absence_day JOIN (SELECT date_key, is_weekend FROM m_dim_date) USING (date_key)"


def _by_type(name: str, what: str) -> str:
    return f"SELECT absence_type, {what} AS {name} FROM {_AWAY} GROUP BY 1"


@query("m_calendar_days", _by_type("calendar_days", "count(*)"))
def calendar_days(t: Tables) -> DataFrame:
    return m.measure(_absences(t), ["absence_type"], calendar_days=m.rows())


@query("m_business_days", _by_type("business_days", "count(CASE WHEN NOT is_weekend THEN 1 END)"))
def business_days(t: Tables) -> DataFrame:
    return m.measure(_absences(t), ["absence_type"], business_days=m.business_days())


@query("m_absent_employees", _by_type("absent_employees", "count(DISTINCT employment_id)"))
def absent_employees(t: Tables) -> DataFrame:
    return m.measure(_absences(t), ["absence_type"], absent_employees=m.distinct_employments())


# Reports.

_COUNTRIES = [f"NATION_{i}" for i in range(25)]
_UNLISTED = "country_code NOT IN (" + ", ".join(f"'{c}'" for c in _COUNTRIES) + ")"


@query(
    "report_net_long",
    """
    SELECT f.country_code, d.year, d.full_date, CAST(grouping(d.year) + grouping(d.full_date) AS INTEGER) AS totals,
           CAST(sum(f.signed_amount) AS DECIMAL(18,2)) AS net
    FROM m_fct_payroll_movement f LEFT JOIN m_dim_date d ON d.date_key = f.pay_date_key
    GROUP BY GROUPING SETS ((f.country_code, d.year, d.full_date), (f.country_code, d.year), (f.country_code))
    """,
)
def net_long(t: Tables) -> DataFrame:
    return reports.net_long(roles.fct_payroll_movement(t), date_dim(t))


@query(
    "report_net_matrix",
    "WITH c AS (SELECT d.year, d.full_date, f.country_code, sum(f.signed_amount) AS net FROM m_fct_payroll_movement f "
    "JOIN m_dim_date d ON d.date_key = f.pay_date_key GROUP BY ALL)\nSELECT year, full_date, "
    + ", ".join(f"CAST(sum(CASE WHEN country_code = '{c}' THEN net END) AS DECIMAL(18,2)) AS \"{c}\"" for c in _COUNTRIES)
    + f", CASE WHEN count(DISTINCT CASE WHEN {_UNLISTED} THEN country_code END) = 1"
    + f" THEN CAST(sum(CASE WHEN {_UNLISTED} THEN net END) AS DECIMAL(18,2)) END AS other"
    + ", CAST(NULL AS DECIMAL(18,2)) AS total FROM c GROUP BY ROLLUP (year, full_date)",
)
def net_matrix(t: Tables) -> DataFrame:
    return reports.net_matrix(roles.fct_payroll_movement(t), date_dim(t), roles.country(t), _COUNTRIES)


@query(
    "report_net_by_month",
    f"""
    SELECT d.year, d.month, d.month_name, CAST(sum(f.signed_amount) AS DECIMAL(18,2)) AS net
    FROM m_fct_payroll_movement f JOIN m_dim_date d ON d.date_key = f.pay_date_key
    WHERE f.country_code = '{_COUNTRY}' GROUP BY ALL ORDER BY 1, 2
    """,
)
def net_by_month(t: Tables) -> DataFrame:
    return reports.net_by_month(roles.fct_payroll_movement(_sliced(t)), date_dim(t), roles.country(t), _slicer())


@query(
    "report_net_by_concept",
    f"""
    SELECT dc.concept_name, CAST(sum(f.signed_amount) AS DECIMAL(18,2)) AS net
    FROM m_fct_payroll_movement f JOIN m_dim_concept dc USING (concept_key)
    WHERE f.country_code = '{_COUNTRY}' GROUP BY ALL ORDER BY net DESC
    """,
)
def net_by_concept(t: Tables) -> DataFrame:
    return reports.net_by_concept(roles.fct_payroll_movement(_sliced(t)), roles.dim_concept(t), roles.country(t), _slicer())


@query(
    "report_settlements_by_reason",
    f"""
    SELECT termination_reason, count(*) AS settlements,
           CAST(sum(CASE WHEN status = 'PAID' THEN indemnity_amount END) AS DECIMAL(18,2)) AS paid_indemnity
    FROM m_fct_settlement WHERE country_code = '{_COUNTRY}' GROUP BY 1
    """,
)
def settlements_by_reason(t: Tables) -> DataFrame:
    return reports.settlements_by_reason(roles.fct_settlement(_sliced(t)), roles.country(t), _slicer())


_TYPES = ["SICK_LEAVE", "VACATION", "UNJUSTIFIED"]


@query(
    "report_absence_matrix",
    "WITH f AS (SELECT de.department_name, a.absence_type FROM m_fct_absence_day a JOIN m_dim_date d USING (date_key) "
    "LEFT JOIN m_dim_employee de ON de.employee_sk = a.employee_sk WHERE NOT d.is_weekend)\n"
    "SELECT department_name, CAST(grouping(department_name) AS INTEGER) AS is_total, "
    + ", ".join(f"CAST(nullif(count(CASE WHEN absence_type = '{k}' THEN 1 END), 0) AS BIGINT) AS {k.lower()}" for k in _TYPES)
    + ", CAST(nullif(count(CASE WHEN absence_type NOT IN (" + ", ".join(f"'{k}'" for k in _TYPES) + ") THEN 1 END), 0) AS BIGINT) AS other"
    + ", count(*) AS total FROM f GROUP BY ROLLUP (department_name)",
)
def absence_matrix(t: Tables) -> DataFrame:
    return reports.absence_matrix(roles.fct_absence_day(t), date_dim(t), roles.dim_employee(t), _TYPES)


@query(
    "report_absence_by_month",
    """
    SELECT d.year, d.month, d.month_name, a.absence_type, count(*) AS business_days
    FROM m_fct_absence_day a JOIN m_dim_date d USING (date_key) WHERE NOT d.is_weekend GROUP BY ALL
    """,
)
def absence_by_month(t: Tables) -> DataFrame:
    return reports.absence_by_month(roles.fct_absence_day(t), date_dim(t))


@query(
    "report_kpis",
    f"""
    SELECT (SELECT CAST(sum(signed_amount) AS DECIMAL(18,2)) FROM m_fct_payroll_movement WHERE country_code = '{_COUNTRY}') AS net,
           (SELECT count(DISTINCT employment_id) FROM m_fct_payroll_movement WHERE country_code = '{_COUNTRY}') AS paid_employees,
           (SELECT count(*) FROM m_fct_settlement WHERE country_code = '{_COUNTRY}') AS settlements,
           (SELECT count(*) FROM m_fct_absence_day WHERE country_code = '{_COUNTRY}') AS calendar_days,
           (SELECT count(*) FROM m_fct_absence_day JOIN m_dim_date USING (date_key) WHERE country_code = '{_COUNTRY}' AND NOT is_weekend)
             AS business_days,
           (SELECT count(DISTINCT employment_id) FROM m_fct_absence_day WHERE country_code = '{_COUNTRY}') AS absent_employees
    """,
)
def kpis(t: Tables) -> DataFrame:
    part = _sliced(t)
    return reports.kpis(
        roles.fct_payroll_movement(part),
        roles.fct_settlement(part),
        roles.fct_absence_day(part),
        date_dim(t),
        roles.country(t),
        _slicer(),
    )


@query(
    "slicer_filter",
    f"""
    SELECT movement_id, employment_id, amount FROM m_fct_payroll_movement
    WHERE country_code = '{_COUNTRY}' AND employee_sk IN (SELECT employee_sk FROM m_dim_employee WHERE contract_type = 'TEMPORARY')
    """,
)
def slicer_filter(t: Tables) -> DataFrame:
    """Movements under two slicers: a country and a contract type."""
    part = _sliced(t)
    fact = m.slice_by(roles.fct_payroll_movement(part), roles.country(t), "country_code", "country_code", _slicer())
    temporary = F.col("contract_type") == "TEMPORARY"
    return m.slice_by(fact, roles.dim_employee(part), "employee_sk", "employee_sk", temporary).select(
        "movement_id", "employment_id", money("amount").alias("amount")
    )
