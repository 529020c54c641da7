"""Payroll rules on the given tables. Draws come from md5, so that SQL can repeat them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import at_second
from ..functions.keys import hash_percent, portable_draw
from ..functions.money import money, periods_per_month
from ..operators import rules
from . import roles
from .base import Tables, cte, query, role
from .dims import active_window


def _draw(*keys: str, label: int = 0) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', {', '.join(keys)}, {label})), 1, 7))::BIGINT % 10000 / 10000.0::DOUBLE)"


@role
def employments(t: Tables) -> DataFrame:
    """Employments with country, pay rhythm and hiring salary."""
    return (
        roles.employment(t)
        .join(roles.department(t).select("department_id", "country_code"), "department_id")
        .join(roles.country(t).select("country_code", "country_no", "pay_frequency"), "country_code")
        .select(
            "employment_id",
            "country_code",
            "country_no",
            periods_per_month("pay_frequency").alias("periods_per_month"),
            "hire_date",
            "termination_date",
            "termination_reason",
            F.col("monthly_salary").alias("base_salary"),
        )
    )


cte(
    "r_emp",
    """
    SELECT e.employment_id, d.country_code, c.country_no, CASE c.pay_frequency WHEN 'BIWEEKLY' THEN 2 ELSE 1 END AS periods_per_month,
           e.hire_date, e.termination_date, e.termination_reason, e.monthly_salary AS base_salary
    FROM r_employment e JOIN r_department d USING (department_id) JOIN r_country c USING (country_code)
    """,
)


def raise_rules(t: Tables) -> DataFrame:
    low = F.lit(0.03) + (F.col("country_no") % 3) * 0.01
    return roles.country(t).select(
        "country_code", F.lit(0.8).alias("probability"), low.alias("min_pct"), (low + 0.05).alias("max_pct")
    )


cte(
    "r_raise",
    """
    SELECT country_code, 0.8::DOUBLE AS probability, 0.03::DOUBLE + (country_no % 3) * 0.01::DOUBLE AS min_pct,
           0.03::DOUBLE + (country_no % 3) * 0.01::DOUBLE + 0.05::DOUBLE AS max_pct
    FROM r_country
    """,
)


def _years(t: Tables):
    first, last = roles.order_span(t)
    return F.year(first), F.year(last)


cte(
    "r_due",
    """
    SELECT e.*, y.event_date FROM r_emp e
    CROSS JOIN (SELECT DISTINCT make_date(CAST(year(start_date) AS BIGINT), 1, 1) AS event_date FROM r_period) y
    WHERE e.hire_date < y.event_date AND (e.termination_date IS NULL OR e.termination_date >= y.event_date)
    """,
)


@query("annual_events", "SELECT employment_id, country_code, event_date FROM r_due")
def annual_events(t: Tables) -> DataFrame:
    """Each January 1 on which an employment could get a raise."""
    first, last = _years(t)
    return rules.annual_events(employments(t), "hire_date", "termination_date", first, last, "event_date").select(
        "employment_id", "country_code", "event_date"
    )


cte(
    "r_salary_event",
    f"""
    SELECT employment_id, hire_date AS event_date, base_salary, 0::DOUBLE AS pct FROM r_emp
    UNION ALL
    SELECT employment_id, event_date, base_salary,
           min_pct + (max_pct - min_pct) * {_draw('employment_id', 'event_date', label=1)}
    FROM r_due JOIN r_raise USING (country_code)
    WHERE {_draw('employment_id', 'event_date', label=0)} < probability
    """,
)
cte(
    "r_timeline",
    """
    SELECT employment_id, event_date AS valid_from, coalesce(lead(event_date) OVER w - 1, DATE '9999-12-31') AS valid_to,
           CAST(CAST(base_salary AS DECIMAL(16,2)) * CAST(round(exp(sum(ln(1.0::DOUBLE + pct)) OVER (PARTITION BY employment_id
             ORDER BY event_date ROWS UNBOUNDED PRECEDING)), 10) AS DECIMAL(20,10)) AS DECIMAL(18,2)) AS salary,
           lead(event_date) OVER w IS NULL AS is_current
    FROM r_salary_event WINDOW w AS (PARTITION BY employment_id ORDER BY event_date)
    """,
)


@role
def timeline(t: Tables) -> DataFrame:
    return rules.salary_timeline(employments(t), raise_rules(t), *_years(t), draw=portable_draw)


query("salary_timeline", "SELECT * FROM r_timeline")(timeline)


@query(
    "compound_growth",
    """
    SELECT o_custkey, year, CAST(CAST(1000 AS DECIMAL(16,2)) * CAST(round(exp(sum(ln(1.0::DOUBLE + n / 100.0::DOUBLE))
             OVER (PARTITION BY o_custkey ORDER BY year ROWS UNBOUNDED PRECEDING)), 10) AS DECIMAL(20,10)) AS DECIMAL(18,2)) AS grown
    FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1, 2)
    """,
)
def compound_growth(t: Tables) -> DataFrame:
    """1000 grown, year after year, by one percent for every order of the year."""
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        (F.count(F.lit(1)) / F.lit(100.0)).alias("pct")
    )
    based = yearly.withColumn("base", money(F.lit(1000)))
    return rules.compound_growth(based, "o_custkey", "year", "pct", "base", "grown").select("o_custkey", "year", "grown")


@role
def employment_periods(t: Tables) -> DataFrame:
    return rules.employment_periods(employments(t), roles.period(t), timeline(t))


cte(
    "r_emp_period",
    """
    SELECT e.employment_id, e.country_code, e.periods_per_month, p.period_id, p.start_date, p.pay_date,
           CAST(month(p.start_date) AS INTEGER) AS period_month, p.end_date = last_day(p.start_date) AS is_last_of_month, s.salary
    FROM r_emp e
    JOIN r_period p ON p.country_code = e.country_code AND p.start_date <= coalesce(e.termination_date, DATE '9999-12-31')
     AND p.end_date >= e.hire_date
    JOIN r_timeline s ON s.employment_id = e.employment_id AND greatest(p.start_date, e.hire_date) BETWEEN s.valid_from AND s.valid_to
    """,
)
query("employment_periods", "SELECT * FROM r_emp_period")(employment_periods)

# rule number, concept, type, method, scope, probability, value from, value to, pay month, salary from, salary to,
# and the countries it holds in: those whose number leaves the second figure when divided by the first
_RULES = [
    (1, "P001", "EARNING", "SALARY", "PERIOD", "1", "1", "1", "NULL", "NULL", "NULL", 1, 0),
    (2, "P002", "EARNING", "PCT_SALARY", "PERIOD", "0.2", "0.05", "0.15", "NULL", "NULL", "NULL", 2, 0),
    (3, "P003", "EARNING", "FIXED", "EMPLOYMENT", "0.35", "150", "450", "NULL", "NULL", "NULL", 1, 0),
    (4, "P002", "EARNING", "PCT_SALARY", "PERIOD", "1", "0.5", "0.5", "12", "NULL", "NULL", 1, 0),
    (5, "P003", "EARNING", "FIXED", "PERIOD", "0.7", "100", "100", "NULL", "NULL", "1300", 3, 0),
    (6, "D002", "DEDUCTION", "PCT_SALARY", "PERIOD", "1", "0.09", "0.09", "NULL", "NULL", "NULL", 1, 0),
    (7, "D001", "DEDUCTION", "PCT_EARNINGS", "PERIOD", "0.9", "0.1", "0.12", "NULL", "1250", "NULL", 1, 0),
    (8, "P002", "EARNING", "PCT_SALARY", "PERIOD", "1", "0.5", "0.5", "6", "NULL", "NULL", 2, 1),
    (9, "P003", "EARNING", "PCT_SALARY", "EMPLOYMENT", "0.6", "0.01", "0.04", "NULL", "1100", "1400", 3, 1),
]
_FIELDS = "no, concept_code, concept_type, method, scope, probability, lo, hi, pay_month, salary_from, salary_to, every, rest"


@role
def pay_rules(t: Tables) -> DataFrame:
    """The rules of each country; some hold everywhere, others in every second or third country."""
    entries = F.array(
        *[
            F.expr(
                f"named_struct('no', {no}, 'concept_code', '{code}', 'concept_type', '{kind}', 'method', '{method}', "
                f"'scope', '{scope}', 'probability', cast({p} as double), 'min_value', cast({lo} as decimal(18,4)), "
                f"'max_value', cast({hi} as decimal(18,4)), 'pay_month', cast({month} as int), "
                f"'salary_from', cast({above} as decimal(18,2)), 'salary_to', cast({below} as decimal(18,2)), "
                f"'every', {every}, 'rest', {rest})"
            )
            for no, code, kind, method, scope, p, lo, hi, month, above, below, every, rest in _RULES
        ]
    )
    return (
        roles.country(t)
        .select("country_code", "country_no", F.explode(entries).alias("r"))
        .where("country_no % r.every = r.rest")
        .select("country_code", (F.col("country_no") * 10 + F.col("r.no")).alias("rule_id"), "r.*")
        .drop("no", "every", "rest")
    )


cte(
    "r_rule",
    f"""
    SELECT country_code, country_no * 10 + no AS rule_id, concept_code, concept_type, method, scope, CAST(probability AS DOUBLE) AS probability,
           CAST(lo AS DECIMAL(18,4)) AS min_value, CAST(hi AS DECIMAL(18,4)) AS max_value, pay_month, salary_from, salary_to
    FROM r_country CROSS JOIN (VALUES {', '.join(
        f"({no}, '{code}', '{kind}', '{method}', '{scope}', {p}, {lo}, {hi}, {month}, {above}, {below}, {every}, {rest})"
        for no, code, kind, method, scope, p, lo, hi, month, above, below, every, rest in _RULES)})
      AS v({_FIELDS})
    WHERE country_no % every = rest
    """,
)
_OWN, _EACH = ("employment_id", "rule_id"), ("employment_id", "period_id", "rule_id")


def _value(draw: str) -> str:
    return f"CAST(min_value + CAST(max_value - min_value AS DECIMAL(12,4)) * CAST({draw} AS DECIMAL(5,4)) AS DECIMAL(16,8))"


cte(
    "r_first_pass",
    f"""
    SELECT employment_id, period_id, country_code, rule_id, concept_code, concept_type, salary, pay_date,
           CASE method WHEN 'SALARY' THEN CAST(salary * part AS DECIMAL(18,2))
                       WHEN 'PCT_SALARY' THEN CAST(CAST(salary AS DECIMAL(14,2)) * val * share AS DECIMAL(18,2))
                       WHEN 'FIXED' THEN CAST(val * share AS DECIMAL(18,2)) END AS amount
    FROM (
      SELECT *, CAST(CASE WHEN periods_per_month = 2 THEN 0.5 ELSE 1.0 END AS DECIMAL(2,1)) AS part,
             CAST(CASE WHEN pay_month IS NULL AND periods_per_month = 2 THEN 0.5 ELSE 1.0 END AS DECIMAL(2,1)) AS share,
             CASE WHEN scope = 'EMPLOYMENT' THEN {_value(_draw(*_OWN, label=1))} ELSE {_value(_draw(*_EACH, label=1))} END AS val,
             CASE WHEN scope = 'EMPLOYMENT' THEN {_draw(*_OWN)} ELSE {_draw(*_EACH)} END AS luck
      FROM r_emp_period JOIN r_rule USING (country_code)
      WHERE method <> 'PCT_EARNINGS' AND (pay_month IS NULL OR (pay_month = period_month AND is_last_of_month))
        AND (salary_from IS NULL OR salary >= salary_from) AND (salary_to IS NULL OR salary <= salary_to))
    WHERE luck < probability
    """,
)


@role
def first_pass(t: Tables) -> DataFrame:
    return rules.rule_apply(employment_periods(t), pay_rules(t), portable_draw)


@query(
    "rule_apply",
    """
    SELECT employment_id, rule_id, concept_code, count(*) AS n_movements, CAST(sum(amount) AS DECIMAL(18,2)) AS amount
    FROM r_first_pass GROUP BY ALL
    """,
)
def rule_apply(t: Tables) -> DataFrame:
    """The first pass over the rules, summed per employment and rule."""
    return first_pass(t).groupBy("employment_id", "rule_id", "concept_code").agg(
        F.count(F.lit(1)).alias("n_movements"), money(F.sum("amount")).alias("amount")
    )


@query(
    "rule_second_pass",
    f"""
    SELECT employment_id, period_id, rule_id, CAST(earnings * {_value(_draw(*_EACH, label=1))} AS DECIMAL(18,2)) AS amount
    FROM (SELECT employment_id, period_id, country_code, salary, CAST(sum(amount) AS DECIMAL(18,2)) AS earnings
          FROM r_first_pass WHERE concept_type = 'EARNING' GROUP BY ALL)
    JOIN r_rule USING (country_code)
    WHERE method = 'PCT_EARNINGS' AND (salary_from IS NULL OR salary >= salary_from) AND (salary_to IS NULL OR salary <= salary_to)
      AND {_draw(*_EACH)} < probability
    """,
)
def rule_second_pass(t: Tables) -> DataFrame:
    """Rules on the earnings of a period."""
    return rules.rule_second_pass(first_pass(t), pay_rules(t), portable_draw).select(
        "employment_id", "period_id", "rule_id", "amount"
    )


_WINDOW_END = "2001-12-31"


@role
def settlement_headers(t: Tables) -> DataFrame:
    terminated = employments(t).withColumnRenamed("base_salary", "monthly_salary")
    return rules.settlement_headers(terminated, F.lit(_WINDOW_END).cast("date"), portable_draw)


cte(
    "r_header",
    f"""
    SELECT employment_id, country_code, country_no, hire_date, termination_date, termination_reason, base_salary,
           termination_date + CAST(floor({_draw('employment_id')} * 16) AS INTEGER) AS settlement_date,
           CASE WHEN termination_date > DATE '{_WINDOW_END}' - 30 THEN 'DRAFT'
                WHEN {_draw('employment_id', label=1)} < 0.03 THEN 'CANCELLED' ELSE 'PAID' END AS status,
           CAST(years AS INTEGER) AS full_years,
           CAST(termination_date - CAST(hire_date + to_years(CAST(years AS INTEGER)) AS DATE) AS INTEGER) AS anniversary_days
    FROM (SELECT *, year(termination_date) - year(hire_date)
                    - CASE WHEN hire_date + to_years(CAST(year(termination_date) - year(hire_date) AS INTEGER)) > termination_date
                           THEN 1 ELSE 0 END AS years
          FROM r_emp WHERE termination_date IS NOT NULL)
    """,
)


@query(
    "settlement_headers",
    "SELECT employment_id, settlement_date, status, full_years, anniversary_days FROM r_header",
)
def headers(t: Tables) -> DataFrame:
    return settlement_headers(t).select(
        "employment_id", "settlement_date", "status", "full_years", "anniversary_days"
    )


def security_rates(t: Tables) -> DataFrame:
    """Social security as its rule has it, per country."""
    return pay_rules(t).where("concept_code = 'D002'").select("country_code", F.col("min_value").alias("rate"))


cte(
    "r_vacation",
    """
    SELECT *, CAST(base_salary * CAST(0.5 AS DECIMAL(2,1)) * anniversary_days / 365 AS DECIMAL(18,2)) AS vacation FROM r_header
    """,
)


@query(
    "settlement_lines",
    """
    SELECT employment_id, country_code, 'F002' AS concept_code, vacation AS amount FROM r_vacation
    UNION ALL
    SELECT employment_id, country_code, 'F001', CAST(base_salary * least(greatest(full_years, 1), 12) AS DECIMAL(18,2))
    FROM r_vacation WHERE termination_reason = 'DISMISSAL'
    UNION ALL
    SELECT employment_id, country_code, 'D002', CAST(vacation * CAST(r.min_value AS DECIMAL(5,4)) AS DECIMAL(18,2))
    FROM r_vacation JOIN r_rule r USING (country_code) WHERE r.concept_code = 'D002'
    """,
)
def settlement_lines(t: Tables) -> DataFrame:
    return rules.settlement_lines(settlement_headers(t), security_rates(t))


@query(
    "required_catalog",
    """
    SELECT c.country_code, v.concept_code
    FROM (SELECT DISTINCT 'NATION_' || c_nationkey AS country_code FROM customer) c
    CROSS JOIN (VALUES ('F001'), ('F002'), ('D002')) AS v(concept_code)
    WHERE NOT EXISTS (SELECT 1 FROM r_concept k WHERE k.country_code = c.country_code AND k.concept_code = v.concept_code
                      AND k.concept_id % 20 <> 6)
    """,
)
def required_catalog(t: Tables) -> DataFrame:
    """Settlement concepts that a country with customers lacks (every other country lost F001)."""
    countries = t.customer.select(F.col("c_nationkey").alias("country_no")).distinct().select(
        F.concat(F.lit("NATION_"), F.col("country_no").cast("string")).alias("country_code")
    )
    concepts = roles.concept(t).where("concept_id % 20 <> 6")
    return rules.missing_catalog(countries, concepts, ["F001", "F002", "D002"])


_SLOTS = [
    ("VACATION", 1, 0.85, 3, 10),
    ("VACATION", 2, 0.50, 2, 6),
    ("SICK_LEAVE", 1, 0.30, 1, 7),
    ("UNJUSTIFIED", 1, 0.20, 1, 1),
]
_SLOT_KEYS = ("employment_id", "yr", "absence_type", "slot")


@query(
    "range_candidates",
    f"""
    SELECT employment_id, absence_type, CAST(yr AS INTEGER) AS yr, slot, start_date,
           least(start_date + CAST(min_days + floor({_draw(*_SLOT_KEYS, label=2)} * (max_days - min_days + 1)) - 1 AS INTEGER), active_end) AS end_date
    FROM (
      SELECT *, ys + CAST(floor({_draw(*_SLOT_KEYS, label=1)} * (ye - ys + 1)) AS INTEGER) AS start_date
      FROM (
        SELECT a.employment_id, a.active_end, y.yr, s.*, greatest(a.active_start, make_date(y.yr, 1, 1)) AS ys,
               least(a.active_end, make_date(y.yr, 12, 31)) AS ye
        FROM (SELECT employment_id, greatest(hire_date, DATE '1997-01-01') AS active_start,
                     least(coalesce(termination_date, DATE '1999-12-31'), DATE '1999-12-31') AS active_end FROM r_employment) a
        CROSS JOIN (VALUES (1997::BIGINT), (1998), (1999)) AS y(yr)
        CROSS JOIN (VALUES {', '.join(str(s) for s in _SLOTS)}) AS s(absence_type, slot, probability, min_days, max_days)
        WHERE a.active_start <= a.active_end AND make_date(y.yr, 12, 31) >= a.active_start AND make_date(y.yr, 1, 1) <= a.active_end)
      WHERE {_draw(*_SLOT_KEYS)} < probability)
    """,
)
def range_candidates(t: Tables) -> DataFrame:
    """Absence ranges drawn per employment, year and slot inside the active window."""
    active = active_window(t).select("employment_id", "active_start", "active_end")
    slots = t.spark.createDataFrame(
        _SLOTS, "absence_type string, slot int, probability double, min_days int, max_days int"
    )
    return rules.range_candidates(active, slots, 1997, 1999, portable_draw)


@query(
    "hash_sample",
    """
    SELECT absence_id, employment_id FROM r_absence
    WHERE absence_type = 'VACATION' AND ('0x' || substr(md5(concat_ws('|', absence_id)), 1, 7))::BIGINT % 100 < 6
    """,
)
def hash_sample(t: Tables) -> DataFrame:
    """About six percent of the vacations, the same ones on every run."""
    return roles.absence(t).where((F.col("absence_type") == "VACATION") & (hash_percent("absence_id") < 6)).select(
        "absence_id", "employment_id"
    )


@query(
    "audit_times",
    f"""
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_seconds(64800 + CAST(floor({_draw('o_orderkey')} * 7200) AS BIGINT)) AS processed_at
    FROM orders
    """,
)
def audit_times(t: Tables) -> DataFrame:
    """A processing time in the evening of each order's day."""
    second = F.lit(64800) + F.floor(portable_draw("o_orderkey") * 7200)
    return t.orders.select("o_orderkey", at_second(F.col("o_orderdate").cast("date"), second).alias("processed_at"))
