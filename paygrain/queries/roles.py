"""The payroll relations, read off the given tables.

nation is the country, nation x market segment the department, customer the employment
(every tenth is a rehire), a customer's first order of a month the base pay of that
month, lineitem the other pay movements and the settlement lines, orders the settlements
and absences. Each role is a lazy DataFrame in the shape of its staging relation; the
sub-selects named r_... give DuckDB the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import at_second, month_start
from ..functions.money import money, periods_per_month
from ..functions.text import normalize_text
from ..operators.calendar import pay_periods
from ..operators.skew import ROWS_PER_TASK, hot_keys
from ..plans import marts
from .base import Tables, cte, role

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
CONCEPTS = [
    ("P001", "EARNING"),
    ("P002", "EARNING"),
    ("P003", "EARNING"),
    ("D001", "DEDUCTION"),
    ("D002", "DEDUCTION"),
    ("F001", "EARNING"),
    ("F002", "EARNING"),
]


@role
def country(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_name").alias("country_code"),
        F.concat(F.lit("Country "), F.col("n_nationkey").cast("string")).alias("country_name"),
        F.concat(F.lit("CUR"), F.col("n_regionkey").cast("string")).alias("currency_code"),
        F.when(F.col("n_regionkey") % 2 == 0, "BIWEEKLY").otherwise("MONTHLY").alias("pay_frequency"),
        F.col("n_nationkey").alias("country_no"),
    )


cte(
    "r_country",
    """
    SELECT n_name AS country_code, 'Country ' || n_nationkey AS country_name, 'CUR' || n_regionkey AS currency_code,
           CASE WHEN n_regionkey % 2 = 0 THEN 'BIWEEKLY' ELSE 'MONTHLY' END AS pay_frequency,
           n_nationkey AS country_no
    FROM nation
    """,
)


@role
def department(t: Tables) -> DataFrame:
    names = F.array(*[F.lit(s) for s in SEGMENTS])
    return country(t).select(
        "country_code", "country_no", F.posexplode(names).alias("_i", "department_name")
    ).select(
        (F.col("country_no") * len(SEGMENTS) + F.col("_i")).alias("department_id"), "country_code", "department_name"
    )


cte(
    "r_department",
    """
    SELECT country_no * 5 + s.i AS department_id, country_code, s.department_name
    FROM r_country
    CROSS JOIN (VALUES (0, 'AUTOMOBILE'), (1, 'BUILDING'), (2, 'FURNITURE'), (3, 'HOUSEHOLD'), (4, 'MACHINERY'))
         AS s(i, department_name)
    """,
)


def employee_of(employment: Column) -> Column:
    """Every tenth employment is a rehire of the one nine before it."""
    return F.when(employment % 10 == 9, employment - 9).otherwise(employment)


@role
def employee(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1960-01-01").cast("date"), (key * 37 % 12000).cast("int"))
    return t.people.where(key % 10 != 9).select(
        key.alias("employee_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.when(key % 33 != 0, born).alias("birth_date"),
    )


cte(
    "r_employee",
    """
    SELECT c_custkey AS employee_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
           CASE WHEN c_custkey % 33 <> 0 THEN DATE '1960-01-01' + CAST(c_custkey * 37 % 12000 AS INTEGER) END AS birth_date
    FROM customer WHERE c_custkey % 10 <> 9
    """,
)


def contract_text() -> Column:
    """Contract type as the source has it: some in lower case with a blank, some missing."""
    slot = F.col("c_custkey") % 20
    return (
        F.when(slot == 0, "TEMPORARY").when(slot == 1, "temporary ").when(slot == 2, None).otherwise("INDEFINITE")
    )


@role
def employment(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    spans = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("_first"), F.max("o_orderdate").cast("date").alias("_last")
    )
    hired = F.date_sub("_first", (key % 2 * 40).cast("int"))
    left = F.when(key % 3 == 0, F.date_add("_last", 10))
    reason = F.when(key % 9 == 0, "RESIGNATION").when(key % 9 == 3, "DISMISSAL").when(key % 9 == 6, "END_OF_CONTRACT")
    seconds = (32400 + key % 32400).cast("int")
    # A segment that is not listed has no department: the id is NULL, and the reference check finds it.
    segment = F.nullif(F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("c_mktsegment")), F.lit(0)) - 1
    return t.customer.join(spans, key == F.col("o_custkey")).select(
        key.alias("employment_id"),
        employee_of(key).alias("employee_id"),
        (F.col("c_nationkey") * len(SEGMENTS) + segment).cast("int").alias("department_id"),
        F.concat(F.lit("Role "), (key % 8).cast("string")).alias("job_title"),
        money(1000 + 100 * (key % 5 + 1)).alias("monthly_salary"),
        hired.alias("hire_date"),
        left.alias("termination_date"),
        reason.alias("termination_reason"),
        normalize_text(contract_text()).alias("contract_type"),
        at_second(hired, seconds).alias("created_at"),
        at_second(F.coalesce(left, hired), seconds).alias("updated_at"),
    )


cte(
    "r_employment",
    """
    SELECT *, CAST(hire_date AS TIMESTAMP) + to_seconds(_sec) AS created_at,
           CAST(coalesce(termination_date, hire_date) AS TIMESTAMP) + to_seconds(_sec) AS updated_at
    FROM (
      SELECT c_custkey AS employment_id,
             CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 9 ELSE c_custkey END AS employee_id,
             CAST(c_nationkey * 5 + list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'],
                                                  c_mktsegment) - 1 AS INTEGER) AS department_id,
             'Role ' || (c_custkey % 8) AS job_title,
             CAST(1000 + 100 * (c_custkey % 5 + 1) AS DECIMAL(18,2)) AS monthly_salary,
             _first - CAST(c_custkey % 2 * 40 AS INTEGER) AS hire_date,
             CASE WHEN c_custkey % 3 = 0 THEN _last + 10 END AS termination_date,
             CASE c_custkey % 9 WHEN 0 THEN 'RESIGNATION' WHEN 3 THEN 'DISMISSAL' WHEN 6 THEN 'END_OF_CONTRACT' END
               AS termination_reason,
             CASE c_custkey % 20 WHEN 0 THEN 'TEMPORARY' WHEN 1 THEN 'TEMPORARY' WHEN 2 THEN NULL ELSE 'INDEFINITE' END
               AS contract_type,
             32400 + c_custkey % 32400 AS _sec
      FROM customer
      JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS _first, CAST(max(o_orderdate) AS DATE) AS _last
            FROM orders GROUP BY 1) ON o_custkey = c_custkey
    )
    """,
)


@role
def concept(t: Tables) -> DataFrame:
    kinds = F.array(*[F.struct(F.lit(c).alias("concept_code"), F.lit(k).alias("concept_type")) for c, k in CONCEPTS])
    return country(t).select("country_code", "country_no", F.posexplode(kinds).alias("_i", "_c")).select(
        (F.col("country_no") * 10 + F.col("_i") + 1).alias("concept_id"),
        "country_code",
        "_c.concept_code",
        F.concat(F.lit("Concept "), F.col("_c.concept_code")).alias("concept_name"),
        "_c.concept_type",
    )


cte(
    "r_concept",
    """
    SELECT country_no * 10 + i AS concept_id, country_code, concept_code, 'Concept ' || concept_code AS concept_name, concept_type
    FROM r_country
    CROSS JOIN (VALUES (1, 'P001', 'EARNING'), (2, 'P002', 'EARNING'), (3, 'P003', 'EARNING'), (4, 'D001', 'DEDUCTION'),
                       (5, 'D002', 'DEDUCTION'), (6, 'F001', 'EARNING'), (7, 'F002', 'EARNING'))
         AS c(i, concept_code, concept_type)
    """,
)


def period_no(country_no: Column, day: Column, half: Column) -> Column:
    return (country_no * 10_000_000 + F.year(day) * 1000 + F.month(day) * 10 + half).cast("int")


def order_span(t: Tables) -> tuple[Column, Column]:
    """First and last order date as scalar subqueries."""
    day = F.col("o_orderdate").cast("date")
    span = t.dated_orders.agg(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi")).alias("span")).scalar()
    return span["lo"], span["hi"]


@role
def period(t: Tables) -> DataFrame:
    first, last = order_span(t)
    calendar = pay_periods(country(t), first, last)
    return calendar.select(
        period_no(F.col("country_no"), F.col("start_date"), F.col("half")).alias("period_id"),
        "country_code",
        "start_date",
        "end_date",
        "pay_date",
    )


cte(
    "r_period",
    """
    SELECT CAST(country_no * 10000000 + year(start_date) * 1000 + month(start_date) * 10 + half AS INTEGER) AS period_id,
           country_code, start_date, end_date, end_date AS pay_date
    FROM (
      SELECT country_no, country_code, half,
             CAST(CASE half WHEN 1 THEN m ELSE m + INTERVAL 15 DAY END AS DATE) AS start_date,
             CAST(CASE WHEN pay_frequency = 'BIWEEKLY' AND half = 1 THEN m + INTERVAL 14 DAY ELSE last_day(m) END AS DATE) AS end_date
      FROM r_country
      CROSS JOIN (SELECT CAST(g AS DATE) AS m
                  FROM (SELECT date_trunc('month', min(o_orderdate)) AS lo, max(o_orderdate) AS hi FROM orders) AS b,
                       LATERAL generate_series(b.lo, b.hi, INTERVAL 1 MONTH) AS s(g)) AS months
      CROSS JOIN (VALUES (1), (2)) AS h(half)
      WHERE half = 1 OR pay_frequency = 'BIWEEKLY'
    )
    """,
)


@role
def base_movement(t: Tables) -> DataFrame:
    """Base pay: one row per customer and month of orders.

    The group is (customer, month), with partial minimums before the shuffle, so even a
    customer with a very large share of the orders sends few rows. The priority digit
    rides in the last place of the order key, which keeps the minimum a plain number.
    """
    digit = F.substring("o_orderpriority", 1, 1).cast("long")
    monthly = t.orders.groupBy("o_custkey", month_start(F.col("o_orderdate").cast("date")).alias("_month")).agg(
        F.min(F.col("o_orderkey") * 10 + digit).alias("_first")
    )
    home = t.customer.join(
        country(t).select(F.col("country_no").alias("c_nationkey"), "pay_frequency"), "c_nationkey"
    ).select("c_custkey", "c_nationkey", periods_per_month("pay_frequency").alias("_times"))
    return monthly.join(home, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("B-"), F.col("o_custkey").cast("string"), F.lit("-"), F.date_format("_month", "yyyyMM")).alias(
            "movement_id"
        ),
        F.col("o_custkey").alias("employment_id"),
        period_no(F.col("c_nationkey"), F.col("_month"), F.lit(1)).alias("period_id"),
        (F.col("c_nationkey") * 10 + 1).alias("concept_id"),
        money((1000 + 100 * (F.col("_first") % 10)) / F.col("_times")).alias("amount"),
        F.col("_month").cast("timestamp_ntz").alias("updated_at"),
    )


cte(
    "r_base_movement",
    """
    SELECT 'B-' || o_custkey || '-' || strftime(m, '%Y%m') AS movement_id, o_custkey AS employment_id,
           CAST(c_nationkey * 10000000 + year(m) * 1000 + month(m) * 10 + 1 AS INTEGER) AS period_id, c_nationkey * 10 + 1 AS concept_id,
           CAST((1000 + 100 * digit) / (CASE pay_frequency WHEN 'BIWEEKLY' THEN 2 ELSE 1 END) AS DECIMAL(18,2)) AS amount,
           CAST(m AS TIMESTAMP) AS updated_at
    FROM (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
                 CAST(substr(arg_min(o_orderpriority, o_orderkey), 1, 1) AS INTEGER) AS digit
          FROM orders GROUP BY 1, 2)
    JOIN customer ON c_custkey = o_custkey
    JOIN r_country ON country_no = c_nationkey
    """,
)


@role
def line_movement(t: Tables) -> DataFrame:
    """The other pay movements: order lines, paid in the period of their order.

    The orders meet their customers before they meet the lines, so that no two joins of
    the lines in a row share a key: each can be split on its own if a key is hot.
    """
    home = t.customer.join(
        country(t).select(F.col("country_no").alias("c_nationkey"), "pay_frequency"), "c_nationkey"
    ).select("c_custkey", "c_nationkey", "pay_frequency")
    day = F.col("o_orderdate").cast("date")
    half = F.when((F.col("pay_frequency") == "BIWEEKLY") & (F.dayofmonth(day) > 15), 2).otherwise(1)
    placed = t.orders.join(home, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "c_nationkey", period_no(F.col("c_nationkey"), day, half).alias("period_id")
    )
    kind = F.when(F.col("l_returnflag") == "A", 2).when(F.col("l_returnflag") == "R", 3).otherwise(4)
    return t.lineitem.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        line_id().alias("movement_id"),
        F.col("o_custkey").alias("employment_id"),
        "period_id",
        (F.col("c_nationkey") * 10 + kind).alias("concept_id"),
        money("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("updated_at"),
    )


@role
def busy_employments(t: Tables) -> DataFrame:
    """Customers with more order lines than one task should take, judged by their orders at four lines each.

    The lines themselves are then read and shuffled once, for the fact.
    """
    placed = t.orders.select(F.col("o_custkey").alias("employment_id"))
    return hot_keys(placed, "employment_id", rows_per_task=ROWS_PER_TASK // 4)


def line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


cte(
    "r_line_movement",
    """
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS movement_id, o_custkey AS employment_id,
           CAST(c_nationkey * 10000000 + year(o_orderdate) * 1000 + month(o_orderdate) * 10
             + CASE WHEN pay_frequency = 'BIWEEKLY' AND day(o_orderdate) > 15 THEN 2 ELSE 1 END AS INTEGER) AS period_id,
           c_nationkey * 10 + CASE l_returnflag WHEN 'A' THEN 2 WHEN 'R' THEN 3 ELSE 4 END AS concept_id,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_shipdate AS updated_at
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN r_country ON country_no = c_nationkey
    """,
)


@role
def settlement(t: Tables) -> DataFrame:
    """Orders of customers who left; several per employment, which the checks must notice."""
    status = F.when(F.col("o_orderstatus") == "O", "DRAFT").when(F.col("o_orderstatus") == "F", "PAID").otherwise("CANCELLED")
    return t.orders.where(F.col("o_custkey") % 3 == 0).select(
        F.col("o_orderkey").alias("settlement_id"),
        F.col("o_custkey").alias("employment_id"),
        F.col("o_orderdate").cast("date").alias("settlement_date"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.date_sub(F.col("o_orderdate").cast("date"), F.when(F.col("o_orderkey") % 40 == 7, 1).otherwise(0))
        .cast("timestamp_ntz")
        .alias("updated_at"),
    )


cte(
    "r_settlement",
    """
    SELECT o_orderkey AS settlement_id, o_custkey AS employment_id, CAST(o_orderdate AS DATE) AS settlement_date,
           CASE o_orderstatus WHEN 'O' THEN 'DRAFT' WHEN 'F' THEN 'PAID' ELSE 'CANCELLED' END AS status,
           o_orderdate AS created_at,
           CAST(CAST(o_orderdate AS DATE) - CASE WHEN o_orderkey % 40 = 7 THEN 1 ELSE 0 END AS TIMESTAMP) AS updated_at
    FROM orders WHERE o_custkey % 3 = 0
    """,
)


@role
def settlement_line(t: Tables) -> DataFrame:
    """Order lines under the settlement concepts of country 0."""
    kind = F.when(F.col("l_returnflag") == "A", 7).when(F.col("l_returnflag") == "R", 6).otherwise(5)
    return t.lineitem.select(
        line_id().alias("settlement_line_id"),
        F.col("l_orderkey").alias("settlement_id"),
        kind.alias("concept_id"),
        money("l_extendedprice").alias("amount"),
    )


cte(
    "r_settlement_line",
    """
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS settlement_line_id,
           l_orderkey AS settlement_id, CASE l_returnflag WHEN 'A' THEN 7 WHEN 'R' THEN 6 ELSE 5 END AS concept_id,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
    FROM lineitem
    """,
)


@role
def absence(t: Tables) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    kind = F.when(key % 3 == 0, "VACATION").when(key % 3 == 1, "SICK_LEAVE").otherwise("UNJUSTIFIED")
    return t.orders.select(
        key.alias("absence_id"),
        F.col("o_custkey").alias("employment_id"),
        kind.alias("absence_type"),
        day.alias("start_date"),
        F.date_add(day, (key % 45).cast("int")).alias("end_date"),
        F.when(F.col("o_orderstatus") == "P", "CANCELLED").otherwise("APPROVED").alias("status"),
    )


cte(
    "r_absence",
    """
    SELECT o_orderkey AS absence_id, o_custkey AS employment_id,
           CASE o_orderkey % 3 WHEN 0 THEN 'VACATION' WHEN 1 THEN 'SICK_LEAVE' ELSE 'UNJUSTIFIED' END AS absence_type,
           CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INTEGER) AS end_date,
           CASE o_orderstatus WHEN 'P' THEN 'CANCELLED' ELSE 'APPROVED' END AS status
    FROM orders
    """,
)


# The marts over these roles, and their SQL twins m_...


@role
def dim_concept(t: Tables) -> DataFrame:
    return marts.dim_concept(concept(t))


cte(
    "m_dim_concept",
    """
    SELECT concept_id AS concept_key, country_code, concept_code, concept_name, concept_type,
           CASE concept_type WHEN 'EARNING' THEN 1 ELSE -1 END AS sign
    FROM r_concept
    """,
)


@role
def dim_employee(t: Tables) -> DataFrame:
    return marts.dim_employee(
        base_movement(t), concept(t), period(t), country(t), employment(t), employee(t), department(t)
    )


cte(
    "m_salary",
    """
    SELECT m.employment_id, p.start_date AS period_start,
           CAST(m.amount * CASE c.pay_frequency WHEN 'BIWEEKLY' THEN 2 ELSE 1 END AS DECIMAL(18,2)) AS monthly_salary
    FROM r_base_movement m
    JOIN r_concept pc ON pc.concept_id = m.concept_id AND pc.concept_code = 'P001'
    JOIN r_period p ON p.period_id = m.period_id
    JOIN r_country c ON c.country_code = p.country_code
    """,
)
cte(
    "m_version",
    """
    SELECT employment_id, CAST(version AS INTEGER) AS version, monthly_salary, min(period_start) AS first_period_start
    FROM (SELECT *, sum(chg) OVER (PARTITION BY employment_id ORDER BY period_start ROWS UNBOUNDED PRECEDING) AS version
          FROM (SELECT *, CASE WHEN monthly_salary = lag(monthly_salary) OVER (PARTITION BY employment_id ORDER BY period_start)
                               THEN 0 ELSE 1 END AS chg
                FROM m_salary))
    GROUP BY 1, 2, 3
    """,
)
cte(
    "m_dim_employee",
    """
    SELECT md5(concat_ws('|', v.employment_id, v.version)) AS employee_sk, v.employment_id, e.employee_id,
           p.first_name || ' ' || p.last_name AS full_name, d.country_code, d.department_name, e.job_title, e.hire_date,
           e.termination_date, e.termination_reason, coalesce(e.contract_type, 'UNKNOWN') AS contract_type, v.version,
           v.monthly_salary, v.valid_from,
           coalesce(lead(v.valid_from) OVER w - 1, DATE '9999-12-31') AS valid_to,
           lead(v.valid_from) OVER w IS NULL AS is_current,
           min(v.valid_from) OVER (PARTITION BY v.employment_id) > e.hire_date AS history_truncated
    FROM (SELECT s.*, CASE WHEN version = 1 THEN greatest(e.hire_date, first_period_start) ELSE first_period_start END AS valid_from
          FROM m_version s JOIN r_employment e USING (employment_id)) v
    JOIN r_employment e USING (employment_id)
    JOIN r_employee p ON p.employee_id = e.employee_id
    JOIN r_department d ON d.department_id = e.department_id
    WINDOW w AS (PARTITION BY v.employment_id ORDER BY v.valid_from)
    """,
)


@role
def fct_payroll_movement(t: Tables) -> DataFrame:
    return marts.fct_payroll_movement(
        line_movement(t), period(t), dim_concept(t), dim_employee(t), busy_employments(t)
    )


cte(
    "m_fct_payroll_movement",
    """
    SELECT m.movement_id, de.employee_sk, m.employment_id, m.concept_id AS concept_key, p.country_code, m.period_id,
           CAST(strftime(p.pay_date, '%Y%m%d') AS INTEGER) AS pay_date_key, m.amount,
           CAST(m.amount * dc.sign AS DECIMAL(18,2)) AS signed_amount, m.updated_at
    FROM r_line_movement m
    JOIN r_period p ON p.period_id = m.period_id
    JOIN r_employment e ON e.employment_id = m.employment_id
    JOIN m_dim_concept dc ON dc.concept_key = m.concept_id
    JOIN m_dim_employee de ON de.employment_id = m.employment_id
     AND greatest(p.start_date, e.hire_date) BETWEEN de.valid_from AND de.valid_to
    """,
)


@role
def fct_settlement(t: Tables) -> DataFrame:
    return marts.fct_settlement(
        settlement(t), settlement_line(t), concept(t), employment(t), department(t), dim_employee(t)
    )


cte(
    "m_fct_settlement",
    """
    SELECT s.settlement_id, de.employee_sk, s.employment_id, d.country_code,
           CAST(strftime(e.termination_date, '%Y%m%d') AS INTEGER) AS termination_date_key,
           CAST(strftime(s.settlement_date, '%Y%m%d') AS INTEGER) AS settlement_date_key, e.termination_reason, s.status,
           CAST(sum(CASE WHEN pc.concept_code = 'F002' THEN sl.amount ELSE 0 END) AS DECIMAL(18,2)) AS vacation_amount,
           CAST(sum(CASE WHEN pc.concept_code = 'F001' THEN sl.amount ELSE 0 END) AS DECIMAL(18,2)) AS indemnity_amount,
           CAST(sum(CASE WHEN pc.concept_type = 'DEDUCTION' THEN sl.amount ELSE 0 END) AS DECIMAL(18,2)) AS deductions_amount,
           CAST(sum(sl.amount * CASE pc.concept_type WHEN 'EARNING' THEN 1 ELSE -1 END) AS DECIMAL(18,2)) AS net_amount
    FROM r_settlement s
    JOIN r_employment e USING (employment_id)
    JOIN r_department d ON d.department_id = e.department_id
    JOIN r_settlement_line sl ON sl.settlement_id = s.settlement_id
    JOIN r_concept pc ON pc.concept_id = sl.concept_id
    JOIN m_dim_employee de ON de.employment_id = s.employment_id AND e.termination_date BETWEEN de.valid_from AND de.valid_to
    GROUP BY ALL
    """,
)


@role
def absence_days(t: Tables) -> DataFrame:
    return marts.int_absence_days(absence(t), employment(t))


cte(
    "m_absence_day",
    """
    SELECT a.absence_id, a.employment_id, a.absence_type, CAST(g.day AS DATE) AS absence_date,
           CAST(strftime(g.day, '%Y%m%d') AS INTEGER) AS date_key
    FROM r_absence a
    CROSS JOIN LATERAL generate_series(a.start_date, a.end_date, INTERVAL 1 DAY) AS g(day)
    JOIN r_employment e ON e.employment_id = a.employment_id
    WHERE a.status = 'APPROVED' AND g.day >= e.hire_date AND (e.termination_date IS NULL OR g.day <= e.termination_date)
    """,
)


@role
def fct_absence_day(t: Tables) -> DataFrame:
    return marts.fct_absence_day(absence_days(t), dim_employee(t))


cte(
    "m_resolved",
    """
    SELECT * FROM m_absence_day
    QUALIFY row_number() OVER (PARTITION BY employment_id, absence_date
      ORDER BY CASE absence_type WHEN 'SICK_LEAVE' THEN 1 WHEN 'VACATION' THEN 2 WHEN 'UNJUSTIFIED' THEN 3 END, absence_id) = 1
    """,
)
cte(
    "m_fct_absence_day",
    """
    SELECT r.employment_id, r.absence_date, r.date_key, de.employee_sk, de.country_code, r.absence_type, r.absence_id
    FROM m_resolved r
    LEFT JOIN m_dim_employee de ON de.employment_id = r.employment_id AND r.absence_date BETWEEN de.valid_from AND de.valid_to
    """,
)
