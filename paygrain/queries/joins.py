"""Joins: equi, point in time, overlap, semi and anti, lookups by weight and position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import money
from ..operators import assign, intervals, measures, quality
from ..operators.skew import hot_keys
from . import roles
from .base import Tables, query, role


@query(
    "equi_join",
    """
    SELECT o_orderkey, o_custkey, c_name, n_name AS country_code, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    """,
)
def equi_join(t: Tables) -> DataFrame:
    homes = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", F.col("n_name").alias("country_code")
    )
    return t.orders.join(homes, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "c_name", "country_code", money("o_totalprice").alias("amount")
    )


@query(
    "point_in_time_join",
    """
    SELECT o.o_orderkey, o.o_custkey, de.employee_sk, de.version, de.monthly_salary
    FROM orders o JOIN m_dim_employee de ON de.employment_id = o.o_custkey
     AND CAST(o.o_orderdate AS DATE) BETWEEN de.valid_from AND de.valid_to
    """,
)
def point_in_time_join(t: Tables) -> DataFrame:
    """Each order with the customer's version in force on the order date."""
    placed = t.orders.select(
        "o_orderkey", F.col("o_custkey").alias("employment_id"), F.col("o_orderdate").cast("date").alias("day")
    )
    versions = roles.dim_employee(t).select(
        "employment_id", "employee_sk", "version", "monthly_salary", "valid_from", "valid_to"
    )
    hot = hot_keys(placed, "employment_id")
    return intervals.point_in_time_join(placed, versions, "employment_id", F.col("f.day"), hot=hot).select(
        "o_orderkey", F.col("employment_id").alias("o_custkey"), "employee_sk", "version", "monthly_salary"
    )


@query(
    "point_in_time_hot",
    """
    SELECT o.o_orderkey, o.o_custkey, de.employee_sk, de.version
    FROM orders o JOIN m_dim_employee de ON de.employment_id = o.o_custkey
     AND CAST(o.o_orderdate AS DATE) BETWEEN de.valid_from AND de.valid_to
    """,
)
def point_in_time_hot(t: Tables) -> DataFrame:
    """The same with a task's share set so low that many customers count as hot and are split."""
    placed = t.orders.select(
        "o_orderkey", F.col("o_custkey").alias("employment_id"), F.col("o_orderdate").cast("date").alias("day")
    )
    versions = roles.dim_employee(t).select("employment_id", "employee_sk", "version", "valid_from", "valid_to")
    hot = hot_keys(placed, "employment_id", rows_per_task=8)
    return intervals.point_in_time_join(placed, versions, "employment_id", F.col("f.day"), hot=hot).select(
        "o_orderkey", F.col("employment_id").alias("o_custkey"), "employee_sk", "version"
    )


@query(
    "point_in_time_left",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, de.employee_sk
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    LEFT JOIN m_dim_employee de ON de.employment_id = o_custkey AND CAST(l_shipdate AS DATE) BETWEEN de.valid_from AND de.valid_to
    """,
)
def point_in_time_left(t: Tables) -> DataFrame:
    """Each line with the version in force when it was shipped, if there was one."""
    shipped = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("o_custkey").alias("employment_id"),
        F.col("l_shipdate").cast("date").alias("day"),
    )
    versions = roles.dim_employee(t).select("employment_id", "employee_sk", "valid_from", "valid_to")
    hot = roles.busy_employments(t)
    return intervals.point_in_time_join(shipped, versions, "employment_id", F.col("f.day"), how="left", hot=hot).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "employee_sk"
    )


@role
def employments_by_country(t: Tables) -> DataFrame:
    return roles.employment(t).join(roles.department(t).select("department_id", "country_code"), "department_id")


_ACTIVE = """
    SELECT e.employment_id, d.country_code, p.period_id, p.start_date, p.end_date
    FROM r_employment e JOIN r_department d USING (department_id)
    JOIN r_period p ON p.country_code = d.country_code
     AND p.start_date <= coalesce(e.termination_date, DATE '9999-12-31') AND p.end_date >= e.hire_date
"""


@query("interval_overlap_join", _ACTIVE)
def interval_overlap_join(t: Tables) -> DataFrame:
    """Every employment with the pay periods of its country it was active in."""
    return intervals.interval_overlap_join(
        employments_by_country(t).select("employment_id", "country_code", "hire_date", "termination_date"),
        roles.period(t),
        "country_code",
        ("hire_date", "termination_date"),
        ("start_date", "end_date"),
    ).select("employment_id", "country_code", "period_id", "start_date", "end_date")


@query("interval_overlap_by_month", _ACTIVE)
def interval_overlap_by_month(t: Tables) -> DataFrame:
    """The same pairs with both sides cut into months, as for two large sides; the months are the periods' own."""
    periods = roles.period(t)
    first, last = periods.agg(F.min("start_date"), F.max("end_date")).first()
    return intervals.interval_overlap_join(
        employments_by_country(t).select("employment_id", "country_code", "hire_date", "termination_date"),
        periods,
        "country_code",
        ("hire_date", "termination_date"),
        ("start_date", "end_date"),
        by_month=(first, last),
    ).select("employment_id", "country_code", "period_id", "start_date", "end_date")


_CODES = ["F001", "F002", "D002"]


@query(
    "cross_join",
    """
    SELECT c_custkey, v.code, c_custkey % 7 * v.place AS score
    FROM customer CROSS JOIN (VALUES ('F001', 1), ('F002', 2), ('D002', 3)) AS v(code, place)
    """,
)
def cross_join(t: Tables) -> DataFrame:
    """Every customer with every entry of a literal list, as an exploded array."""
    codes = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(i).alias("place")) for i, c in enumerate(_CODES, start=1)])
    return t.customer.select("c_custkey", F.explode(codes).alias("v")).select(
        "c_custkey", "v.code", (F.col("c_custkey") % 7 * F.col("v.place")).alias("score")
    )


@query(
    "semi_join",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_quantity > 45)
    """,
)
def semi_join(t: Tables) -> DataFrame:
    large = t.lineitem.where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(large, "o_orderkey", "left_semi")


@query(
    "anti_join",
    "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def anti_join(t: Tables) -> DataFrame:
    """Orders without lines."""
    return quality.fk_violations(
        t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", t.lineitem, "l_orderkey"
    )


@query(
    "date_part_join",
    """
    SELECT d AS date, count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_value
    FROM events JOIN (SELECT DISTINCT CAST(l_shipdate AS DATE) + 8400 AS d FROM lineitem) ON d = CAST(ts AS DATE)
    GROUP BY d
    """,
)
def date_part_join(t: Tables) -> DataFrame:
    """Events against a calendar of days: only the date of the timestamp takes part.

    The events are summed per day first; the join then has one row per day.
    """
    days = t.lineitem.select(F.date_add(F.col("l_shipdate").cast("date"), 8400).alias("date")).distinct()
    daily = t.events.groupBy(F.col("ts").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("n_events"), money(F.sum(money("value"))).alias("total_value")
    )
    return daily.join(days, "date")


@query(
    "star_query",
    """
    SELECT c.country_name, dc.concept_code, CAST(d.year AS INTEGER) AS year, de.contract_type, count(*) AS n_movements,
           CAST(sum(f.amount) AS DECIMAL(18,2)) AS amount
    FROM m_fct_payroll_movement f
    LEFT JOIN r_country c ON c.country_code = f.country_code
    LEFT JOIN m_dim_concept dc ON dc.concept_key = f.concept_key
    LEFT JOIN (SELECT DISTINCT employee_sk, contract_type FROM m_dim_employee) de ON de.employee_sk = f.employee_sk
    LEFT JOIN (SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS k, year(o_orderdate) AS year
               FROM (SELECT CAST(end_date AS DATE) AS o_orderdate FROM r_period)) d ON d.k = f.pay_date_key
    GROUP BY ALL
    """,
)
def star_query(t: Tables) -> DataFrame:
    """The movement fact with its four dimensions."""
    from .measures import date_dim

    joined = measures.star(
        roles.fct_payroll_movement(t),
        (roles.country(t).select("country_code", "country_name"), "country_code", "country_code"),
        (roles.dim_concept(t).select("concept_key", "concept_code"), "concept_key", "concept_key"),
        (roles.dim_employee(t).select("employee_sk", "contract_type"), "employee_sk", "employee_sk"),
        (date_dim(t).select("date_key", "year"), "pay_date_key", "date_key"),
    )
    return joined.groupBy("country_name", "concept_code", "year", "contract_type").agg(
        F.count(F.lit(1)).alias("n_movements"), money(F.sum("amount")).alias("amount")
    )


_SLOTS = 1000


@query(
    "weighted_bucket",
    """
    SELECT c_custkey, draw, n_name AS country_code
    FROM (SELECT c_custkey, c_custkey * 7919 % 1000 AS draw FROM customer)
    JOIN (SELECT n_name, sum(w) OVER (ORDER BY n_name ROWS UNBOUNDED PRECEDING) - w AS lo,
                 sum(w) OVER (ORDER BY n_name ROWS UNBOUNDED PRECEDING) AS hi
          FROM (SELECT n_name, 1000 * CAST(CASE WHEN n_nationkey % 5 = 0 THEN 0.0003 ELSE n_nationkey % 5 * 0.0199 END AS DECIMAL(9,4)) AS w
                FROM nation)) ON draw >= lo AND draw < hi
    """,
)
def weighted_bucket(t: Tables) -> DataFrame:
    """Customers assigned to countries by the countries' shares, some of them narrower than a slot."""
    draws = t.customer.select("c_custkey", (F.col("c_custkey") * 7919 % _SLOTS).alias("draw"))
    share = F.expr("CAST(CASE WHEN n_nationkey % 5 = 0 THEN 0.0003 ELSE n_nationkey % 5 * 0.0199 END AS DECIMAL(9,4))")
    weights = t.nation.select(F.col("n_name").alias("country_code"), (share * _SLOTS).alias("weight"))
    return assign.weighted_bucket(draws, "draw", weights, "country_code", "weight", _SLOTS).select(
        "c_custkey", "draw", "country_code"
    )


@query(
    "nth_element",
    """
    SELECT c_custkey, s_suppkey
    FROM (SELECT c_custkey, c_nationkey, c_custkey * 7919 % 1000 AS draw FROM customer)
    JOIN (SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n,
                 count(*) OVER (PARTITION BY s_nationkey) AS size FROM supplier)
      ON s_nationkey = c_nationkey AND n = 1 + draw * size // 1000
    """,
)
def nth_element(t: Tables) -> DataFrame:
    """Each customer with one supplier of its country, chosen by position."""
    draws = t.customer.select(
        F.col("c_nationkey").alias("country_no"), "c_custkey", (F.col("c_custkey") * 7919 % _SLOTS).alias("draw")
    )
    pool = t.supplier.select(F.col("s_nationkey").alias("country_no"), "s_suppkey")
    picked = assign.nth_element(
        draws,
        pool,
        "country_no",
        "s_suppkey",
        "draw",
        _SLOTS,
        ["s_suppkey"],
        chunk=F.floor(F.col("s_suppkey") / 100_000),
    )
    return picked.select("c_custkey", "s_suppkey")
