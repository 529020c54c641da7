"""Data checks on the given tables: the offending rows of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import money, periods_per_month
from ..operators import quality as q
from ..plans import checks
from . import roles
from .base import Tables, cte, query
from .joins import employments_by_country


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows_per_key FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_keys(t: Tables) -> DataFrame:
    return q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"], where=F.col("l_returnflag") != "N")


@query("not_null_violations", "SELECT employment_id, hire_date FROM r_employment WHERE contract_type IS NULL")
def not_null_violations(t: Tables) -> DataFrame:
    return q.not_null_violations(roles.employment(t), "contract_type").select("employment_id", "hire_date")


@query(
    "accepted_values",
    """
    SELECT o_orderpriority AS value_field, count(*) AS n_records FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1
    """,
)
def accepted_values(t: Tables) -> DataFrame:
    return q.accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query(
    "fk_violations",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')
    """,
)
def fk_violations(t: Tables) -> DataFrame:
    """Lines whose order is not among the open and finished ones."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return q.fk_violations(lines, "l_orderkey", t.orders.where("o_orderstatus <> 'P'"), "o_orderkey")


@query(
    "reconcile_counts",
    """
    SELECT s.n AS staging_rows, f.n AS mart_rows
    FROM (SELECT count(*) AS n FROM r_settlement) s CROSS JOIN (SELECT count(*) AS n FROM m_fct_settlement) f WHERE s.n <> f.n
    """,
)
def reconcile_counts(t: Tables) -> DataFrame:
    """Settlements lost on the way to the mart: those without lines."""
    return q.reconcile_counts(roles.settlement(t), roles.fct_settlement(t))


@query(
    "only_approved",
    """
    SELECT f.employment_id, f.absence_date, f.absence_id, 'CANCELLED' AS status FROM m_fct_absence_day f WHERE f.absence_id % 500 = 1
    """,
)
def only_approved(t: Tables) -> DataFrame:
    """Days in the mart whose absence was cancelled since it was built."""
    since = F.when(F.col("absence_id") % 500 == 1, "CANCELLED").otherwise(F.col("status"))
    return checks.not_approved(roles.fct_absence_day(t), roles.absence(t).withColumn("status", since))


@query(
    "absence_outside",
    """
    SELECT a.absence_id, a.employment_id, a.start_date, a.end_date, e.hire_date, e.termination_date
    FROM r_absence a JOIN r_employment e USING (employment_id)
    WHERE a.status = 'APPROVED' AND (a.start_date < e.hire_date OR (e.termination_date IS NOT NULL AND a.end_date > e.termination_date))
    """,
)
def absence_outside(t: Tables) -> DataFrame:
    return checks.absence_outside_employment(roles.absence(t), roles.employment(t))


cte(
    "r_share",
    """
    SELECT country_code, CAST(CASE WHEN country_no % 2 = 0 THEN 0.01 ELSE 0.07 END AS DOUBLE) AS employee_share FROM r_country
    """,
)


@query(
    "share_deviation",
    """
    SELECT a.country_code, a.actual_share, s.employee_share
    FROM (SELECT d.country_code, CAST(count(DISTINCT e.employee_id) AS DOUBLE) / sum(count(DISTINCT e.employee_id)) OVER () AS actual_share
          FROM r_employment e JOIN r_department d USING (department_id) GROUP BY 1) a
    JOIN r_share s USING (country_code) WHERE abs(a.actual_share - s.employee_share) > 0.02
    """,
)
def share_deviation(t: Tables) -> DataFrame:
    shares = roles.country(t).select(
        "country_code", F.when(F.col("country_no") % 2 == 0, 0.01).otherwise(0.07).alias("employee_share")
    )
    return q.share_deviation(employments_by_country(t), "country_code", "employee_id", shares, "employee_share", 0.02)


@query(
    "range_check",
    """
    SELECT e.employment_id, d.country_code, e.monthly_salary AS hire_salary, 1100 + 100 * (c.country_no % 3) AS salary_min, 1400 AS salary_max
    FROM r_employment e JOIN r_department d USING (department_id) JOIN r_country c USING (country_code)
    WHERE e.monthly_salary NOT BETWEEN 1100 + 100 * (c.country_no % 3) AND 1400
    """,
)
def range_check(t: Tables) -> DataFrame:
    profile = roles.country(t).select(
        "country_code", (1100 + 100 * (F.col("country_no") % 3)).alias("salary_min"), F.lit(1400).alias("salary_max")
    )
    hired = employments_by_country(t).select("employment_id", "country_code", F.col("monthly_salary").alias("hire_salary"))
    return checks.outside_range(hired, profile, "country_code", "hire_salary", "salary_min", "salary_max")


@query(
    "age_at_hire",
    """
    SELECT * FROM (
      SELECT p.employee_id, p.birth_date, h.hire_date,
             CAST(year(h.hire_date) - year(p.birth_date)
                  - CASE WHEN p.birth_date + to_years(CAST(year(h.hire_date) - year(p.birth_date) AS INTEGER)) > h.hire_date THEN 1 ELSE 0 END
                  AS INTEGER) AS age_at_hire
      FROM r_employee p JOIN (SELECT employee_id, min(hire_date) AS hire_date FROM r_employment GROUP BY 1) h USING (employee_id)
      WHERE p.birth_date IS NOT NULL)
    WHERE age_at_hire NOT BETWEEN 18 AND 55
    """,
)
def age_at_hire(t: Tables) -> DataFrame:
    """People outside 18 to 55 at their first hire."""
    return checks.age_at_hire_outside(roles.employee(t), roles.employment(t))


@query(
    "null_share",
    """
    SELECT round(null_share, 6) AS null_share FROM (SELECT avg(CASE WHEN birth_date IS NULL THEN 1.0 ELSE 0.0 END) AS null_share FROM r_employee)
    WHERE null_share NOT BETWEEN 0.0 AND 0.02
    """,
)
def null_share(t: Tables) -> DataFrame:
    """Share of missing birth dates, if it is out of bounds."""
    share = checks.null_share(roles.employee(t), "birth_date", 0.0, 0.02)
    return share.select(F.round("null_share", 6).alias("null_share"))


@query(
    "audit_coherence",
    """
    SELECT employment_id, created_at, updated_at, termination_date
    FROM (SELECT * REPLACE (CASE WHEN employment_id % 50 = 3 THEN updated_at - INTERVAL 1 DAY ELSE updated_at END AS updated_at) FROM r_employment)
    WHERE updated_at < created_at OR (termination_date IS NOT NULL AND termination_date <> CAST(updated_at AS DATE))
    """,
)
def audit_coherence(t: Tables) -> DataFrame:
    early = F.when(F.col("employment_id") % 50 == 3, F.col("updated_at") - F.expr("interval 1 day")).otherwise(F.col("updated_at"))
    return checks.audit_incoherent(roles.employment(t).withColumn("updated_at", early)).select(
        "employment_id", "created_at", "updated_at", "termination_date"
    )


@query(
    "exactly_one",
    """
    SELECT x.employment_id, x.period_id, coalesce(s.cnt, 0) AS cnt
    FROM (SELECT e.employment_id, p.period_id FROM r_employment e JOIN r_department d USING (department_id)
          JOIN r_period p ON p.country_code = d.country_code AND p.start_date <= coalesce(e.termination_date, DATE '9999-12-31')
           AND p.end_date >= e.hire_date) x
    LEFT JOIN (SELECT employment_id, period_id, count(*) AS cnt FROM r_base_movement JOIN r_concept USING (concept_id)
               WHERE concept_code = 'P001' GROUP BY 1, 2) s USING (employment_id, period_id)
    WHERE coalesce(s.cnt, 0) <> 1
    """,
)
def exactly_one(t: Tables) -> DataFrame:
    """Active periods without exactly one base-pay movement."""
    return checks.base_pay_not_once(
        employments_by_country(t), roles.period(t), roles.base_movement(t), roles.concept(t)
    )


@query(
    "movement_outside",
    """
    SELECT m.movement_id, m.employment_id, m.period_id, d.country_code, p.country_code AS period_country
    FROM r_line_movement m JOIN r_employment e USING (employment_id) JOIN r_department d USING (department_id) JOIN r_period p USING (period_id)
    WHERE p.country_code <> d.country_code OR p.end_date < e.hire_date + 60 OR p.start_date > e.termination_date - 60
    """,
)
def movement_outside(t: Tables) -> DataFrame:
    """Movements outside their employment, here one that starts 60 days later and ends 60 days earlier."""
    shorter = employments_by_country(t).withColumns(
        {"hire_date": F.date_add("hire_date", 60), "termination_date": F.date_sub("termination_date", 60)}
    )
    return checks.movement_outside_employment(roles.line_movement(t), shorter, roles.period(t))


@query(
    "month_rule",
    """
    SELECT m.movement_id, pc.country_code, pc.concept_code, p.start_date
    FROM r_line_movement m JOIN r_concept pc USING (concept_id) JOIN r_period p USING (period_id)
    WHERE pc.concept_code = 'P003' AND month(p.start_date) NOT IN (6, 12)
    """,
)
def month_rule(t: Tables) -> DataFrame:
    """Movements of a concept bound to June and December in any other month."""
    codes = F.array(*[F.struct(F.lit("P003").alias("concept_code"), F.lit(mth).alias("pay_month")) for mth in (6, 12)])
    plain = F.array(F.struct(F.lit("P002").alias("concept_code"), F.lit(None).cast("int").alias("pay_month")))
    rules = roles.country(t).select("country_code", F.explode(F.concat(codes, plain)).alias("r")).select("country_code", "r.*")
    return checks.out_of_month(roles.line_movement(t), roles.concept(t), roles.period(t), rules)


@query(
    "salary_reconstructible",
    """
    SELECT e.employment_id, e.monthly_salary, CAST(l.amount * CASE c.pay_frequency WHEN 'BIWEEKLY' THEN 2 ELSE 1 END AS DECIMAL(18,2)) AS last_paid_monthly
    FROM r_employment e JOIN r_department d USING (department_id) JOIN r_country c USING (country_code)
    JOIN (SELECT m.employment_id, m.amount FROM r_base_movement m JOIN r_concept pc USING (concept_id) JOIN r_period p USING (period_id)
          WHERE pc.concept_code = 'P001'
          QUALIFY row_number() OVER (PARTITION BY m.employment_id ORDER BY p.start_date DESC) = 1) l USING (employment_id)
    WHERE e.termination_date IS NULL
      AND abs(l.amount * CASE c.pay_frequency WHEN 'BIWEEKLY' THEN 2 ELSE 1 END - e.monthly_salary) > 0.05
    """,
)
def salary_reconstructible(t: Tables) -> DataFrame:
    """Active employments whose last base pay does not give today's salary."""
    employments = employments_by_country(t).join(
        roles.country(t).select("country_code", periods_per_month("pay_frequency").alias("periods_per_month")), "country_code"
    )
    return checks.salary_not_reconstructible(
        employments, roles.base_movement(t), roles.concept(t), roles.period(t)
    )


@query(
    "volume_check",
    "SELECT count(*) AS total_movements FROM r_line_movement HAVING count(*) NOT BETWEEN 4000000 AND 6000000",
)
def volume_check(t: Tables) -> DataFrame:
    return checks.volume_outside(roles.line_movement(t), 4_000_000, 6_000_000)


@query(
    "exactly_one_child",
    """
    SELECT e.employment_id, e.termination_date, count(s.settlement_id) AS settlements
    FROM r_employment e LEFT JOIN r_settlement s USING (employment_id) GROUP BY 1, 2
    HAVING (e.termination_date IS NOT NULL AND count(s.settlement_id) <> 1) OR (e.termination_date IS NULL AND count(s.settlement_id) > 0)
    """,
)
def exactly_one_child(t: Tables) -> DataFrame:
    """Terminated employments without exactly one settlement, active ones with any."""
    return checks.settlements_not_once(roles.employment(t), roles.settlement(t))


@query(
    "settlement_delay",
    """
    SELECT s.settlement_id, e.termination_date, s.settlement_date FROM r_settlement s JOIN r_employment e USING (employment_id)
    WHERE s.settlement_date < e.termination_date OR s.settlement_date > e.termination_date + 15
    """,
)
def settlement_delay(t: Tables) -> DataFrame:
    return checks.settlement_delayed(roles.settlement(t), roles.employment(t))


cte(
    "r_composition",
    """
    SELECT s.settlement_id, e.termination_reason, sum(CASE WHEN pc.concept_code = 'F001' THEN 1 ELSE 0 END) AS f001,
           sum(CASE WHEN pc.concept_code = 'F002' THEN 1 ELSE 0 END) AS f002, sum(CASE WHEN pc.concept_code = 'D002' THEN 1 ELSE 0 END) AS d002
    FROM r_settlement s JOIN r_employment e USING (employment_id)
    LEFT JOIN r_settlement_line sl USING (settlement_id) LEFT JOIN r_concept pc USING (concept_id)
    GROUP BY 1, 2
    """,
)


@query(
    "composition_check",
    """
    SELECT settlement_id, termination_reason, CAST(f001 AS BIGINT) AS f001, CAST(f002 AS BIGINT) AS f002, CAST(d002 AS BIGINT) AS d002
    FROM r_composition
    WHERE f002 <> 1 OR d002 <> 1 OR (termination_reason = 'DISMISSAL' AND f001 <> 1) OR (termination_reason <> 'DISMISSAL' AND f001 > 0)
    """,
)
def composition_check(t: Tables) -> DataFrame:
    """Settlements without one vacation and one security line, or with a wrong indemnity."""
    return checks.settlement_miscomposed(
        roles.settlement(t), roles.employment(t), roles.settlement_line(t), roles.concept(t)
    )


@query(
    "status_check",
    """
    SELECT s.settlement_id, s.status, e.termination_date, s.created_at, s.updated_at
    FROM r_settlement s JOIN r_employment e USING (employment_id)
    WHERE s.updated_at < s.created_at OR (s.status = 'DRAFT' AND e.termination_date <= DATE '2001-08-31' - 30)
       OR (s.status <> 'DRAFT' AND e.termination_date > DATE '2001-08-31' - 30)
    """,
)
def status_check(t: Tables) -> DataFrame:
    return checks.status_incoherent(roles.settlement(t), roles.employment(t), F.lit("2001-08-31").cast("date"))


@query(
    "indemnity_ratio",
    """
    SELECT s.settlement_id, sl.settlement_line_id, sl.amount, e.monthly_salary
    FROM r_settlement_line sl JOIN r_concept pc USING (concept_id) JOIN r_settlement s USING (settlement_id)
    JOIN r_employment e USING (employment_id)
    WHERE pc.concept_code = 'F001' AND sl.amount / e.monthly_salary NOT BETWEEN 0.999 AND 12.001
    """,
)
def indemnity_ratio(t: Tables) -> DataFrame:
    """Indemnities outside one to twelve salaries."""
    return checks.indemnity_out_of_ratio(
        roles.settlement(t), roles.settlement_line(t), roles.concept(t), roles.employment(t)
    ).select("settlement_id", "settlement_line_id", money("amount").alias("amount"), "monthly_salary")


@query(
    "quality_gate",
    """
    WITH g AS (
      SELECT 'employment_id_unique' AS check_name, 'error' AS severity,
             (SELECT count(*) FROM (SELECT employment_id FROM r_employment GROUP BY 1 HAVING count(*) > 1)) AS violations
      UNION ALL SELECT 'contract_type_not_null', 'warn', (SELECT count(*) FROM r_employment WHERE contract_type IS NULL)
      UNION ALL SELECT 'absence_type_accepted', 'error', (SELECT count(DISTINCT absence_type) FROM r_absence WHERE absence_type NOT IN ('VACATION', 'SICK_LEAVE'))
      UNION ALL SELECT 'settlement_employment_exists', 'error',
             (SELECT count(*) FROM r_settlement WHERE employment_id NOT IN (SELECT employment_id FROM r_employment))
      UNION ALL SELECT 'current_version_unique', 'error',
             (SELECT count(*) FROM (SELECT employment_id FROM m_dim_employee WHERE is_current GROUP BY 1 HAVING count(*) > 1))
      UNION ALL SELECT 'settlement_once', 'error', (SELECT count(*) FROM (SELECT 1 WHERE (SELECT count(*) FROM r_settlement) <> (SELECT count(*) FROM m_fct_settlement))))
    SELECT *, CASE WHEN violations = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail' ELSE 'warn' END AS outcome FROM g
    """,
)
def quality_gate(t: Tables) -> DataFrame:
    """One row per check with its severity, offending rows and outcome."""
    employment, settlement = roles.employment(t), roles.settlement(t)
    return q.passes(
        q.quality_report(
            [
                q.Check("employment_id_unique", q.duplicate_keys(employment, ["employment_id"])),
                q.Check("contract_type_not_null", q.not_null_violations(employment, "contract_type"), "warn"),
                q.Check("absence_type_accepted", q.accepted_values(roles.absence(t), "absence_type", ["VACATION", "SICK_LEAVE"])),
                q.Check("settlement_employment_exists", q.fk_violations(settlement, "employment_id", employment, "employment_id")),
                q.Check(
                    "current_version_unique",
                    q.duplicate_keys(roles.dim_employee(t), ["employment_id"], where=F.col("is_current")),
                ),
                q.Check("settlement_once", q.reconcile_counts(settlement, roles.fct_settlement(t))),
            ]
        )
    )
