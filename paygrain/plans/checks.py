"""Payroll checks: each returns the rows that break a rule of the model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import completed_years
from ..functions.money import money, periods_per_month
from ..operators import quality as q
from ..operators.intervals import interval_overlap_join
from ..operators.rules import DRAFT_WINDOW_DAYS, MAX_PAYMENT_DELAY_DAYS
from ..operators.sequences import latest_per_key, with_previous
from .marts import BASE_SALARY, INDEMNITY, VACATION_PAY


def not_approved(absence_days: DataFrame, absence: DataFrame) -> DataFrame:
    """Days in the mart whose absence is not approved."""
    other = absence.where("status <> 'APPROVED'").select("absence_id", "status")
    return absence_days.join(other, "absence_id").select("employment_id", "absence_date", "absence_id", "status")


def absence_outside_employment(absence: DataFrame, employment: DataFrame) -> DataFrame:
    """Approved absences that begin before the hire or end after the termination."""
    spans = employment.select("employment_id", "hire_date", "termination_date")
    early = F.col("start_date") < F.col("hire_date")
    late = F.col("termination_date").isNotNull() & (F.col("end_date") > F.col("termination_date"))
    return (
        absence.where("status = 'APPROVED'")
        .join(spans, "employment_id")
        .where(early | late)
        .select("absence_id", "employment_id", "start_date", "end_date", "hire_date", "termination_date")
    )


def outside_range(df: DataFrame, profile: DataFrame, on: str, value: str, low: str, high: str) -> DataFrame:
    """Rows whose value lies outside the range of their group."""
    return df.join(profile.select(on, low, high), on).where(~F.col(value).between(F.col(low), F.col(high)))


def null_share(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """The share of NULLs, as one row, if it is out of bounds."""
    share = F.avg(F.when(F.col(column).isNull(), 1.0).otherwise(0.0))
    return df.agg(share.alias("null_share")).where(~F.col("null_share").between(low, high))


def audit_incoherent(employment: DataFrame) -> DataFrame:
    """Rows changed before they were made, or terminated on another day than they were changed."""
    changed = F.col("updated_at")
    other_day = F.col("termination_date").isNotNull() & (F.col("termination_date") != changed.cast("date"))
    return employment.where((changed < F.col("created_at")) | other_day)


def _base_pay(movement: DataFrame, concept: DataFrame) -> DataFrame:
    return movement.join(concept.where(F.col("concept_code") == BASE_SALARY).select("concept_id"), "concept_id")


def base_pay_not_once(employments: DataFrame, period: DataFrame, movement: DataFrame, concept: DataFrame) -> DataFrame:
    """Active periods of an employment without exactly one base-pay movement."""
    expected = interval_overlap_join(
        employments.select("employment_id", "country_code", "hire_date", "termination_date"),
        period,
        "country_code",
        ("hire_date", "termination_date"),
        ("start_date", "end_date"),
    ).select("employment_id", "period_id")
    return q.exactly_one(expected, _base_pay(movement, concept), ["employment_id", "period_id"])


def movement_outside_employment(movement: DataFrame, employments: DataFrame, period: DataFrame) -> DataFrame:
    """Movements in another country's period, or in one that misses the employment's dates."""
    calendar = period.select("period_id", F.col("country_code").alias("period_country"), "start_date", "end_date")
    spans = employments.select("employment_id", "country_code", "hire_date", "termination_date")
    before = F.col("end_date") < F.col("hire_date")
    after = F.col("termination_date").isNotNull() & (F.col("start_date") > F.col("termination_date"))
    return (
        movement.select("movement_id", "employment_id", "period_id")
        .join(calendar, "period_id")
        .join(spans, "employment_id")
        .where((F.col("period_country") != F.col("country_code")) | before | after)
        .select("movement_id", "employment_id", "period_id", "country_code", "period_country")
    )


def out_of_month(movement: DataFrame, concept: DataFrame, period: DataFrame, rules: DataFrame) -> DataFrame:
    """Movements of month-bound concepts outside every month their rules allow."""
    bound = rules.where("pay_month is not null").select("country_code", "concept_code", "pay_month")
    kinds = concept.select("concept_id", "country_code", "concept_code").join(
        bound.select("country_code", "concept_code").distinct(), ["country_code", "concept_code"], "left_semi"
    )
    calendar = period.select("period_id", "start_date", F.month("start_date").alias("pay_month"))
    return (
        movement.select("movement_id", "concept_id", "period_id")
        .join(kinds, "concept_id")
        .join(calendar, "period_id")
        .join(bound, ["country_code", "concept_code", "pay_month"], "left_anti")
        .select("movement_id", "country_code", "concept_code", "start_date")
    )


def salary_not_reconstructible(
    employments: DataFrame, movement: DataFrame, concept: DataFrame, period: DataFrame, tolerance: float = 0.05
) -> DataFrame:
    """Active employments whose last base pay does not give today's salary.

    ``employments`` needs employment_id, monthly_salary, termination_date and
    periods_per_month.
    """
    paid = _base_pay(movement, concept).join(period.select("period_id", "start_date"), "period_id")
    last = latest_per_key(paid, "employment_id", [F.col("start_date").desc(), F.col("movement_id").desc()])
    monthly = money(F.col("amount") * F.col("periods_per_month"))
    return (
        employments.where("termination_date is null")
        .select("employment_id", "monthly_salary", "periods_per_month")
        .join(last.select("employment_id", "amount"), "employment_id")
        .select("employment_id", "monthly_salary", monthly.alias("last_paid_monthly"))
        .where(F.abs(F.col("last_paid_monthly") - F.col("monthly_salary")) > tolerance)
    )


def volume_outside(df: DataFrame, low: int, high: int, count_as: str = "total_movements") -> DataFrame:
    """The row count, as one row, if it is out of bounds."""
    return df.agg(F.count(F.lit(1)).alias(count_as)).where(~F.col(count_as).between(low, high))


def settlements_not_once(employment: DataFrame, settlement: DataFrame) -> DataFrame:
    """Terminated employments without exactly one settlement, active ones with any.

    The settlements are counted per employment before the join.
    """
    counts = settlement.groupBy("employment_id").agg(F.count("settlement_id").alias("_n"))
    found = F.coalesce("_n", F.lit(0).cast("long"))
    ended = F.col("termination_date").isNotNull()
    return (
        employment.select("employment_id", "termination_date")
        .join(counts, "employment_id", "left")
        .select("employment_id", "termination_date", found.alias("settlements"))
        .where((ended & (F.col("settlements") != 1)) | (~ended & (F.col("settlements") > 0)))
    )


def settlement_delayed(settlement: DataFrame, employment: DataFrame) -> DataFrame:
    """Settlements dated before the termination or more than 15 days after it."""
    ends = employment.where("termination_date is not null").select("employment_id", "termination_date")
    on_time = F.col("settlement_date").between(
        F.col("termination_date"), F.date_add("termination_date", MAX_PAYMENT_DELAY_DAYS)
    )
    return settlement.join(ends, "employment_id").where(~on_time).select(
        "settlement_id", "termination_date", "settlement_date"
    )


def settlement_miscomposed(
    settlement: DataFrame, employment: DataFrame, settlement_line: DataFrame, concept: DataFrame
) -> DataFrame:
    """Settlements without one vacation and one security line, or with a wrong indemnity.

    An indemnity belongs to dismissals and only to them.
    """
    code = F.col("concept_code")
    lines = settlement_line.join(concept.select("concept_id", "concept_code"), "concept_id")
    counts = lines.groupBy("settlement_id").agg(
        *[F.count(F.when(code == c, 1)).alias(c.lower()) for c in (INDEMNITY, VACATION_PAY, "D002")]
    )
    zero = F.lit(0).cast("long")
    composed = (
        settlement.select("settlement_id", "employment_id")
        .join(employment.select("employment_id", "termination_reason"), "employment_id")
        .join(counts, "settlement_id", "left")
        .select(
            "settlement_id",
            "termination_reason",
            *[F.coalesce(c, zero).alias(c) for c in ("f001", "f002", "d002")],
        )
    )
    dismissed = F.col("termination_reason") == "DISMISSAL"
    wrong = (dismissed & (F.col("f001") != 1)) | (~dismissed & (F.col("f001") > 0))
    return composed.where((F.col("f002") != 1) | (F.col("d002") != 1) | wrong)


def status_incoherent(settlement: DataFrame, employment: DataFrame, window_end: Column) -> DataFrame:
    """Drafts of old terminations, final states of recent ones, changes before the creation."""
    ends = employment.select("employment_id", "termination_date")
    recent = F.col("termination_date") > F.date_sub(window_end, DRAFT_WINDOW_DAYS)
    draft = F.col("status") == "DRAFT"
    backwards = F.col("updated_at") < F.col("created_at")
    return (
        settlement.join(ends, "employment_id")
        .where(backwards | (draft & ~recent) | (~draft & recent))
        .select(
            "settlement_id",
            "status",
            "termination_date",
            F.col("created_at"),
            F.col("updated_at"),
        )
    )


def indemnity_out_of_ratio(
    settlement: DataFrame, settlement_line: DataFrame, concept: DataFrame, employment: DataFrame
) -> DataFrame:
    """Indemnity lines outside 0.999 to 12.001 monthly salaries."""
    kinds = concept.where(F.col("concept_code") == INDEMNITY).select("concept_id")
    ratio = F.col("amount") / F.col("monthly_salary")
    return (
        settlement_line.join(kinds, "concept_id")
        .join(settlement.select("settlement_id", "employment_id"), "settlement_id")
        .join(employment.select("employment_id", "monthly_salary"), "employment_id")
        .withColumn("salary_months", ratio)
        .where(~F.col("salary_months").between(0.999, 12.001))
    )


def rehired_too_early(employment: DataFrame) -> DataFrame:
    """Rehires that start before the employee's previous employment ended."""
    ordered = with_previous(
        employment.select("employee_id", "employment_id", "hire_date", "termination_date"),
        "employee_id",
        ["hire_date", "employment_id"],
        {"prev_employment_id": "employment_id", "prev_termination_date": "termination_date"},
        chunk=F.trunc("hire_date", "month"),
    )
    bad = F.col("prev_termination_date").isNull() | (F.col("hire_date") <= F.col("prev_termination_date"))
    return ordered.where(F.col("prev_employment_id").isNotNull() & bad).drop("termination_date")


def age_at_hire_outside(employee: DataFrame, employment: DataFrame, low: int = 18, high: int = 55) -> DataFrame:
    """People outside an age range at their first hire; without a birth date they are not judged."""
    first = employment.groupBy("employee_id").agg(F.min("hire_date").alias("hire_date"))
    aged = (
        employee.where("birth_date is not null")
        .join(first, "employee_id")
        .select("employee_id", "birth_date", "hire_date", completed_years("birth_date", "hire_date").alias("age_at_hire"))
    )
    return aged.where(~F.col("age_at_hire").between(low, high))


def source_checks(
    s: Mapping[str, DataFrame],
    profile: DataFrame,
    rules: DataFrame,
    window_end: Column,
    movements: tuple[int, int] = (4_000_000, 6_000_000),
    severity: str = "warn",
) -> Sequence[q.Check]:
    """The tests of the source data (D-06 to D-20) on the staged relations, for the gate or on their own.

    ``profile`` has country_code, employee_share, salary_min and salary_max; ``rules`` has country_code,
    concept_code and pay_month; ``window_end`` is the last day the data was made for. Hand the result to
    ``build.transform`` as ``extra``, or to ``quality_report``.
    """
    employment, movement, concept, period = s["employment"], s["payroll_movement"], s["payroll_concept"], s["payroll_period"]
    settlement, line = s["settlement"], s["settlement_line"]
    home = s["department"].select("department_id", "country_code")
    paid_as = s["country"].select("country_code", periods_per_month("pay_frequency").alias("periods_per_month"))
    placed = employment.join(home, "department_id").join(paid_as, "country_code")
    found = {
        "country_share": q.share_deviation(placed, "country_code", "employee_id", profile, "employee_share", 0.02),
        "rehired_too_early": rehired_too_early(employment),
        "salary_in_range": outside_range(placed, profile, "country_code", "monthly_salary", "salary_min", "salary_max"),
        "age_at_hire": age_at_hire_outside(s["employee"], employment),
        "birth_date_null_share": null_share(s["employee"], "birth_date", 0.02, 0.04),
        "audit_coherence": audit_incoherent(employment),
        "base_pay_once": base_pay_not_once(placed, period, movement, concept),
        "movement_outside_employment": movement_outside_employment(movement, placed, period),
        "pay_month": out_of_month(movement, concept, period, rules),
        "salary_reconstructible": salary_not_reconstructible(placed, movement, concept, period),
        "movement_volume": volume_outside(movement, *movements),
        "settlement_once": settlements_not_once(employment, settlement),
        "settlement_delay": settlement_delayed(settlement, employment),
        "settlement_composition": settlement_miscomposed(settlement, employment, line, concept),
        "settlement_status": status_incoherent(settlement, employment, window_end),
        "indemnity_ratio": indemnity_out_of_ratio(settlement, line, concept, employment),
    }
    return [q.Check(f"source_{name}", offending, severity) for name, offending in found.items()]
