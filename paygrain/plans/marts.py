"""Dimensions and facts, each a function from staging relations to a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..functions.keys import surrogate_key
from ..functions.money import money, periods_per_month, sign_of, signed
from ..operators.intervals import clip_interval, explode_days, point_in_time_join, resolve_by_priority
from ..operators.pivots import conditional_pivot
from ..operators.sequences import islands, left_censored, validity

# Concept codes and the order in which overlapping absences win.
BASE_SALARY = "P001"
INDEMNITY, VACATION_PAY = "F001", "F002"
ABSENCE_PRIORITY = ["SICK_LEAVE", "VACATION", "UNJUSTIFIED"]


def dim_country(stg_country: DataFrame) -> DataFrame:
    return stg_country.select("country_code", "country_name", "currency_code", "pay_frequency")


def dim_concept(stg_payroll_concept: DataFrame) -> DataFrame:
    """Concepts with their sign: amounts are stored positive, deductions count negative."""
    return stg_payroll_concept.select(
        F.col("concept_id").alias("concept_key"),
        "country_code",
        "concept_code",
        "concept_name",
        "concept_type",
        sign_of("concept_type").alias("sign"),
    )


def salary_by_period(
    movement: DataFrame, concept: DataFrame, period: DataFrame, country: DataFrame
) -> DataFrame:
    """Monthly salary implied by each base-salary movement."""
    base = concept.where(F.col("concept_code") == BASE_SALARY).select("concept_id")
    calendar = period.join(country, "country_code").select(
        "period_id", F.col("start_date").alias("period_start"), periods_per_month("pay_frequency").alias("_times")
    )
    return (
        movement.join(base, "concept_id")
        .join(calendar, "period_id")
        .select("employment_id", "period_start", money(F.col("amount") * F.col("_times")).alias("monthly_salary"))
    )


def salary_versions(salaries: DataFrame) -> DataFrame:
    """Runs of equal salary per employment, with the first period of each."""
    numbered = islands(salaries, "employment_id", "period_start", "monthly_salary")
    return numbered.groupBy("employment_id", "version", "monthly_salary").agg(
        F.min("period_start").alias("first_period_start")
    )


def dim_employee(
    movement: DataFrame,
    concept: DataFrame,
    period: DataFrame,
    country: DataFrame,
    employment: DataFrame,
    employee: DataFrame,
    department: DataFrame,
) -> DataFrame:
    """One row per salary version of an employment, rebuilt from what was paid.

    The history starts no earlier than the first pay we know (``history_truncated`` says
    where that is later than the hire). Descriptive columns are today's on every
    version. An employment that was never paid a base salary has no row.

    The windows, the grouping and the join with employments all use employment_id, so
    Spark shuffles the salaries once; the pay calendar bounds the rows per employment.
    """
    versions = salary_versions(salary_by_period(movement, concept, period, country))
    described = versions.join(employment.drop("monthly_salary"), "employment_id")
    starts = F.when(
        F.col("version") == 1, F.greatest("hire_date", "first_period_start")
    ).otherwise(F.col("first_period_start"))
    dated = validity(described.withColumn("valid_from", starts), "employment_id", "valid_from")
    flagged = left_censored(dated, "employment_id", "valid_from", "hire_date", "history_truncated")
    people = employee.select("employee_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"))
    units = department.select("department_id", "country_code", "department_name")
    return (
        flagged.join(people, "employee_id")
        .join(units, "department_id")
        .select(
            surrogate_key("employment_id", "version").alias("employee_sk"),
            "employment_id",
            "employee_id",
            "full_name",
            "country_code",
            "department_name",
            "job_title",
            "hire_date",
            "termination_date",
            "termination_reason",
            F.coalesce("contract_type", F.lit("UNKNOWN")).alias("contract_type"),
            "version",
            "monthly_salary",
            "valid_from",
            "valid_to",
            "is_current",
            "history_truncated",
        )
    )


def fct_payroll_movement(
    movement: DataFrame,
    period: DataFrame,
    concept_dim: DataFrame,
    employee_dim: DataFrame,
    hot: DataFrame | None = None,
) -> DataFrame:
    """One row per movement, tied to the employee version in force when it was paid.

    The version table carries the hire date, so employments need not be joined: the
    movements meet two small tables and then one shuffle, on employment_id. ``hot``
    names employments with very many movements, whose rows are split over tasks.
    """
    calendar = period.select("period_id", "country_code", "start_date", date_key("pay_date").alias("pay_date_key"))
    signs = concept_dim.select(F.col("concept_key").alias("concept_id"), "sign")
    paid = movement.join(calendar, "period_id").join(signs, "concept_id")
    versions = employee_dim.select("employment_id", "employee_sk", "hire_date", "valid_from", "valid_to")
    at = F.greatest(F.col("f.start_date"), F.col("v.hire_date"))
    return point_in_time_join(paid, versions, "employment_id", at, hot=hot).select(
        "movement_id",
        "employee_sk",
        "employment_id",
        F.col("concept_id").alias("concept_key"),
        "country_code",
        "period_id",
        "pay_date_key",
        "amount",
        signed("amount", "sign").alias("signed_amount"),
        "updated_at",
    )


def settlement_amounts(settlement_line: DataFrame, concept: DataFrame) -> DataFrame:
    """Lines of a settlement pivoted to columns; a kind that is absent counts as zero."""
    code, kind, amount = F.col("concept_code"), F.col("concept_type"), F.col("amount")
    lines = settlement_line.join(concept.select("concept_id", "concept_code", "concept_type"), "concept_id")
    return conditional_pivot(
        lines,
        ["settlement_id"],
        {
            "vacation_amount": (code == VACATION_PAY, amount),
            "indemnity_amount": (code == INDEMNITY, amount),
            "deductions_amount": (kind == "DEDUCTION", amount),
            "net_amount": (None, amount * sign_of(kind)),
        },
    )


def fct_settlement(
    settlement: DataFrame,
    settlement_line: DataFrame,
    concept: DataFrame,
    employment: DataFrame,
    department: DataFrame,
    employee_dim: DataFrame,
) -> DataFrame:
    """One row per settlement at the version in force on the termination date.

    The lines are summed before they meet anything else, so only one row per settlement
    goes through the joins. A settlement without lines has no row.
    """
    amounts = settlement_amounts(settlement_line, concept)
    leaving = employment.where("termination_date is not null").select(
        "employment_id", "department_id", "termination_date", "termination_reason"
    )
    # Termination is a fact of the employment: the version is found once per employment.
    versions = employee_dim.select("employment_id", "employee_sk", "valid_from", "valid_to")
    ended = point_in_time_join(leaving, versions, "employment_id", F.col("f.termination_date")).join(
        department.select("department_id", "country_code"), "department_id"
    )
    return (
        settlement.join(amounts, "settlement_id")
        .join(ended, "employment_id")
        .select(
            "settlement_id",
            "employee_sk",
            "employment_id",
            "country_code",
            date_key("termination_date").alias("termination_date_key"),
            date_key("settlement_date").alias("settlement_date_key"),
            "termination_reason",
            "status",
            "vacation_amount",
            "indemnity_amount",
            "deductions_amount",
            "net_amount",
        )
    )


def int_absence_days(absence: DataFrame, employment: DataFrame) -> DataFrame:
    """Approved absences as days inside the employment; overlaps are still in.

    Ranges are cut to the employment before they are expanded, so no day is produced
    only to be thrown away.
    """
    approved = absence.where("status = 'APPROVED'").select(
        "absence_id", "employment_id", "absence_type", "start_date", "end_date"
    )
    bounded = clip_interval(
        approved.join(employment.select("employment_id", "hire_date", "termination_date"), "employment_id"),
        "start_date",
        "end_date",
        F.col("hire_date"),
        F.col("termination_date"),
        ("_from", "_to"),
    )
    days = explode_days(bounded, "_from", "_to", "absence_date")
    return days.select(
        "absence_id", "employment_id", "absence_type", "absence_date", date_key("absence_date").alias("date_key")
    )


def resolve_absence_days(days: DataFrame) -> DataFrame:
    """One absence per employment and day: sick leave, then vacation, then unjustified."""
    return resolve_by_priority(
        days, ["employment_id", "absence_date"], "absence_type", ABSENCE_PRIORITY, ["absence_id"]
    )


def fct_absence_day(days: DataFrame, employee_dim: DataFrame) -> DataFrame:
    """One row per employment and day of absence, with the version in force if there is one."""
    versions = employee_dim.select("employment_id", "employee_sk", "country_code", "valid_from", "valid_to")
    return point_in_time_join(
        resolve_absence_days(days), versions, "employment_id", F.col("f.absence_date"), how="left"
    ).select("employment_id", "absence_date", "date_key", "employee_sk", "country_code", "absence_type", "absence_id")
