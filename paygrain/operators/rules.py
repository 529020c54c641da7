"""Payroll rules: salary history, pay rules, settlements, absence ranges.

Where the rules leave something to chance, the draw is an argument: a function from the
keys it belongs to and a label to a column in [0, 1). The default hashes the keys, so
re-running or retrying a task gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import completed_years, days_since_anniversary, month_end
from ..functions.keys import unit_draw
from ..functions.money import money
from .intervals import interval_overlap_join
from .sequences import validity

Draw = Callable[..., Column]


def hashed_draw(*keys: str, label: int = 0) -> Column:
    return unit_draw(*keys, seed=label)


def annual_events(df: DataFrame, start: str, end: str, first_year: Column, last_year: Column, out: str) -> DataFrame:
    """Each January 1 strictly after ``start`` and not after ``end`` (NULL: open).

    Only the years that qualify are generated, instead of crossing every row with every year.
    """
    lo = F.greatest(F.year(start) + 1, first_year)
    hi = F.least(F.year(end), last_year)
    return (
        df.withColumns({"_lo": lo, "_hi": hi})
        .where("_hi >= _lo")
        .withColumn("_year", F.explode(F.sequence("_lo", "_hi")))
        .withColumn(out, F.make_date("_year", F.lit(1), F.lit(1)))
        .drop("_lo", "_hi", "_year")
    )


def compound_growth(df: DataFrame, entity: str, order: str, pct: str, base: str, out: str) -> DataFrame:
    """``base`` times the running product of (1 + pct), rounded to money.

    The product is the exponential of a running sum of logarithms. It is cut to ten
    decimals before it meets the amount, so that the noise of floating point does not
    decide how half a cent is rounded. At most one event per entity and year, so an entity's rows fit one window.
    """
    upto = Window.partitionBy(entity).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    factor = F.exp(F.sum(F.log(F.lit(1.0) + F.col(pct))).over(upto))
    return df.withColumn(out, money(F.col(base).cast("decimal(16,2)") * F.round(factor, 10).cast("decimal(20,10)")))


def salary_timeline(
    employments: DataFrame,
    raise_rules: DataFrame,
    first_year: Column,
    last_year: Column,
    draw: Draw = hashed_draw,
) -> DataFrame:
    """Validity intervals of each employment's salary: hiring salary plus yearly raises.

    ``employments``: employment_id, country_code, hire_date, termination_date,
    base_salary. ``raise_rules``: country_code, probability, min_pct, max_pct.
    """
    base = employments.select("employment_id", F.col("hire_date").alias("event_date"), "base_salary").withColumn(
        "pct", F.lit(0.0)
    )
    due = annual_events(employments, "hire_date", "termination_date", first_year, last_year, "event_date")
    keys = ("employment_id", "event_date")
    raises = (
        due.join(raise_rules, "country_code")
        .where(draw(*keys, label=0) < F.col("probability"))
        .select(
            "employment_id",
            "event_date",
            "base_salary",
            (F.col("min_pct") + (F.col("max_pct") - F.col("min_pct")) * draw(*keys, label=1)).cast("double").alias("pct"),
        )
    )
    events = base.unionByName(raises)
    grown = compound_growth(events, "employment_id", "event_date", "pct", "base_salary", "salary")
    return validity(grown, "employment_id", "event_date").select(
        "employment_id", F.col("event_date").alias("valid_from"), "valid_to", "salary", "is_current"
    )


def employment_periods(employments: DataFrame, periods: DataFrame, timeline: DataFrame) -> DataFrame:
    """Each employment in each pay period it was active in, with the salary in force.

    ``employments`` needs employment_id, country_code, periods_per_month, hire_date and
    termination_date. For a hire inside the period the hiring salary counts.

    Employments meet their few salaries before the pay calendar multiplies them, so the
    multiplied rows are not shuffled.
    """
    salaries = timeline.select("employment_id", "valid_from", "valid_to", "salary")
    active = interval_overlap_join(
        employments.join(salaries, "employment_id"),
        periods,
        "country_code",
        ("hire_date", "termination_date"),
        ("start_date", "end_date"),
    )
    paid = active.where(F.greatest("start_date", "hire_date").between(F.col("valid_from"), F.col("valid_to")))
    return paid.select(
        "employment_id",
        "country_code",
        "periods_per_month",
        "period_id",
        "start_date",
        "pay_date",
        F.month("start_date").alias("period_month"),
        (F.col("end_date") == month_end("start_date")).alias("is_last_of_month"),
        "salary",
    )


def _within_salary_bounds() -> Column:
    low, high, salary = F.col("salary_from"), F.col("salary_to"), F.col("salary")
    return (low.isNull() | (salary >= low)) & (high.isNull() | (salary <= high))


def _between(draw: Column) -> Column:
    """The rule's value for a draw, as a decimal: pay is never computed in floating point.

    A rule with a single value needs no draw.
    """
    low, high = F.col("min_value"), F.col("max_value")
    drawn = low + (high - low).cast("decimal(18,4)") * draw.cast("decimal(7,6)")
    return F.when(low == high, low.cast("decimal(16,8)")).otherwise(drawn.cast("decimal(16,8)"))


def _happens(draw: Column) -> Column:
    """Whether a rule applies; a certain one needs no draw, draws being below 1."""
    return F.when(F.col("probability") >= 1, True).otherwise(draw < F.col("probability"))


def rule_apply(periods: DataFrame, rules: DataFrame, draw: Draw = hashed_draw) -> DataFrame:
    """First pass over the rules: SALARY, PCT_SALARY and FIXED amounts per period.

    A monthly value is split over the month's periods unless the rule names a pay month,
    in which case all of it falls into the last period of that month. Whether a rule
    applies, and its value, is drawn per (employment, rule) for scope EMPLOYMENT and per
    (employment, period, rule) for scope PERIOD. ``rules`` is a small configuration
    table: Spark broadcasts it by its size, and a row meets only its country's rules.
    """
    own = F.col("scope") == "EMPLOYMENT"
    once, each = ("employment_id", "rule_id"), ("employment_id", "period_id", "rule_id")
    applies = _happens(F.when(own, draw(*once, label=0)).otherwise(draw(*each, label=0)))
    value = _between(F.when(own, draw(*once, label=1)).otherwise(draw(*each, label=1)))
    half = F.lit(Decimal("0.5"))
    part = F.when(F.col("periods_per_month") == 2, half).otherwise(F.lit(Decimal("1.0")))
    share = F.when(F.col("pay_month").isNull(), part).otherwise(F.lit(Decimal("1.0")))
    salary = F.col("salary").cast("decimal(14,2)")
    amount = (
        F.when(F.col("method") == "SALARY", money(salary * part))
        .when(F.col("method") == "PCT_SALARY", money(salary * value * share))
        .when(F.col("method") == "FIXED", money(value * share))
    )
    in_month = F.col("pay_month").isNull() | (
        (F.col("pay_month") == F.col("period_month")) & F.col("is_last_of_month")
    )
    return (
        periods.join(rules.where("method <> 'PCT_EARNINGS'"), "country_code")
        .where(in_month & _within_salary_bounds() & applies)
        .select(
            "employment_id",
            "period_id",
            "country_code",
            "rule_id",
            "concept_code",
            "concept_type",
            "salary",
            "pay_date",
            amount.alias("amount"),
        )
    )


def rule_second_pass(first_pass: DataFrame, rules: DataFrame, draw: Draw = hashed_draw) -> DataFrame:
    """Rules on the period's earnings, once the first pass has settled them.

    The first-pass rows carry salary and country, so the sums need no join back.
    """
    each = ("employment_id", "period_id", "rule_id")
    earned = (
        first_pass.where("concept_type = 'EARNING'")
        .groupBy("employment_id", "period_id", "country_code", "salary", "pay_date")
        .agg(F.sum("amount").alias("earnings"))
    )
    value = _between(draw(*each, label=1))
    return (
        earned.join(rules.where("method = 'PCT_EARNINGS'"), "country_code")
        .where(_within_salary_bounds() & _happens(draw(*each, label=0)))
        .select(
            "employment_id",
            "period_id",
            "country_code",
            "rule_id",
            "concept_code",
            "concept_type",
            "salary",
            "pay_date",
            money(F.col("earnings").cast("decimal(18,2)") * value).alias("amount"),
        )
    )


# Settlement parameters.
MAX_PAYMENT_DELAY_DAYS = 15
DRAFT_WINDOW_DAYS = 30
CANCEL_RATE = 0.03
VACATION_FACTOR = Decimal("0.5")
INDEMNITY_CAP = 12
DAYS_PER_YEAR = 365


def settlement_headers(terminated: DataFrame, window_end: Column, draw: Draw = hashed_draw) -> DataFrame:
    """Date, status and seniority of each terminated employment's settlement."""
    delay = F.floor(draw("employment_id", label=0) * (MAX_PAYMENT_DELAY_DAYS + 1)).cast("int")
    status = (
        F.when(F.col("termination_date") > F.date_sub(window_end, DRAFT_WINDOW_DAYS), "DRAFT")
        .when(draw("employment_id", label=1) < CANCEL_RATE, "CANCELLED")
        .otherwise("PAID")
    )
    return terminated.where("termination_date is not null").withColumns(
        {
            "settlement_date": F.date_add("termination_date", delay),
            "status": status,
            "full_years": completed_years("hire_date", "termination_date"),
            "anniversary_days": days_since_anniversary("hire_date", "termination_date"),
        }
    )


def settlement_lines(headers: DataFrame, security_rates: DataFrame) -> DataFrame:
    """Lines of each settlement: F002 vacation, F001 indemnity, D002 social security.

    ``headers`` needs employment_id, country_code, monthly_salary, termination_reason,
    full_years and anniversary_days; ``security_rates`` country_code and rate. All lines
    of one header come from one row, by an array that is exploded, so the headers are
    read once instead of once per kind of line.
    """
    earned = F.col("monthly_salary") * F.lit(VACATION_FACTOR) * F.col("anniversary_days")
    vacation = money(earned / F.lit(DAYS_PER_YEAR))
    years = F.least(F.greatest(F.col("full_years"), F.lit(1)), F.lit(INDEMNITY_CAP))
    indemnity = money(F.col("monthly_salary") * years)
    security = money(vacation * F.col("rate").cast("decimal(5,4)"))

    def line(code: str, amount: Column) -> Column:
        return F.struct(F.lit(code).alias("concept_code"), amount.alias("amount"))

    lines = F.array(
        line("F002", vacation),
        F.when(F.col("termination_reason") == "DISMISSAL", line("F001", indemnity)),
        F.when(F.col("rate").isNotNull(), line("D002", security)),
    )
    return (
        headers.join(security_rates, "country_code", "left")
        .withColumn("_line", F.explode(F.array_compact(lines)))
        .select("employment_id", "country_code", "_line.concept_code", "_line.amount")
    )


def missing_catalog(countries: DataFrame, concepts: DataFrame, required: list[str]) -> DataFrame:
    """Required concept codes that a country lacks."""
    wanted = countries.select("country_code", F.explode(F.array(*[F.lit(c) for c in required])).alias("concept_code"))
    return wanted.join(concepts.select("country_code", "concept_code"), ["country_code", "concept_code"], "left_anti")


def require_catalog(countries: DataFrame, concepts: DataFrame, required: list[str]) -> None:
    """Stop before any settlement is computed if a country lacks a concept."""
    gap = missing_catalog(countries, concepts, required).first()
    if gap is not None:
        raise ValueError(f"country {gap.country_code} lacks settlement concept {gap.concept_code}")


def range_candidates(
    active: DataFrame, slots: DataFrame, first_year: int, last_year: int, draw: Draw = hashed_draw
) -> DataFrame:
    """Absence ranges: per employment, year and slot, kept with the slot's probability.

    ``active``: employment_id, active_start, active_end. ``slots``: absence_type, slot,
    probability, min_days, max_days - a small configuration table, carried along as one
    array so that no join is needed. A range starts inside the year and the active
    window and is cut at the window's end; only years the window touches are generated.
    """
    menu = slots.agg(F.sort_array(F.collect_list(F.struct("absence_type", "slot", "probability", "min_days", "max_days")))).scalar()
    lo = F.greatest(F.year("active_start"), F.lit(first_year))
    hi = F.least(F.year("active_end"), F.lit(last_year))
    years = (
        active.withColumns({"_lo": lo, "_hi": hi})
        .where("_hi >= _lo")
        .withColumn("yr", F.explode(F.sequence("_lo", "_hi")))
        .withColumn("_slot", F.explode(menu))
        .select("employment_id", "active_start", "active_end", "yr", "_slot.*")
    )
    keys = ("employment_id", "yr", "absence_type", "slot")
    year_start = F.greatest(F.col("active_start"), F.make_date("yr", F.lit(1), F.lit(1)))
    year_end = F.least(F.col("active_end"), F.make_date("yr", F.lit(12), F.lit(31)))
    offset = F.floor(draw(*keys, label=1) * (F.datediff(year_end, year_start) + 1)).cast("int")
    days = (F.col("min_days") + F.floor(draw(*keys, label=2) * (F.col("max_days") - F.col("min_days") + 1))).cast("int")
    picked = years.where(draw(*keys, label=0) < F.col("probability"))
    return picked.withColumn("start_date", F.date_add(year_start, offset)).select(
        "employment_id",
        "absence_type",
        "yr",
        "slot",
        "start_date",
        F.least(F.date_add("start_date", days - 1), F.col("active_end")).alias("end_date"),
    )
