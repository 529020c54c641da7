"""Data checks. A check is a DataFrame of offending rows; no rows means it passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], where: Column | None = None, count_as: str = "rows_per_key") -> DataFrame:
    """Keys that occur more than once among the (filtered) rows."""
    df = df if where is None else df.where(where)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)).where(F.col(count_as) > 1)


def not_null_violations(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    df = df if where is None else df.where(where)
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their counts; NULL is left to the not-null check."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def fk_violations(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null child keys that the parent lacks, one row per child row."""
    known = parent.select(F.col(parent_key).alias(child_key))
    return child.where(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


def reconcile_counts(left: DataFrame, right: DataFrame, names: tuple[str, str] = ("staging_rows", "mart_rows")) -> DataFrame:
    """Both row counts in one row, if they differ."""
    a, b = names
    # Two one-row aggregates, tagged and summed: no join of any kind.
    tagged = left.agg(F.count(F.lit(1)).alias(a), F.lit(0).cast("long").alias(b)).unionByName(
        right.agg(F.lit(0).cast("long").alias(a), F.count(F.lit(1)).alias(b))
    )
    return tagged.agg(F.sum(a).alias(a), F.sum(b).alias(b)).where(F.col(a) != F.col(b))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counted = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def exactly_one(expected: DataFrame, actual: DataFrame, keys: Sequence[str], count_as: str = "cnt") -> DataFrame:
    """Expected keys that ``actual`` does not hold exactly once; absence counts as 0."""
    counts = actual.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = F.coalesce(F.col("_n"), F.lit(0).cast("long"))
    return expected.join(counts, list(keys), "left").withColumn(count_as, found).drop("_n").where(F.col(count_as) != 1)


def share_deviation(
    df: DataFrame, group: str, member: str, expected: DataFrame, share: str, tolerance: float
) -> DataFrame:
    """Groups whose share of distinct members is further from ``share`` than the tolerance."""
    sizes = df.groupBy(group).agg(F.count_distinct(member).alias("members"))
    total = sizes.agg(F.sum("members")).scalar()
    actual = sizes.withColumn("actual_share", F.col("members").cast("double") / total.cast("double"))
    return (
        actual.join(expected.select(group, share), group)
        .where(F.abs(F.col("actual_share") - F.col(share)) > tolerance)
        .select(group, "actual_share", share)
    )


@dataclass(frozen=True)
class Check:
    """A named check. ``error`` stops publication, ``warn`` only reports."""

    name: str
    offending: DataFrame
    severity: str = "error"


@dataclass(frozen=True)
class RowCheck:
    """A named check of single rows: those of ``rows`` for which ``broken`` is true offend."""

    name: str
    rows: DataFrame
    broken: Column
    severity: str = "error"


class QualityError(RuntimeError):
    """A check with severity ``error`` found offending rows."""


def _counted(checks: Sequence[RowCheck]) -> DataFrame:
    """Row checks of one table, counted in one pass over the columns they name."""
    counts = checks[0].rows.agg(*[F.count(F.when(c.broken, 1)).alias(f"_{i}") for i, c in enumerate(checks)])
    found = [
        F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(f"_{i}").alias("violations"))
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*found)))


def quality_report(checks: Sequence[Check | RowCheck]) -> DataFrame:
    """One row per check with the number of offending rows. Row checks of the same frame share one scan."""
    per_table: dict[int, list[RowCheck]] = {}
    for c in checks:
        if isinstance(c, RowCheck):
            per_table.setdefault(id(c.rows), []).append(c)
    rows = [_counted(own) for own in per_table.values()]
    rows += [
        c.offending.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "violations"
        )
        for c in checks
        if isinstance(c, Check)
    ]
    return reduce(DataFrame.unionByName, rows)


def passes(report: DataFrame) -> DataFrame:
    """The report with its outcome: fail, warn or pass."""
    outcome = (
        F.when(F.col("violations") == 0, "pass").when(F.col("severity") == "error", "fail").otherwise("warn")
    )
    return report.withColumn("outcome", outcome)


def enforce(report: DataFrame) -> list:
    """Raise if an error check failed; otherwise return the report, one row per check."""
    rows = passes(report).collect()
    failed = [f"{r.check_name} ({r.violations})" for r in rows if r.outcome == "fail"]
    if failed:
        raise QualityError("failed checks: " + ", ".join(sorted(failed)))
    return rows
