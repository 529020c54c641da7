"""Typed parquet export for BI tools, whose decimals end at 18 digits."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import files
from .tables import full_refresh

# The relations a BI model imports.
EXPORTED = [
    "dim_date",
    "dim_country",
    "dim_concept",
    "dim_employee",
    "fct_payroll_movement",
    "fct_settlement",
    "fct_absence_day",
]
BI_DECIMAL_DIGITS = 18


def bi_safe(df: DataFrame) -> DataFrame:
    """Narrow wide decimals to 18 digits; a value that does not fit fails the job."""

    def safe(field: T.StructField):
        kind = field.dataType
        if not isinstance(kind, T.DecimalType) or kind.precision <= BI_DECIMAL_DIGITS:
            return F.col(field.name)
        narrow = T.DecimalType(BI_DECIMAL_DIGITS, kind.scale)
        kept = F.col(field.name).try_cast(narrow)
        overflow = F.raise_error(F.lit(f"{field.name}: value does not fit {narrow.simpleString()}")).cast(narrow)
        return F.when(F.col(field.name).isNotNull() & kept.isNull(), overflow).otherwise(kept).alias(field.name)

    return df.select(*[safe(f) for f in df.schema])


def export_for_bi(spark: SparkSession, marts: Mapping[str, DataFrame], out: str) -> DataFrame:
    """Write each relation as a zstd parquet folder and report rows, megabytes and seconds."""
    report = []
    for name, df in marts.items():
        started, path = time.perf_counter(), f"{out}/{name}.parquet"
        full_refresh(bi_safe(df), path)
        rows = spark.read.parquet(path).count()
        report.append((name, rows, files.size(spark, path) / 1024 / 1024, time.perf_counter() - started))
    return spark.createDataFrame(report, "table_name string, n_rows long, mb double, seconds double")
