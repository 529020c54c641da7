"""Staging: the latest version of every row, under snake_case names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_text
from ..operators.sequences import latest_per_key
from .bronze import bronze_scan
from .contracts import CONTRACTS, Contract

# Where a staging name is not simply the source name in snake_case.
RENAMED = {
    "country": {"Name": "country_name"},
    "department": {"Name": "department_name"},
    "payroll_concept": {"Code": "concept_code", "Name": "concept_name"},
}
NORMALIZED = {"employment": ["ContractType"]}


def snake_case(name: str) -> str:
    return "".join("_" + ch.lower() if ch.isupper() and i else ch.lower() for i, ch in enumerate(name))


def staging_project(df: DataFrame, contract: Contract) -> DataFrame:
    """Rename the columns, tidy the codes and pass the load id through."""
    renamed = RENAMED.get(contract.folder, {})
    tidy = NORMALIZED.get(contract.folder, [])
    return df.select(
        *[
            (normalize_text(c) if c in tidy else F.col(c)).alias(renamed.get(c, snake_case(c)))
            for c in contract.columns
        ],
        F.col("load_id").alias("_load_id"),
    )


def stage(bronze_rows: DataFrame, contract: Contract) -> DataFrame:
    """Newest version per key; between equals the newest load wins."""
    order = [F.col(contract.watermark).desc(), F.col("load_id").desc()]
    return staging_project(latest_per_key(bronze_rows, contract.key, order), contract)


def stage_all(spark: SparkSession, bronze: str) -> Mapping[str, DataFrame]:
    """Every staging relation by folder name, lazily."""
    staged = {}
    for contract in CONTRACTS:
        staged[contract.folder] = stage(bronze_scan(spark, bronze, contract.folder, contract.bronze_schema), contract)
    return staged


def register_views(staged: Mapping[str, DataFrame]) -> None:
    """Always-fresh staging views for SQL users: stg_<name>."""
    for name, df in staged.items():
        df.createOrReplaceTempView(f"stg_{name}")
