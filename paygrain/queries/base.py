"""Registry of queries and the named sub-selects their SQL twins share."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property, wraps
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The given parquet tables, and the payroll roles they play (see ``roles``)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

        self.roles: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    nation = cached_property(lambda self: self._read("nation"))
    customer = cached_property(lambda self: self._read("customer"))
    supplier = cached_property(lambda self: self._read("supplier"))
    part = cached_property(lambda self: self._read("part"))
    orders = cached_property(lambda self: self._read("orders"))
    lineitem = cached_property(lambda self: self._read("lineitem"))
    events = cached_property(lambda self: self._read("events"))
    # The orders that calendars span and the customers that are people; the same however the others are sliced.
    dated_orders = cached_property(lambda self: self.orders)
    people = cached_property(lambda self: self.customer)

    def only(self, customers: DataFrame) -> Tables:
        """The tables under a slicer on customers: every window and join then sees no rows of others."""
        part = Tables(self.spark, self.folder)
        part.customer, part.dated_orders, part.people = customers, self.dated_orders, self.people
        mine = customers.select(F.col("c_custkey").alias("o_custkey"))
        part.orders = self.orders.join(mine, "o_custkey", "left_semi").select(*self.orders.columns)
        return part


Query = Callable[[Tables], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}
CTES: dict[str, str] = {}


def role(build: Query) -> Query:
    """Build a relation once per set of tables; a plan that uses it twice can then share its shuffles."""

    @wraps(build)
    def once(t: Tables) -> DataFrame:
        if build.__name__ not in t.roles:
            t.roles[build.__name__] = build(t)
        return t.roles[build.__name__]

    return once


def cte(name: str, sql: str) -> None:
    """Name a sub-select; statements that mention it get it, and what it needs, in a WITH."""
    CTES[name] = dedent(sql).strip()


def _needed(sql: str, done: list[str]) -> list[str]:
    for name in re.findall(r"\b[rm]_\w+\b", sql):
        if name in CTES and name not in done:
            _needed(CTES[name], done)
            if name not in done:
                done.append(name)
    return done


def with_ctes(sql: str) -> str:
    sql = dedent(sql).strip()
    names = _needed(sql, [])
    if not names:
        return sql
    shared = "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in names)
    own = sql.startswith("WITH ")
    return f"{shared},\n{sql[5:]}" if own else f"{shared}\n{sql}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = (fn, sql)
        return fn

    return add


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return REGISTRY[name][0](Tables(spark, folder))


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sql) for name, (_, sql) in REGISTRY.items() if sql is not None}
