"""Incremental extraction into append-only bronze loads.

Per table: freeze the upper bound, read the half-open window after the last mark, check it
against the contract while writing, publish the load by one rename, and only then advance
the mark. A run that dies repeats its window; duplicates are removed in staging.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import moment
from . import files
from .contracts import CONTRACTS, Contract, enforce_contract
from .watermarks import EPOCH, WatermarkStore

# Fixed value: the most rows per part file.
ROWS_PER_FILE = 500_000

Reader = Callable[[Contract], DataFrame]


def new_load_id(now: datetime | None = None) -> str:
    """One id for all tables of a run, in UTC."""
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")


def freeze_high(source: DataFrame, watermark: str) -> datetime | None:
    """The newest change right now; None for an empty table. Rows changed later wait."""
    return source.agg(F.max(watermark)).first()[0]


def incremental_window(source: DataFrame, watermark: str, low: datetime, high: datetime) -> DataFrame:
    """Rows changed after ``low`` up to and including ``high``; the filter reaches the scan."""
    mark = F.col(watermark)
    return source.where((mark > moment(low)) & (mark <= moment(high)))


def load_path(bronze: str, folder: str, load_id: str) -> str:
    return f"{bronze}/{folder}/load_id={load_id}"


def publish_load(df: DataFrame, bronze: str, folder: str, load_id: str) -> str:
    """Write a load outside the table's folder, then make it visible by a rename."""
    spark, staged = df.sparkSession, f"{bronze}/_staged/{folder}/{load_id}"
    target = load_path(bronze, folder, load_id)
    if files.exists(spark, target):
        raise FileExistsError(target)
    df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(staged)
    files.rename(spark, staged, target)
    return target


def newest_change(read: Reader, contract: Contract, source: DataFrame) -> datetime | None:
    """The frozen bound, asked of the source itself where it can answer."""
    ask = getattr(read, "newest", None)
    return ask(contract) if ask else freeze_high(source, contract.watermark)


def extract_table(
    read: Reader, contract: Contract, bronze: str, low: datetime, load_id: str
) -> tuple[int, datetime | None]:
    """Load one table's window; returns its rows and new mark, or (0, None) if nothing changed.

    The window is empty exactly when the frozen bound does not exceed the old mark, so
    an unchanged table costs one aggregate and writes nothing.
    """
    source = read(contract)
    high = newest_change(read, contract, source)
    if high is None or high <= low:
        return 0, None
    window = incremental_window(source.select(*contract.columns), contract.watermark, low, high)
    path = publish_load(enforce_contract(window, contract.schema, contract.source), bronze, contract.folder, load_id)
    # The count of a parquet load comes from its footers.
    return source.sparkSession.read.parquet(path).count(), high


def run_extract(
    spark: SparkSession,
    read: Reader,
    bronze: str,
    store: WatermarkStore,
    mode: str = "incremental",
    table: str | None = None,
    contracts: Sequence[Contract] = tuple(CONTRACTS),
    load_id: str | None = None,
) -> DataFrame:
    """Extract every table, or one from the beginning.

    ``mode`` is ``incremental`` (from the saved marks), ``full`` (all tables from the
    epoch) or ``backfill`` (``table`` from the epoch, the others untouched). Returns one
    row per table: rows, seconds, watermark.
    """
    if mode not in ("incremental", "full", "backfill"):
        raise ValueError(f"unknown mode: {mode}")
    if (mode == "backfill") != (table is not None):
        raise ValueError("a table is named for a backfill, and only then")
    if table is not None and table not in [c.source for c in contracts]:
        raise KeyError(f"unknown source table: {table}")
    load_id, marks, report = load_id or new_load_id(), store.load(), []
    for contract in contracts:
        if table is not None and contract.source != table:
            continue
        started = time.perf_counter()
        low = marks.get(contract.source, EPOCH) if mode == "incremental" else EPOCH
        rows, high = extract_table(read, contract, bronze, low, load_id)
        if high is not None:
            store.advance(contract.source, high)
            marks[contract.source] = high
        report.append((contract.source, rows, time.perf_counter() - started, marks.get(contract.source)))
    return spark.createDataFrame(report, "table_name string, n_rows long, seconds double, watermark timestamp_ntz")


def bronze_scan(spark: SparkSession, bronze: str, folder: str, schema=None) -> DataFrame:
    """All published loads of a table with their ``load_id``, matched by column name.

    With a contract's schema nothing has to be inferred or merged: a column that older
    loads lack is NULL there. Without one, the loads' schemas are merged.
    """
    root = f"{bronze}/{folder}"
    reader = spark.read.option("basePath", root)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    return reader.parquet(f"{root}/load_id=*").withColumn("load_id", F.col("load_id").cast("string"))


def _literal(value: object) -> str:
    """A key as SQL text: numbers bare, everything else in quotes (dates and times in ISO form)."""
    if isinstance(value, (int, Decimal)) and not isinstance(value, bool):
        return str(value)
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return "'" + text.replace("'", "''") + "'"


@dataclass(frozen=True)
class JdbcSource:
    """Reads contract tables over JDBC, large ones through several connections.

    ``splits`` names, per source table, the number of connections; their ranges lie on the table's key, which
    must then be a number or date. The key's bounds and the newest change are asked for as one-row queries, so
    neither reads the table. ``options`` go to every read (driver, credentials).

    With ``by_count`` the ranges hold equal numbers of rows, however uneven the keys: one query over the key's index
    gives their first keys, the reads get them as predicates, and keys of any type will do. Without it the span from
    the smallest to the largest key is cut into equal widths, for sources that know no window functions.
    """

    spark: SparkSession
    url: str
    splits: Mapping[str, int] = field(default_factory=dict)
    fetch_rows: int = ROWS_PER_FILE // 50
    options: Mapping[str, str] = field(default_factory=dict)
    by_count: bool = True

    def settings(self, table: str) -> dict[str, str]:
        """Options of one read. ``table`` is a name or a query in brackets with an alias."""
        return {
            "url": self.url, "dbtable": table, "fetchsize": str(self.fetch_rows), "preferTimestampNTZ": "true", **self.options
        }

    def ranged(self, contract: Contract, low: object, high: object) -> dict[str, str]:
        """Options of a table's read, cut into ranges of its key where it is to be split and has rows."""
        settings, parts = self.settings(contract.source), self.splits.get(contract.source, 1)
        if parts > 1 and low is not None:
            settings |= {"partitionColumn": contract.key, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}
        return settings

    @staticmethod
    def edges_query(contract: Contract) -> str:
        return f"(SELECT MIN({contract.key}) AS low, MAX({contract.key}) AS high FROM {contract.source}) edges"

    @staticmethod
    def firsts_query(contract: Contract, parts: int) -> str:
        """The first key of each of ``parts`` ranges of equally many rows, as rows of a query in brackets."""
        numbered = f"SELECT {contract.key} AS k, NTILE({parts}) OVER (ORDER BY {contract.key}) AS part FROM {contract.source} WHERE {contract.key} IS NOT NULL"
        return f"(SELECT part, MIN(k) AS first_key FROM ({numbered}) numbered GROUP BY part) firsts"

    @staticmethod
    def predicates(key: str, firsts: Sequence) -> list[str]:
        """Conditions of which every row satisfies exactly one, NULL keys the first. ``firsts`` ascend and may repeat."""
        cuts = [_literal(k) for k in dict.fromkeys(firsts)][1:]
        if not cuts:
            return ["1 = 1"]
        inner = [f"{key} >= {lo} AND {key} < {hi}" for lo, hi in zip(cuts, cuts[1:])]
        return [f"{key} < {cuts[0]} OR {key} IS NULL", *inner, f"{key} >= {cuts[-1]}"]

    @staticmethod
    def newest_query(contract: Contract) -> str:
        return f"(SELECT MAX({contract.watermark}) AS newest FROM {contract.source}) newest"

    def _load(self, settings: Mapping[str, str]) -> DataFrame:
        return self.spark.read.format("jdbc").options(**settings).load()

    def newest(self, contract: Contract) -> datetime | None:
        return self._load(self.settings(self.newest_query(contract))).first()[0]

    def by_predicates(self, contract: Contract, parts: int) -> DataFrame:
        firsts = self._load(self.settings(self.firsts_query(contract, parts))).select("part", "first_key").collect()
        where = self.predicates(contract.key, [r.first_key for r in sorted(firsts, key=lambda r: r.part)])
        properties = {k: v for k, v in self.settings(contract.source).items() if k not in ("url", "dbtable")}
        return self.spark.read.jdbc(self.url, contract.source, predicates=where, properties=properties)

    def __call__(self, contract: Contract) -> DataFrame:
        low = high = None
        if self.by_count and self.splits.get(contract.source, 1) > 1:
            return self.by_predicates(contract, self.splits[contract.source])
        if self.splits.get(contract.source, 1) > 1:
            low, high = self._load(self.settings(self.edges_query(contract))).first()
        return self._load(self.ranged(contract, low, high))


def jdbc_reader(spark: SparkSession, url: str, splits: Mapping[str, int] | None = None, **options: str) -> Reader:
    """A ``JdbcSource``; the window's filter and columns are pushed into its reads."""
    return JdbcSource(spark, url, splits or {}, options=options)
