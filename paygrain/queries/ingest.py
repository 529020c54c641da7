"""Incremental loads, contracts, bronze and staging on the given tables.

events is the source with a change time; its days are the loads. Queries that write do
so under the session's shared folder, one fresh path per run.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import moment
from ..functions.money import money
from ..session import scratch_path
from ..sources import bronze
from ..sources.contracts import Contract, contract_for, contract_violations, enforce_contract
from ..sources.staging import stage
from ..sources.watermarks import WatermarkStore
from ..streaming.loads import read_loads, upsert_stream
from ..operators.quality import row_counts
from .base import Tables, query

EVENT = Contract(
    "app.Event",
    "event_id bigint not null, user_id bigint not null, event_type string not null, value decimal(18,2) not null,"
    " ts timestamp_ntz not null",
    watermark="ts",
)
ORDER = Contract(
    "app.Order",
    "o_orderkey bigint not null, o_custkey bigint not null, o_totalprice decimal(18,2) not null,"
    " o_orderdate timestamp_ntz not null",
    watermark="o_orderdate",
)
# The source as it stands at three runs (whole at the last), and the ids of the loads they publish.
RUNS = [
    ("20240110T000000Z", datetime(2024, 1, 10)),
    ("20240120T000000Z", datetime(2024, 1, 20)),
    ("20240201T000000Z", None),
]
_LOAD = """CASE WHEN ts < TIMESTAMP '2024-01-10' THEN '20240110T000000Z'
                WHEN ts < TIMESTAMP '2024-01-20' THEN '20240120T000000Z' ELSE '20240201T000000Z' END"""


def _as_of(t: Tables, when: datetime | None) -> bronze.Reader:
    return lambda contract: t.events if when is None else t.events.where(F.col("ts") < moment(when))


def _everything(t: Tables) -> bronze.Reader:
    return lambda contract: t.events if contract is EVENT else t.orders


def _load_events(t: Tables, root: str) -> None:
    store = WatermarkStore(t.spark, f"{root}/_state/watermarks.json")
    for load_id, when in RUNS:
        bronze.run_extract(t.spark, _as_of(t, when), root, store, contracts=[EVENT], load_id=load_id)


def _scan_events(t: Tables, root: str) -> DataFrame:
    return bronze.bronze_scan(t.spark, root, EVENT.folder, EVENT.bronze_schema)


@query(
    "incremental_window",
    """
    SELECT event_id, user_id, event_type, ts FROM events
    WHERE ts > TIMESTAMP '2024-01-20' AND ts <= (SELECT max(ts) FROM events)
    """,
)
def incremental_window(t: Tables) -> DataFrame:
    """What one incremental run reads: after the last mark, up to the frozen bound."""
    high = bronze.freeze_high(t.events, "ts")
    window = bronze.incremental_window(t.events, "ts", datetime(2024, 1, 20), high)
    return window.select("event_id", "user_id", "event_type", "ts")


@query(
    "freeze_high",
    """
    SELECT 'events' AS table_name, max(ts) AS high FROM events UNION ALL
    SELECT 'orders', max(o_orderdate) FROM orders UNION ALL
    SELECT 'lineitem', max(l_shipdate) FROM lineitem UNION ALL
    SELECT 'empty', max(ts) FROM events WHERE event_id < 0
    """,
)
def freeze_high(t: Tables) -> DataFrame:
    """The upper bound of each table; NULL for an empty one."""
    marks = {
        "events": (t.events, "ts"),
        "orders": (t.orders, "o_orderdate"),
        "lineitem": (t.lineitem, "l_shipdate"),
        "empty": (t.events.where("event_id < 0"), "ts"),
    }
    rows = [(name, bronze.freeze_high(df, column)) for name, (df, column) in marks.items()]
    return t.spark.createDataFrame(rows, "table_name string, high timestamp_ntz")


@query(
    "bronze_append",
    f"""
    SELECT {_LOAD} AS load_id, count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total,
           min(ts) AS first_ts, max(ts) AS last_ts
    FROM events GROUP BY 1
    """,
)
def bronze_append(t: Tables) -> DataFrame:
    """Three runs against a growing source: three loads that neither overlap nor leave a gap."""
    root = scratch_path(t.spark, "bronze")
    _load_events(t, root)
    return (
        _scan_events(t, root)
        .groupBy("load_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            money(F.sum("value")).alias("total"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )


@query(
    "watermark_state",
    """
    SELECT 'app.Event' AS table_name, max(ts) AS watermark FROM events UNION ALL
    SELECT 'app.Order', max(o_orderdate) FROM orders
    """,
)
def watermark_state(t: Tables) -> DataFrame:
    """The saved marks after a run over two tables."""
    root = scratch_path(t.spark, "bronze")
    store = WatermarkStore(t.spark, f"{root}/_state/watermarks.json")
    bronze.run_extract(t.spark, _everything(t), root, store, contracts=[EVENT, ORDER])
    return store.table()


@query(
    "load_report",
    """
    SELECT 'app.Event' AS table_name, count(*) AS n_rows, max(ts) AS watermark FROM events UNION ALL
    SELECT 'app.Order', count(*), max(o_orderdate) FROM orders
    """,
)
def load_report(t: Tables) -> DataFrame:
    """Rows and mark per table of a full run (the seconds differ from run to run)."""
    root = scratch_path(t.spark, "bronze")
    store = WatermarkStore(t.spark, f"{root}/_state/watermarks.json")
    report = bronze.run_extract(t.spark, _everything(t), root, store, mode="full", contracts=[EVENT, ORDER])
    return report.drop("seconds")


@query(
    "backfill_table",
    """
    SELECT 'event' AS table_name, 2 * count(*) AS bronze_rows, count(*) AS staged_rows FROM events UNION ALL
    SELECT 'order', count(*), count(*) FROM orders
    """,
)
def backfill_table(t: Tables) -> DataFrame:
    """One table extracted again from the beginning: bronze holds it twice, staging once."""
    root = scratch_path(t.spark, "bronze")
    store = WatermarkStore(t.spark, f"{root}/_state/watermarks.json")
    tables = [EVENT, ORDER]
    bronze.run_extract(t.spark, _everything(t), root, store, contracts=tables, load_id="20240301T000000Z")
    bronze.run_extract(
        t.spark, _everything(t), root, store, "backfill", EVENT.source, contracts=tables, load_id="20240302T000000Z"
    )
    loads = {
        c.folder: bronze.bronze_scan(t.spark, root, c.folder, c.bronze_schema)
        for c in tables
    }
    held = row_counts(loads).withColumnRenamed("n_rows", "bronze_rows")
    kept = row_counts({c.folder: stage(loads[c.folder], c) for c in tables}).withColumnRenamed("n_rows", "staged_rows")
    return held.join(kept, "table_name")


@query(
    "bronze_stream_upsert",
    """
    SELECT user_id, event_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def bronze_stream_upsert(t: Tables) -> DataFrame:
    """Loads consumed as a stream, in two runs, into a table of the newest event per user."""
    root = scratch_path(t.spark, "bronze")
    target, checkpoint = f"{root}/_target", f"{root}/_checkpoint"
    store = WatermarkStore(t.spark, f"{root}/_state/watermarks.json")
    for runs in (RUNS[:2], RUNS[2:]):
        for load_id, when in runs:
            bronze.run_extract(t.spark, _as_of(t, when), root, store, contracts=[EVENT], load_id=load_id)
        loads = read_loads(t.spark, root, EVENT).withColumn(
            "bucket", F.pmod("user_id", F.lit(16)).cast("int")
        )
        upsert_stream(
            loads,
            target,
            checkpoint,
            "user_id",
            lambda: [F.col("ts").desc(), F.col("load_id").desc(), F.col("event_id").desc()],
            "bucket",
        ).awaitTermination()
    return t.spark.read.parquet(target).select("user_id", "event_id", "event_type", "value", "ts")


@query(
    "contract_enforce",
    """
    SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate FROM orders
    """,
)
def contract_enforce(t: Tables) -> DataFrame:
    return enforce_contract(t.orders, ORDER.schema, ORDER.source)


@query(
    "contract_violations",
    """
    SELECT 'o_custkey' AS column_name, 'null' AS reason, count(*) AS violations FROM orders WHERE o_orderkey % 100 = 7 HAVING count(*) > 0
    UNION ALL
    SELECT 'o_totalprice', 'misfit', count(*) FROM orders WHERE o_orderkey % 50 = 3 HAVING count(*) > 0
    """,
)
def violations(t: Tables) -> DataFrame:
    """Nulls and amounts too large for the contract, counted per column in one pass."""
    key = F.col("o_orderkey")
    broken = t.orders.withColumns(
        {
            "o_custkey": F.when(key % 100 != 7, F.col("o_custkey")),
            "o_totalprice": F.when(key % 50 == 3, F.col("o_totalprice") * 1e14).otherwise(F.col("o_totalprice")),
        }
    )
    return contract_violations(broken, ORDER.schema)


@query(
    "bronze_scan",
    """
    SELECT CASE WHEN c_custkey % 2 = 0 THEN 'L1' ELSE 'L2' END AS load_id, count(*) AS n_rows,
           count(CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END) AS with_segment
    FROM customer GROUP BY 1
    """,
)
def bronze_scan(t: Tables) -> DataFrame:
    """Loads of different schema read together, matched by column name."""
    root = scratch_path(t.spark, "bronze")
    bronze.publish_load(t.customer.where("c_custkey % 2 = 0").drop("c_mktsegment"), root, "customer", "L1")
    bronze.publish_load(t.customer.where("c_custkey % 2 = 1"), root, "customer", "L2")
    return (
        bronze.bronze_scan(t.spark, root, "customer")
        .groupBy("load_id")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count("c_mktsegment").alias("with_segment"))
    )


def settlement_bronze(t: Tables) -> DataFrame:
    """Orders in the shape of a bronze table: every fourth came again, paid, in a later load."""
    first = t.orders.select(
        F.col("o_orderkey").alias("SettlementId"),
        F.col("o_custkey").alias("EmploymentId"),
        F.col("o_orderdate").cast("date").alias("SettlementDate"),
        F.lit("DRAFT").alias("Status"),
        F.col("o_orderdate").alias("CreatedAt"),
        F.col("o_orderdate").alias("UpdatedAt"),
        F.lit("L1").alias("load_id"),
    )
    again = first.where("SettlementId % 4 = 0").withColumns(
        {
            "Status": F.lit("PAID"),
            "UpdatedAt": F.when(F.col("SettlementId") % 8 == 0, F.date_add("SettlementDate", 5).cast("timestamp_ntz")).otherwise(
                F.col("UpdatedAt")
            ),
            "load_id": F.lit("L2"),
        }
    )
    return first.unionByName(again)


@query(
    "staging_project",
    """
    SELECT o_orderkey AS settlement_id, o_custkey AS employment_id, CAST(o_orderdate AS DATE) AS settlement_date,
           CASE WHEN o_orderkey % 4 = 0 THEN 'PAID' ELSE 'DRAFT' END AS status, o_orderdate AS created_at,
           CASE WHEN o_orderkey % 8 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 5 AS TIMESTAMP) ELSE o_orderdate END AS updated_at,
           CASE WHEN o_orderkey % 4 = 0 THEN 'L2' ELSE 'L1' END AS _load_id
    FROM orders
    """,
)
def staging_project(t: Tables) -> DataFrame:
    """The settlement staging relation: newest version, renamed, load id passed through."""
    return stage(settlement_bronze(t), contract_for("payroll.Settlement"))


@query(
    "bronze_silver_counts",
    """
    SELECT 'bronze' AS layer, count(*) + count(CASE WHEN o_orderkey % 4 = 0 THEN 1 END) AS n_rows FROM orders
    UNION ALL SELECT 'silver', count(*) FROM orders
    """,
)
def bronze_silver_counts(t: Tables) -> DataFrame:
    rows = settlement_bronze(t)
    counts = row_counts({"bronze": rows, "silver": stage(rows, contract_for("payroll.Settlement"))})
    return counts.withColumnRenamed("table_name", "layer")


@query(
    "values_source",
    """
    SELECT p.priority, p.days, count(o_orderkey) AS n_orders
    FROM (VALUES ('1-URGENT', 1), ('2-HIGH', 3), ('3-MEDIUM', 7), ('6-NONE', 99)) AS p(priority, days)
    LEFT JOIN orders ON o_orderpriority = p.priority GROUP BY ALL
    """,
)
def values_source(t: Tables) -> DataFrame:
    """A literal relation with the number of orders that fall under each entry."""
    entries = t.spark.createDataFrame(
        [("1-URGENT", 1), ("2-HIGH", 3), ("3-MEDIUM", 7), ("6-NONE", 99)], "priority string, days int"
    )
    counts = t.orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))
    return entries.join(counts, "priority", "left").select(
        "priority", "days", F.coalesce("n", F.lit(0).cast("long")).alias("n_orders")
    )


@query(
    "series_int",
    """
    SELECT n, count(l_linenumber) AS n_lines
    FROM generate_series(1, 12) AS s(n) LEFT JOIN lineitem ON l_linenumber = n GROUP BY n
    """,
)
def series_int(t: Tables) -> DataFrame:
    """Line numbers 1..12 from a series, each with its count, zero where there is none."""
    counts = t.lineitem.groupBy(F.col("l_linenumber").cast("long").alias("n")).agg(F.count(F.lit(1)).alias("c"))
    return t.spark.range(1, 13).toDF("n").join(counts, "n", "left").select(
        "n", F.coalesce("c", F.lit(0).cast("long")).alias("n_lines")
    )


@query(
    "schema_evolution",
    """
    SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN 'INDEFINITE' ELSE c_mktsegment END AS contract_type FROM customer
    """,
)
def schema_evolution(t: Tables) -> DataFrame:
    """Old rows without a column and new rows with it, in one relation with a default."""
    old = t.customer.where("c_custkey % 2 = 0").select("c_custkey", "c_name")
    new = t.customer.where("c_custkey % 2 = 1").select("c_custkey", "c_name", F.col("c_mktsegment").alias("contract_type"))
    both = old.unionByName(new, allowMissingColumns=True)
    return both.withColumn("contract_type", F.coalesce("contract_type", F.lit("INDEFINITE")))
