"""Write semantics and snapshots on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import at_second
from ..functions.money import money
from ..operators import snapshots, upserts
from ..operators.sequences import latest_per_key
from ..session import scratch_path
from ..sinks.export import export_for_bi
from ..sinks.journal import Journal
from ..sinks.key_index import KeyIndex
from ..sinks.tables import journaled_upsert, upsert_partitions
from . import roles
from .base import Tables, query

# The mart holds the events before this moment; the source has all, some corrected since.
_BUILT = "TIMESTAMP_NTZ '2024-01-20 00:00:00'"


def _mart(t: Tables) -> DataFrame:
    return t.events.where(f"ts < {_BUILT}").select("event_id", "user_id", money("value").alias("amount"), "ts")


def _source(t: Tables) -> DataFrame:
    corrected = F.when(F.col("event_id") % 7 == 0, F.col("value") + 1).otherwise(F.col("value"))
    return t.events.select("event_id", "user_id", money(F.round(corrected, 2)).alias("amount"), "ts")


_BATCH = """
    SELECT event_id, user_id, CAST(round(CASE WHEN event_id % 7 = 0 THEN value + 1 ELSE value END, 2) AS DECIMAL(18,2)) AS amount, ts
    FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 3 DAY FROM events WHERE ts < TIMESTAMP '2024-01-20')
"""


@query("lookback_filter", _BATCH)
def lookback_filter(t: Tables) -> DataFrame:
    """The rows an incremental run processes again: three days before the mart's newest."""
    return upserts.lookback(_source(t), _mart(t), "ts", 3)


@query(
    "incremental_delete_insert",
    f"""
    SELECT event_id, user_id, CAST(value AS DECIMAL(18,2)) AS amount, ts FROM events
    WHERE ts < TIMESTAMP '2024-01-20' AND event_id NOT IN (SELECT event_id FROM ({_BATCH}))
    UNION ALL SELECT * FROM ({_BATCH})
    """,
)
def incremental_delete_insert(t: Tables) -> DataFrame:
    """The mart after an incremental run: the batch's keys replaced or added."""
    mart = _mart(t)
    return upserts.delete_insert(mart, upserts.lookback(_source(t), mart, "ts", 3), "event_id")


@query(
    "insert_missing",
    """
    WITH p AS (SELECT DISTINCT o_custkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority, o_orderstatus = 'F' AS known FROM orders)
    SELECT DISTINCT o_custkey, priority, true AS known FROM p WHERE known
    UNION ALL
    SELECT DISTINCT o_custkey, priority, false FROM p AS n WHERE NOT EXISTS
      (SELECT 1 FROM p AS k WHERE k.known AND k.o_custkey = n.o_custkey AND k.priority IS NOT DISTINCT FROM n.priority)
    """,
)
def insert_missing(t: Tables) -> DataFrame:
    """Add the natural keys the target lacks; a NULL in the key equals a NULL."""
    pairs = t.orders.select(
        "o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"), "o_orderstatus"
    )
    target = pairs.where("o_orderstatus = 'F'").select("o_custkey", "priority").distinct().withColumn("known", F.lit(True))
    batch = pairs.select("o_custkey", "priority").distinct().withColumn("known", F.lit(False))
    return upserts.insert_missing(target, batch, ["o_custkey"], null_safe=["priority"])


@query(
    "update_from",
    """
    SELECT e.employment_id, coalesce(s.monthly_salary, e.monthly_salary) AS monthly_salary,
           CASE WHEN s.raised_at > e.updated_at THEN s.raised_at ELSE e.updated_at END AS updated_at
    FROM r_employment e
    LEFT JOIN (SELECT employment_id, monthly_salary, CAST(valid_from AS TIMESTAMP) + INTERVAL 10 HOUR AS raised_at
               FROM m_dim_employee WHERE is_current AND valid_from > hire_date) s USING (employment_id)
    """,
)
def update_from(t: Tables) -> DataFrame:
    """Employments brought to the salary of their last version, if there was a raise."""
    raised = (
        roles.dim_employee(t)
        .where("is_current and valid_from > hire_date")
        .select("employment_id", "monthly_salary", at_second("valid_from", 36000).alias("raised_at"))
    )
    later = F.when(F.col("s.raised_at") > F.col("t.updated_at"), F.col("s.raised_at")).otherwise(F.col("t.updated_at"))
    return upserts.update_from(
        roles.employment(t).select("employment_id", "monthly_salary", "updated_at"),
        raised,
        "employment_id",
        {"monthly_salary": F.col("s.monthly_salary"), "updated_at": later},
    )


@query(
    "delete_orphans",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
    """,
)
def delete_orphans(t: Tables) -> DataFrame:
    parents = t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return upserts.delete_orphans(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), parents, "l_orderkey"
    )


@query(
    "update_top_n",
    """
    SELECT c_custkey, CASE WHEN c_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 20 = 1 AND c_acctbal > 0
                                              ORDER BY c_custkey DESC LIMIT 31) THEN 'temporary ' ELSE 'INDEFINITE' END AS contract_type
    FROM customer
    """,
)
def update_top_n(t: Tables) -> DataFrame:
    """A column set on the 31 newest rows that satisfy a predicate."""
    rows = t.customer.withColumn("contract_type", F.lit("INDEFINITE"))
    return upserts.update_top_n(
        rows,
        "c_custkey",
        (F.col("c_custkey") % 20 == 1) & (F.col("c_acctbal") > 0),
        [F.col("c_custkey").desc()],
        31,
        {"contract_type": F.lit("temporary ")},
    ).select("c_custkey", "contract_type")


@query(
    "commit_recovery",
    """
    SELECT event_id, user_id, CAST(round(CASE WHEN event_id % 5 = 0 THEN value + 2 WHEN event_id % 3 = 0 THEN value + 1 ELSE value END, 2) AS DECIMAL(18,2)) AS amount,
           CASE WHEN event_id % 5 = 0 THEN 3 WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS load_no,
           CAST(user_id % 16 + CASE WHEN event_id % 15 = 0 THEN 1 ELSE 0 END AS INTEGER) AS part
    FROM events
    """,
)
def commit_recovery(t: Tables) -> DataFrame:
    """Two loads whose commit is cut after one partition, then taken again from the journal, with keys that move."""
    path = scratch_path(t.spark, "recovery")
    journal, index = Journal(t.spark, f"{path}._journal"), KeyIndex(t.spark, path, "event_id", "part", width=4096)
    number = F.when(F.col("event_id") % 5 == 0, 3).when(F.col("event_id") % 3 == 0, 2)

    def load(no: int) -> DataFrame:
        rows = t.events if no == 1 else t.events.where(number == no)
        moved = F.when((F.lit(no) > 1) & (F.col("event_id") % 15 == 0), 1).otherwise(0)
        return rows.select(
            "event_id", "user_id", money(F.round(F.col("value") + (no - 1), 2)).alias("amount"), F.lit(no).alias("load_no"),
            (F.col("user_id") % 16 + moved).cast("int").alias("part"),
        )

    newest = [F.col("load_no").desc()]
    journaled_upsert(load(1), path, "event_id", "part", journal, {"loads": [1]}, {"loads": 1}, newest, index)
    batch = load(2).unionByName(load(3))
    # What a run leaves that dies in its commit: an intent, and one of its partitions swapped in.
    journal.begin({"loads": [2, 3]}, list(range(17)))
    first = latest_per_key(t.spark.read.parquet(path).where("part = 0").unionByName(batch.where("part = 0")), "event_id", newest)
    cut = scratch_path(t.spark, "recovery-cut")
    first.write.parquet(cut)
    t.spark.read.parquet(cut).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    pending = sorted({1, 2, 3} - journal.covered("loads"))
    again = load(pending[0])
    for no in pending[1:]:
        again = again.unionByName(load(no))
    journaled_upsert(again, path, "event_id", "part", journal, {"loads": pending}, {"loads": 3}, newest, index)
    return t.spark.read.parquet(path)


@query(
    "key_index_homes",
    """
    SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS order_year, count(*) AS n_keys
    FROM orders WHERE o_orderkey % 50 = 7 GROUP BY 1
    """,
)
def key_index_homes(t: Tables) -> DataFrame:
    """How many keys of a batch lie in each partition, from the index alone."""
    path = scratch_path(t.spark, "homes")
    facts = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))
    upsert_partitions(facts, path, "o_orderkey", "order_year")
    index = KeyIndex(t.spark, path, "o_orderkey", "order_year", width=65_536)
    homes = index.homes(t.orders.where("o_orderkey % 50 = 7").select("o_orderkey"))
    return homes.groupBy("order_year").agg(F.count(F.lit(1)).alias("n_keys"))


# The moments of three snapshot runs; the last one sees everything.
_CUTS = ["2024-01-10", "2024-01-20", None]


def _seen_at(t: Tables, cut: str | None) -> DataFrame:
    """Each user's newest event before a moment: the rows a snapshot run finds."""
    seen = t.events if cut is None else t.events.where(f"ts < TIMESTAMP_NTZ '{cut} 00:00:00'")
    rows = seen.select(
        "user_id", "event_type", money("value").alias("amount"), F.col("ts").alias("updated_at")
    )
    return latest_per_key(rows, "user_id", [F.col("updated_at").desc(), F.col("event_type")])


_SEEN = "\nUNION ALL\n".join(
    f"""SELECT * FROM (SELECT user_id, event_type, CAST(value AS DECIMAL(18,2)) AS amount, ts AS updated_at, {i} AS run FROM events
        WHERE {'true' if cut is None else f"ts < TIMESTAMP '{cut}'"} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type) = 1)"""
    for i, cut in enumerate(_CUTS)
)


@query(
    "snapshot_timestamp",
    f"""
    SELECT user_id, event_type, amount, updated_at, md5(concat_ws('|', user_id, updated_at)) AS dbt_scd_id,
           updated_at AS dbt_updated_at, updated_at AS dbt_valid_from,
           coalesce(lead(updated_at) OVER (PARTITION BY user_id ORDER BY updated_at), TIMESTAMP '9999-12-31') AS dbt_valid_to
    FROM (SELECT DISTINCT user_id, event_type, amount, updated_at FROM ({_SEEN}))
    """,
)
def snapshot_timestamp(t: Tables) -> DataFrame:
    """Three snapshot runs, one after the other."""
    snapshot = None
    for cut in _CUTS:
        snapshot = snapshots.snapshot_timestamp(snapshot, _seen_at(t, cut), "user_id", "updated_at")
    return snapshot


@query(
    "snapshot_backfill",
    f"""
    SELECT s.user_id, s.updated_at,
           CASE WHEN s.nxt IS NULL THEN CASE WHEN s.user_id % 10 <> 0 THEN s.event_type END END AS event_type, s.nxt IS NULL AS is_open
    FROM (SELECT *, lead(updated_at) OVER (PARTITION BY user_id ORDER BY updated_at) AS nxt
          FROM (SELECT DISTINCT user_id, event_type, updated_at FROM ({_SEEN}))) s
    """,
)
def snapshot_backfill(t: Tables) -> DataFrame:
    """A column that came later, filled on open versions only; closed ones stay unknown."""
    snapshot = None
    for cut in _CUTS:
        snapshot = snapshots.snapshot_timestamp(
            snapshot, _seen_at(t, cut).drop("event_type", "amount"), "user_id", "updated_at"
        )
    grown = snapshot.withColumn("event_type", F.lit(None).cast("string"))
    today = _seen_at(t, _CUTS[-1]).where("user_id % 10 <> 0")
    filled = snapshots.snapshot_backfill(grown, today, "user_id", "event_type")
    return filled.select("user_id", "updated_at", "event_type", snapshots.is_open().alias("is_open"))


@query(
    "bi_safe_export",
    """
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total, count(*) AS n_orders
    FROM orders GROUP BY 1
    """,
)
def bi_safe_export(t: Tables) -> DataFrame:
    """A relation with a wide decimal, exported and read back with 18 digits."""
    out = scratch_path(t.spark, "export")
    totals = t.orders.groupBy("o_custkey").agg(
        F.sum(money("o_totalprice")).alias("total"), F.count(F.lit(1)).alias("n_orders")
    )
    export_for_bi(t.spark, {"totals": totals}, out)
    return t.spark.read.parquet(f"{out}/totals.parquet")
