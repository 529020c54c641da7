"""State that is kept and brought up to date, and differences found without comparing all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import money
from ..operators import asof, bitmaps, digests, histories, intervals, islands, sequences, summaries
from ..plans.marts import ABSENCE_PRIORITY
from ..session import scratch_path
from . import roles
from .base import Tables, cte, query

# One row per user and moment.
cte("r_visit", "SELECT user_id, ts, min(event_type) AS event_type, max(event_id) AS event_id FROM events GROUP BY 1, 2")


@query(
    "incremental_islands",
    """
    SELECT user_id, version, value, min(ts) AS first_at, max(ts) AS last_at, count(*) AS n
    FROM (SELECT user_id, ts, event_type AS value, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS version
          FROM (SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) = event_type THEN 0 ELSE 1 END AS opens FROM r_visit))
    GROUP BY 1, 2, 3
    """,
)
def incremental_islands(t: Tables) -> DataFrame:
    """Stored runs of equal event types after two batches: one with late rows of some users, one in order."""
    visits = t.events.groupBy("user_id", "ts").agg(F.min("event_type").alias("event_type"), F.max("event_id").alias("event_id"))
    late = F.col("event_id") % 211 == 0
    old, middle = F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"), F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")
    args = ("user_id", "ts", "event_type")

    def kept(df: DataFrame) -> DataFrame:
        path = scratch_path(t.spark, "islands")
        df.write.parquet(path)
        return t.spark.read.schema(df.schema).parquet(path)

    visits = kept(visits)
    stored = kept(islands.islands(visits.where(old & ~late), *args))
    stored = kept(islands.refresh(stored, visits.where((~old & middle) | (old & late)), visits.where(middle), *args))
    return islands.refresh(stored, visits.where(~middle), visits, *args)


@query(
    "source_drift",
    """
    SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'missing' WHEN event_id % 101 = 0 THEN 'deleted' ELSE 'altered' END AS status
    FROM events WHERE event_id % 97 = 0 OR event_id % 101 = 0 OR event_id % 103 = 0
    """,
)
def source_drift(t: Tables) -> DataFrame:
    """Rows that a copy lacks, still has, or holds in another state, none of which changed its time."""
    rows = t.events.select("event_id", "user_id", money("value").alias("amount"), "ts")
    source = rows.where("NOT (event_id % 101 = 0 AND event_id % 97 <> 0)")
    altered = F.when((F.col("event_id") % 103 == 0), F.col("amount") + 1).otherwise(F.col("amount"))
    target = rows.where("event_id % 97 <> 0").withColumn("amount", altered.cast("decimal(18,2)"))
    return digests.drift(source, target, "event_id")


@query(
    "distinct_by_bitmap",
    """
    SELECT order_year, priority, count(DISTINCT o_custkey) AS n_customers FROM
      (SELECT year(o_orderdate) AS order_year, o_orderpriority AS priority, o_custkey FROM orders)
    GROUP BY GROUPING SETS ((order_year, priority), (order_year), (priority), ())
    """,
)
def distinct_by_bitmap(t: Tables) -> DataFrame:
    """Distinct customers by year and priority and all totals, from bitmaps kept by month and merged from two loads."""
    rows = t.orders.select(
        F.year("o_orderdate").cast("long").alias("order_year"), F.month("o_orderdate").alias("month"),
        F.col("o_orderpriority").alias("priority"), "o_custkey",
    )
    first, second = rows.where("o_custkey % 2 = 0 OR month < 7"), rows.where("NOT (o_custkey % 2 = 0 OR month < 7)")
    groups = ["order_year", "month", "priority"]
    state = bitmaps.merge_states(*[bitmaps.distinct_state(x, groups, "o_custkey") for x in (first, second)])
    fine = bitmaps.merge_states(state.drop("month"))
    found = None
    for by in (["order_year", "priority"], ["order_year"], ["priority"], []):
        some = bitmaps.distinct_counts(fine, by, "n_customers")
        some = some.select(*[(F.col(c) if c in by else F.lit(None).cast(fine.schema[c].dataType)).alias(c) for c in ("order_year", "priority")], "n_customers")
        found = some if found is None else found.unionByName(some)
    return found


def _approved(t: Tables) -> DataFrame:
    return roles.absence(t).where("status = 'APPROVED'")


@query(
    "resolve_ranges",
    """
    SELECT employment_id, absence_date, absence_id FROM
      (SELECT a.employment_id, CAST(g.day AS DATE) AS absence_date, a.absence_id,
              CASE a.absence_type WHEN 'SICK_LEAVE' THEN 1 WHEN 'VACATION' THEN 2 ELSE 3 END AS rank
       FROM r_absence a CROSS JOIN LATERAL generate_series(a.start_date, a.end_date, INTERVAL 1 DAY) AS g(day) WHERE a.status = 'APPROVED')
    QUALIFY row_number() OVER (PARTITION BY employment_id, absence_date ORDER BY rank, absence_id) = 1
    """,
)
def resolve_ranges(t: Tables) -> DataFrame:
    """One absence per employment and day, decided between ranges; days are made of what is left."""
    rank = F.lit(len(ABSENCE_PRIORITY) + 1)
    for place, name in enumerate(ABSENCE_PRIORITY, start=1):
        rank = F.when(F.col("absence_type") == name, F.lit(place)).otherwise(rank)
    won = intervals.resolve_ranges(_approved(t), ["employment_id"], "start_date", "end_date", rank, ["absence_id"])
    return intervals.explode_days(won, "lo", "hi", "absence_date").select("employment_id", "absence_date", "absence_id")


@query(
    "overlap_figures",
    """
    WITH a AS (SELECT * FROM r_absence WHERE status = 'APPROVED'),
    days AS (SELECT a.employment_id, g.day FROM a CROSS JOIN LATERAL generate_series(a.start_date, a.end_date, INTERVAL 1 DAY) AS g(day))
    SELECT (SELECT count(*) FROM a JOIN a AS b ON a.employment_id = b.employment_id AND a.absence_id < b.absence_id
            AND a.start_date <= b.end_date AND b.start_date <= a.end_date) AS n_pairs,
           (SELECT count(*) FROM days) AS n_days,
           (SELECT count(*) FROM days) - (SELECT count(*) FROM (SELECT DISTINCT employment_id, day FROM days)) AS excess_days
    """,
)
def overlap_figures(t: Tables) -> DataFrame:
    """Pairs of overlapping absences and the days they would count twice."""
    return intervals.overlap_figures(_approved(t), ["employment_id"], "start_date", "end_date")


def _asof(t: Tables, rows_per_task: int | None) -> DataFrame:
    placed = t.orders.select("o_orderkey", F.col("o_custkey").alias("employment_id"), F.col("o_orderdate").cast("date").alias("day"))
    versions = roles.dim_employee(t).select("employment_id", "employee_sk", "version", "valid_from", "valid_to")
    edges = asof.range_edges(placed, "employment_id", "day", rows_per_task) if rows_per_task else None
    return asof.asof_join(placed, versions, "employment_id", "day", how="left", edges=edges).select(
        "o_orderkey", F.col("employment_id").alias("o_custkey"), "employee_sk", "version"
    )


_ASOF = """
    SELECT o_orderkey, o_custkey, de.employee_sk, de.version FROM orders
    LEFT JOIN m_dim_employee de ON de.employment_id = o_custkey AND CAST(o_orderdate AS DATE) BETWEEN de.valid_from AND de.valid_to
"""


@query("asof_merge", _ASOF)
def asof_merge(t: Tables) -> DataFrame:
    """Each order with the version in force, if any, by one ordered pass over orders and versions together."""
    return _asof(t, None)


@query("asof_merge_ranges", _ASOF)
def asof_merge_ranges(t: Tables) -> DataFrame:
    """The same with a task's share so low that many customers are cut into ranges of their order dates."""
    return _asof(t, 8)


_CHANGED_ORDERS = "o_orderkey % 11 = 0 OR o_orderkey % 13 = 0"


@query(
    "maintained_summary",
    """
    SELECT priority, order_year, count(*) AS n_rows, CAST(sum(amount) AS DECIMAL(38,2)) AS amount FROM
      (SELECT CASE WHEN o_orderkey % 13 = 0 THEN '5-LOW' ELSE o_orderpriority END AS priority, CAST(year(o_orderdate) AS INTEGER) AS order_year,
              CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS amount
       FROM orders WHERE NOT (o_orderkey % 11 = 0 AND o_orderkey % 13 <> 0))
    GROUP BY 1, 2
    """,
)
def maintained_summary(t: Tables) -> DataFrame:
    """Stored sums by priority and year after a batch that deletes orders and moves others to another group."""
    orders = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("order_year"), money("o_totalprice").alias("amount"))
    groups, values = ["priority", "order_year"], {"amount": "amount"}
    stored = summaries.summarise(orders, groups, values)
    keys = orders.where(_CHANGED_ORDERS).select("o_orderkey")
    moved = orders.where("o_orderkey % 13 = 0").withColumns({"priority": F.lit("5-LOW"), "amount": (F.col("amount") + 1).cast("decimal(18,2)")})
    delta = summaries.batch_delta(summaries.replaced_rows(orders, keys, "o_orderkey"), moved, groups, values)
    after = summaries.apply_delta(stored, delta, groups, values)
    return summaries.totals(after, groups, values).select(*groups, "n_rows", "amount")


def _numbered_days(rows: DataFrame) -> DataFrame:
    """Every order day of a customer as a version that holds until the next, numbered from 1."""
    days = rows.select("o_custkey", "day").distinct()
    return sequences.with_position(sequences.validity(days, "o_custkey", "day"), "o_custkey", "day", "version")


@query(
    "stale_versions",
    """
    WITH a AS (SELECT o_custkey, day, row_number() OVER w AS version, coalesce(lead(day) OVER w - 1, DATE '9999-12-31') AS valid_to
               FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY day)),
    b AS (SELECT o_custkey, day, row_number() OVER w AS version, coalesce(lead(day) OVER w - 1, DATE '9999-12-31') AS valid_to
          FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 29 <> 0) WINDOW w AS (PARTITION BY o_custkey ORDER BY day))
    SELECT o_orderkey, o.o_custkey FROM orders o
    LEFT JOIN a ON a.o_custkey = o.o_custkey AND CAST(o_orderdate AS DATE) BETWEEN a.day AND a.valid_to
    LEFT JOIN b ON b.o_custkey = o.o_custkey AND CAST(o_orderdate AS DATE) BETWEEN b.day AND b.valid_to
    WHERE a.version IS DISTINCT FROM b.version
    """,
)
def stale_versions(t: Tables) -> DataFrame:
    """Orders that late rows of their customer moved to another version number."""
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    before, after = _numbered_days(rows.where("o_orderkey % 29 <> 0")), _numbered_days(rows)
    changed = histories.changed_ranges(before, after, "o_custkey", "day", "valid_to", "version")
    return histories.stale_facts(rows, changed, "o_custkey", "day").select("o_orderkey", "o_custkey")
