"""Observed history: slowly changing rows captured run after run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The column names and open end that readers of the snapshot rely on.
SCD_ID = "dbt_scd_id"
CHANGED_AT = "dbt_updated_at"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
OPEN_END_TS = "9999-12-31 00:00:00"


def open_end_ts() -> Column:
    return F.lit(OPEN_END_TS).cast("timestamp_ntz")


def is_open(prefix: str = "") -> Column:
    return F.col(f"{prefix}{VALID_TO}") == open_end_ts()


def first_snapshot(current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Every row as an open version."""
    return current.withColumns(
        {
            SCD_ID: F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(updated_at).cast("string"))),
            CHANGED_AT: F.col(updated_at),
            VALID_FROM: F.col(updated_at),
            VALID_TO: open_end_ts(),
        }
    )


def merge_open_versions(open_rows: DataFrame, current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Open versions against today's rows: unchanged, closed and new versions.

    One full outer join on the key; each pair yields its old version (still open or now
    closed) and, if today's row is new or newer, a version of its own. A key missing
    today stays open. Columns new in ``current`` are NULL on older versions.
    """
    fresh = first_snapshot(current, key, updated_at)
    columns = list(open_rows.columns) + [c for c in fresh.columns if c not in open_rows.columns]
    o, n = open_rows.alias("o"), fresh.alias("n")
    pairs = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")

    changed = F.col(f"n.{updated_at}") > F.col(f"o.{CHANGED_AT}")
    known, seen = F.col(f"o.{SCD_ID}").isNotNull(), F.col(f"n.{SCD_ID}").isNotNull()
    types = {**{f.name: f.dataType for f in fresh.schema}, **{f.name: f.dataType for f in open_rows.schema}}

    def side(name: str, frame: DataFrame, end: Column) -> Column:
        return F.struct(
            *[
                (
                    end
                    if c == VALID_TO
                    else F.col(f"{name}.{c}")
                    if c in frame.columns
                    else F.lit(None)
                )
                .cast(types[c])
                .alias(c)
                for c in columns
            ]
        )

    old = F.when(known, side("o", open_rows, F.when(changed, F.col(f"n.{updated_at}")).otherwise(F.col(f"o.{VALID_TO}"))))
    new = F.when(seen & (~known | changed), side("n", fresh, open_end_ts()))
    return pairs.select(F.explode(F.array_compact(F.array(old, new))).alias("_row")).select("_row.*")


def snapshot_timestamp(previous: DataFrame | None, current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The snapshot after one more run. Running twice on the same rows changes nothing."""
    if previous is None:
        return first_snapshot(current, key, updated_at)
    closed = previous.where(~is_open())
    merged = merge_open_versions(previous.where(is_open()), current, key, updated_at)
    return merged.unionByName(closed, allowMissingColumns=True)


def snapshot_backfill(snapshot: DataFrame, current: DataFrame, key: str, column: str) -> DataFrame:
    """Fill NULLs of ``column`` on open versions from today's rows; closed ones stay unknown.

    Only the rows to be filled take part in the join.
    """
    needs = is_open() & F.col(column).isNull()
    value = current.where(F.col(column).isNotNull()).select(key, F.col(column).alias("_fill"))
    filled = (
        snapshot.where(needs)
        .join(value, key, "left")
        .withColumn(column, F.col("_fill"))
        .select(*snapshot.columns)
    )
    return snapshot.where(~needs).unionByName(filled)
