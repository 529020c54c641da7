"""Write modes for parquet tables.

No table is read into the driver, and none is rewritten whole for a small batch: an
incremental batch replaces only the partitions that its keys touch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..operators.snapshots import SCD_ID, first_snapshot, is_open, merge_open_versions, snapshot_backfill
from ..operators.upserts import delete_insert, newest_wins
from ..sources import files
from .journal import Journal
from .key_index import KeyIndex


#: An upsert that touches more partitions than this is refused: the column does not partition, it identifies.
MAX_PARTITIONS = 100_000


def _once(df: DataFrame, path: str) -> tuple[DataFrame, str]:
    """Write rows beside the table, to read them as often as needed without computing them again."""
    beside = f"{path}._once-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(beside)
    return df.sparkSession.read.schema(df.schema).parquet(beside), beside


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if files.exists(spark, path) else None


def full_refresh(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a table's content: written beside it, then moved into place."""
    fresh = f"{path}._fresh"
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(fresh)
    files.replace(df.sparkSession, fresh, path)


def upsert_partitions(
    batch: DataFrame,
    path: str,
    key: str,
    partition: str,
    newest_first: Sequence[Column] | None = None,
    index: KeyIndex | None = None,
    also: Sequence = (),
    before: Callable[[list], None] | None = None,
) -> list:
    """Delete-and-insert by ``key`` into a table partitioned by ``partition``; returns the partitions rewritten.

    The partitions to rewrite are those the batch falls into, those where its keys now lie, and those of ``also``.
    Where keys lie says ``index``, which is kept up to date; without one, two columns of the table are read. The rest
    of the table is not touched. Spark stages the new partitions and swaps them in when the job commits. Running the
    same batch twice leaves the same table. The partition column holds whole numbers or dates and must not be NULL.

    With ``newest_first`` a key keeps its newest row of table and batch under that order, for batches that may hold
    older versions than the table does. The batch is computed once. ``before`` is told the partitions first.
    """
    spark = batch.sparkSession
    target = _read(spark, path)
    if target is None:
        if before:
            before([])
        if index:
            index.forget()
        _write_partitions(batch, path, partition)
        return []
    batch, beside = _once(batch, path)
    try:
        return _upsert(target, batch, path, key, partition, newest_first, index, also, before)
    finally:
        files.remove(spark, beside)


def _upsert(
    target: DataFrame,
    batch: DataFrame,
    path: str,
    key: str,
    partition: str,
    newest_first: Sequence[Column] | None,
    index: KeyIndex | None,
    also: Sequence,
    before: Callable[[list], None] | None,
) -> list:
    spark = batch.sparkSession
    keys = batch.select(key)
    old_homes = index.homes(keys) if index else target.select(key, partition).join(keys, key, "left_semi").select(partition)
    homes = old_homes.unionByName(batch.select(partition)).distinct().limit(MAX_PARTITIONS + 1)
    touched = sorted({r[0] for r in homes.collect()} | set(also))
    if len(touched) > MAX_PARTITIONS:
        raise ValueError(f"{partition} has too many values to partition by")
    if before:
        before(touched)
    if not touched:
        return []
    affected = target.where(F.col(partition).isin(touched))
    fresh = batch.select(*target.columns)
    if newest_first is None:
        merged = delete_insert(affected, fresh, key)
    else:
        merged = newest_wins(affected, fresh, key, newest_first)
    # A dynamic overwrite replaces only partitions it writes rows to. One that lost its last
    # row keeps its old files, which tell it apart from the rewritten ones.
    folders = {value: f"{path}/{partition}={value}" for value in touched}
    held = {value: files.children(spark, folder) for value, folder in folders.items()}
    _write_partitions(merged, path, partition)
    for value, folder in folders.items():
        if held[value] and files.children(spark, folder) == held[value]:
            files.remove(spark, folder)
    if index:
        index.record(keys, touched)
    return touched


def journaled_upsert(
    batch: DataFrame,
    path: str,
    key: str,
    partition: str,
    journal: Journal,
    scope: Mapping,
    position: Mapping,
    newest_first: Sequence[Column] | None = None,
    index: KeyIndex | None = None,
) -> None:
    """``upsert_partitions`` as one batch of a journal: intent, write, index, done.

    ``batch`` must hold all that is pending, what open intents were about included. Their partitions are
    rewritten with it, so that no row of a cut commit is left behind.
    """
    unfinished = journal.open_batches()
    kind = batch.schema[partition].dataType
    also = {date.fromisoformat(v) if isinstance(kind, DateType) else v for b in unfinished for v in b.touched}
    if unfinished and index:
        index.forget()  # it may have lost a bucket with them
    begun: list[int] = []
    upsert_partitions(
        batch, path, key, partition, newest_first, index, sorted(also), lambda touched: begun.append(journal.begin(scope, touched))
    )
    journal.finish(begun[0], position, [b.seq for b in unfinished])


def write_snapshot_run(current: DataFrame, path: str, key: str, updated_at: str, run_id: str) -> None:
    """One snapshot run on a table partitioned by ``closed_in``.

    Open versions lie in partition ``open``; a run writes the versions it closes to a partition of its own, so
    closed history is never rewritten. The merge is computed once. Closed rows are written first. A run that
    dies between the two writes leaves versions both closed and open; the next one, under whatever id, closes
    the open ones again and leaves out those that are stored as closed already. A run under an id that was used
    before adds to the partition of that id.
    """
    spark = current.sparkSession
    if not files.exists(spark, path):
        merged = first_snapshot(current, key, updated_at).withColumn("closed_in", F.lit("open"))
        _write_partitions(merged, path, "closed_in")
        return
    stored = read_partitions(spark, path)
    open_rows = stored.where("closed_in = 'open'").drop("closed_in")
    merged, beside = _once(merge_open_versions(open_rows, current, key, updated_at), path)
    try:
        known = stored.where("closed_in <> 'open'").select(SCD_ID)
        closed = merged.where(~is_open()).join(known, SCD_ID, "left_anti").select(*merged.columns)
        closed = closed.withColumn("closed_in", F.lit(run_id))
        if files.exists(spark, f"{path}/closed_in={run_id}"):
            held = stored.where(F.col("closed_in") == run_id)
            both, twice = _once(held.unionByName(closed, allowMissingColumns=True), path)
            try:
                _write_partitions(both, path, "closed_in")
            finally:
                files.remove(spark, twice)
        else:
            _write_partitions(closed, path, "closed_in")
        _write_partitions(merged.where(is_open()).withColumn("closed_in", F.lit("open")), path, "closed_in")
    finally:
        files.remove(spark, beside)


def backfill_snapshot(spark: SparkSession, path: str, current: DataFrame, key: str, column: str) -> int:
    """Fill NULLs of a column on the stored open versions from today's rows; returns how many were filled.

    Only partition ``open`` is read and rewritten, and only if there is something to fill. A second run fills
    nothing.
    """
    open_rows = read_partitions(spark, path).where("closed_in = 'open'").drop("closed_in")
    if column not in open_rows.columns:
        open_rows = open_rows.withColumn(column, F.lit(None).cast(current.schema[column].dataType))
    filled, beside = _once(snapshot_backfill(open_rows, current, key, column), path)
    try:
        count = lambda df: df.where(F.col(column).isNotNull()).count()
        updated = count(filled) - count(open_rows)
        if updated:
            _write_partitions(filled.withColumn("closed_in", F.lit("open")), path, "closed_in")
        return updated
    finally:
        files.remove(spark, beside)


def _write_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions that ``df`` has rows for.

    The rebalance hint gathers a partition's rows into few files, and lets the runtime
    split a partition that is far larger than the others.
    """
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """All versions with the partition they lie in, columns added later included."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return read_partitions(spark, path).drop("closed_in")
