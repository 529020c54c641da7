"""Bronze loads as a Structured Streaming source.

The query's checkpoint records which load files were consumed, so each run reads only
what is new. A micro-batch may be replayed and rows may arrive late or twice; the upsert
keeps the newest version per key, so neither changes the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.sequences import latest_per_key
from ..sinks.journal import Journal
from ..sinks.key_index import KeyIndex
from ..sinks.tables import journaled_upsert
from ..sources.contracts import Contract


def read_loads(spark: SparkSession, bronze: str, contract: Contract, files_per_batch: int | None = None) -> DataFrame:
    """The table's loads as an unbounded DataFrame with ``load_id``."""
    root = f"{bronze}/{contract.folder}"
    reader = spark.readStream.schema(contract.bronze_schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("basePath", root).parquet(f"{root}/load_id=*")


def upsert_stream(
    loads: DataFrame,
    target: str,
    checkpoint: str,
    key: str,
    order: Callable[[], Sequence[Column]],
    partition: str,
) -> StreamingQuery:
    """Bring ``target`` up to date with every load published so far, then stop.

    ``order`` ranks the versions of a key, newest first. ``partition`` is a column of the
    loads; a micro-batch rewrites only the partitions its keys touch, which a key index tells. A replayed
    micro-batch also rewrites those of the attempt that was cut short.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        newest, spark = latest_per_key(batch, key, order()), batch.sparkSession
        journal, index = Journal(spark, f"{target}._journal"), KeyIndex(spark, target, key, partition)
        journaled_upsert(newest, target, key, partition, journal, {"batch": batch_id}, {"batch": batch_id}, order(), index)

    return (
        loads.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
