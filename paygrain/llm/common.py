"""Helpers the operators share: tables in the shared folder, Arrow columns in tasks, row keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrain.session import scratch_path
from paygrain.sources import files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the folder all executors share and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation, and
    the rows are computed once however often they are used.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_written(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more."""
    files.remove(spark, path)


def row_hash(df: DataFrame) -> Column:
    """A number made from all columns of the row, to tell rows with one id apart."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return df.mapInArrow(work, schema)


def binary(column: pa.Array) -> pa.Array:
    """The UTF-8 bytes of a string column; nulls become empty."""
    return column.cast(pa.large_binary()).fill_null(b"")


def strings(column: pa.Array) -> list[str]:
    """The texts of a string column; nulls become empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def _cuts(texts: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, n in enumerate(pa.compute.binary_length(texts).fill_null(0).to_pylist()):
        if held and held + n > max_bytes:
            yield start, i - start
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts) - start


def pieces(texts: pa.Array, max_bytes: int = 4 << 20) -> Iterator[pa.Array]:
    """The same texts in arrays of at most ``max_bytes``, or of one text if it is longer."""
    for start, n in _cuts(texts, max_bytes):
        yield texts.slice(start, n)


def sliced(batches: Iterator[pa.RecordBatch], column: int, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts are at most ``max_bytes`` together, or one row if it is longer."""
    for batch in batches:
        for start, n in _cuts(batch.column(column), max_bytes):
            yield batch.slice(start, n)
