"""Where each key of a partitioned table lies, without reading the table.

The index is a table of (key, partition) beside the fact, in buckets of neighbouring keys. Source keys are numbers
that grow, so the keys of a batch, new ones and corrections of recent ones, fall into few buckets, and only these
are read and rewritten. Keys of other types are dealt to a fixed number of buckets by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import files

#: Keys of a bucket, where they are whole numbers; buckets, where they are not.
WIDTH, HASHED = 4_000_000, 4096
#: A batch that falls into more buckets than this reads the whole index instead of naming them.
MAX_NAMED = 10_000
_BUCKET = "_bucket"


class KeyIndex:
    def __init__(self, spark: SparkSession, table_path: str, key: str, partition: str, width: int = WIDTH):
        self.spark, self.table_path, self.key, self.partition, self.width = spark, table_path, key, partition, width
        self.path = f"{table_path}._keys"

    def _bucket(self, df: DataFrame) -> Column:
        if isinstance(df.schema[self.key].dataType, T.IntegralType):
            return F.floor(F.col(self.key) / self.width).cast("long")
        return F.pmod(F.xxhash64(self.key), F.lit(HASHED)).cast("long")

    def _write(self, rows: DataFrame) -> None:
        (
            rows.repartition(_BUCKET).sortWithinPartitions(_BUCKET, self.key)
            .write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
            .partitionBy(_BUCKET).parquet(self.path)
        )

    def _read(self, keys: DataFrame) -> DataFrame:
        """The index in the buckets that the keys fall into."""
        index = self.spark.read.parquet(self.path)
        named = [r[0] for r in keys.select(self._bucket(keys).alias(_BUCKET)).distinct().limit(MAX_NAMED + 1).collect()]
        return index if len(named) > MAX_NAMED else index.where(F.col(_BUCKET).isin(named))

    def forget(self) -> None:
        """Drop the index, before the table is written in another way; it is built again when it is next needed."""
        files.remove(self.spark, self.path)

    def ensure(self) -> None:
        """Build the index from the table, once."""
        if files.exists(self.spark, f"{self.path}/_SUCCESS"):
            return
        rows = self.spark.read.parquet(self.table_path).select(self.key, self.partition)
        self._write(rows.withColumn(_BUCKET, self._bucket(rows)))

    def homes(self, keys: DataFrame) -> DataFrame:
        """The partitions in which keys lie, as the last commit left them."""
        self.ensure()
        return self._read(keys).join(keys.select(self.key), self.key, "left_semi").select(self.partition)

    def record(self, keys: DataFrame, touched: list) -> None:
        """Take in where the keys lie now, all of them in ``touched`` partitions: rewrites the keys' buckets.

        Runs after the table is written. If it does not get that far, the old homes are still listed, and the
        repeated batch names the new ones itself and in its intent.
        """
        table = self.spark.read.parquet(self.table_path).where(F.col(self.partition).isin(touched))
        now = table.select(self.key, self.partition).join(keys.select(self.key), self.key, "left_semi")
        before = self._read(keys).drop(_BUCKET).join(keys.select(self.key), self.key, "left_anti")
        merged = before.unionByName(now)
        merged = merged.withColumn(_BUCKET, self._bucket(merged))
        beside = f"{self.path}._once"
        merged.write.mode("overwrite").parquet(beside)
        self._write(self.spark.read.schema(merged.schema).parquet(beside))
        files.remove(self.spark, beside)
