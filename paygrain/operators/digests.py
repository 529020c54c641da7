"""Differences between a source and its copy, found from order-free digests.

Each side is summed up by itself: per bucket of keys the number of rows, the exclusive-or and the sum of their
hashes, with partial sums before the only shuffle, which carries one row per bucket and task. Buckets that agree are
done with. Those that differ are cut finer, and only what differs there is compared row by row. This finds what a
watermark cannot: rows deleted at the source, commits that never arrived, and changes that left no newer time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of each of the two levels.
BUCKETS = 1024
_SIDE = "_digest_"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), F.col(key)), F.lit(buckets))


def digests(df: DataFrame, key: str, columns: Sequence[str], buckets: int) -> DataFrame:
    """bucket, rows, x, s: equal for two sides exactly when (but for a collision of 128 bits) their rows there are."""
    row = F.xxhash64(*[F.col(c) for c in columns])
    other = F.xxhash64(F.lit(7), *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])
    hashed = df.select(_bucket(key, buckets).alias("bucket"), row.alias("h"), F.shiftright(other, 20).alias("o"))
    return hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.bit_xor("h").alias("x"), F.sum("o").alias("s"))


def differing(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], buckets: int) -> list[int]:
    """The buckets in which the sides differ, at most ``buckets`` numbers."""
    a, b = (digests(df, key, columns, buckets) for df in (source, target))
    both = a.alias("a").join(b.alias("b"), "bucket", "full")
    same = F.expr("a.rows <=> b.rows AND a.x <=> b.x AND a.s <=> b.s")
    return sorted(r[0] for r in both.where(~same).select("bucket").collect())


def drift(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``key`` and ``status`` of every row that differs: ``missing`` in the target, ``deleted`` at the source, ``altered``.

    Keys are unique on both sides and not null. Two equal sides cost one grouping each; no row is shuffled then.
    """
    columns = list(columns or source.columns)
    first = differing(source, target, key, columns, buckets)
    if not first:
        return source.select(key, F.lit("").alias("status")).where("false")
    near = lambda df: df.where(_bucket(key, buckets).isin(first))
    fine = differing(near(source), near(target), key, columns, buckets * buckets)
    left, right = (
        near(df).where(_bucket(key, buckets * buckets).isin(fine)).select(key, F.struct(*columns).alias(f"{_SIDE}{i}"))
        for i, df in enumerate((source, target))
    )
    pairs = left.join(right, key, "full")
    a, b = F.col(f"{_SIDE}0"), F.col(f"{_SIDE}1")
    status = F.when(b.isNull(), "missing").when(a.isNull(), "deleted").when(~a.eqNullSafe(b), "altered")
    return pairs.select(key, status.alias("status")).where("status IS NOT NULL")
