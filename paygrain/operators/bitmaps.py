"""Distinct counts that can be added up: exact bitmaps kept at the finest grain.

A count of distinct ids per country and month says nothing about the year or the total. The bitmap of the ids does:
any slicer is a filter on the kept rows and any total an OR of bitmaps, so the fact is read once for all of them. Ids
are whole numbers from 0; each 32,768 of them share one bitmap of 4 KB, which is kept only where one of them occurs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEPT = ("id_bucket", "id_bits")


def distinct_state(df: DataFrame, groups: Sequence[str], id_: str) -> DataFrame:
    """``groups``, the bucket of the ids and their bitmap; null ids do not count. Partial bitmaps are made before the shuffle."""
    rows = df.where(F.col(id_).isNotNull())
    marked = rows.select(*groups, F.bitmap_bucket_number(id_).alias("id_bucket"), F.bitmap_bit_position(id_).alias("_bit"))
    return marked.groupBy(*groups, "id_bucket").agg(F.bitmap_construct_agg("_bit").alias("id_bits"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all rows from the states of parts of them, such as of what is stored and of a batch of inserts."""
    every = states[0]
    for more in states[1:]:
        every = every.unionByName(more)
    groups = [c for c in every.columns if c not in _KEPT]
    return every.groupBy(*groups, "id_bucket").agg(F.bitmap_or_agg("id_bits").alias("id_bits"))


def distinct_counts(state: DataFrame, groups: Sequence[str], out: str) -> DataFrame:
    """Distinct ids per ``groups`` (some of the state's, or none for the total), by OR of bitmaps."""
    joined = state.groupBy(*groups, "id_bucket").agg(F.bitmap_or_agg("id_bits").alias("id_bits"))
    return joined.groupBy(*groups).agg(F.coalesce(F.sum(F.bitmap_count("id_bits")), F.lit(0)).alias(out))
