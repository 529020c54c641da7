"""Sums and counts that are kept: a batch of delete and insert is applied to them as signed rows.

The old rows of a batch's keys count minus, the new ones plus. Both sides are as large as the batch; the fact is not
read beyond them. Sums must be exact to be taken back, so values are whole numbers or decimals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = "n_rows"


def _named(values: Mapping[str, str]) -> list[str]:
    return [x for out in values for x in (out, f"n_{out}")]


def summarise(df: DataFrame, groups: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """``groups``, n_rows, and for each ``{out: column}`` its sum and ``n_<out>``, the number of values that are not NULL.

    NULL is a group of its own. A sum over no values is 0 here; ``totals`` makes it NULL.
    """
    return _signed(df, groups, values, 1).transform(_added, groups, values)


def _signed(df: DataFrame, groups: Sequence[str], values: Mapping[str, str], sign: int) -> DataFrame:
    for column in values.values():
        if not isinstance(df.schema[column].dataType, T.IntegralType | T.DecimalType):
            raise TypeError(f"{column}: only whole numbers and decimals can be taken back exactly")
    made = []
    for out, column in values.items():
        kind = df.schema[column].dataType
        wide = T.DecimalType(38, kind.scale) if isinstance(kind, T.DecimalType) else T.LongType()
        value = F.coalesce(F.col(column).cast(wide), F.lit(0).cast(wide))
        made += [(value * F.lit(sign)).cast(wide).alias(out), F.when(F.col(column).isNotNull(), sign).otherwise(0).cast("long").alias(f"n_{out}")]
    return df.select(*groups, F.lit(sign).cast("long").alias(ROWS), *made)


def _added(rows: DataFrame, groups: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    types = {c: rows.schema[c].dataType for c in _named(values)}
    sums = [F.sum(c).cast(types[c]).alias(c) for c in types]
    return rows.groupBy(*groups).agg(F.sum(ROWS).alias(ROWS), *sums)


def batch_delta(old: DataFrame, new: DataFrame, groups: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """What a batch changes: its ``old`` rows (replaced or deleted ones) minus, its ``new`` rows plus; no empty changes.

    A row that moves to another group leaves the old one. Rows that do not change cancel out.
    """
    both = _signed(old, groups, values, -1).unionByName(_signed(new, groups, values, 1))
    changed = " OR ".join(f"`{c}` <> 0" for c in [ROWS, *_named(values)])
    return _added(both, groups, values).where(changed)


def apply_delta(stored: DataFrame, delta: DataFrame, groups: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """The stored summary after a batch; groups that lost their last row are removed."""
    return _added(stored.unionByName(delta), groups, values).where(F.col(ROWS) > 0)


def replaced_rows(fact: DataFrame, batch_keys: DataFrame, key: str) -> DataFrame:
    """The fact's rows that a batch replaces or deletes. A NULL key replaces nothing."""
    return fact.join(batch_keys.select(key), key, "left_semi").select(*fact.columns)


def totals(stored: DataFrame, groups: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """Any coarser total of a stored summary, with sums as SQL has them: NULL over no values."""
    found = _added(stored, groups, values)
    return found.select(*groups, ROWS, *[F.when(F.col(f"n_{out}") > 0, F.col(out)).alias(out) for out in values])
