"""Surrogate keys and reproducible draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*parts: Column | str) -> Column:
    """md5 of the parts joined by a bar; the same input gives the same key on every run."""
    return F.md5(F.concat_ws("|", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]))


def unit_draw(*parts: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) fixed by its key.

    Every joined key that the draw belongs to must be passed. The value then survives
    retries and re-planning, which ``rand()`` does not.
    """
    return F.pmod(F.xxhash64(*parts, F.lit(seed)), F.lit(1_000_000)) / F.lit(1_000_000.0)


def portable_draw(*parts: Column | str, label: int = 0) -> Column:
    """As ``unit_draw``, in steps of 1/10000 and from md5, so that other engines can repeat it."""
    return _md5_number(*parts, label=label) % 10_000 / F.lit(10_000.0)


def hash_percent(*parts: Column | str) -> Column:
    """A whole number 0..99 fixed by the key, for percent sampling."""
    return (_md5_number(*parts) % 100).cast("int")


def _md5_number(*parts: Column | str, label: int | None = None) -> Column:
    named = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    if label is not None:
        named.append(F.lit(str(label)))
    # Seven hex digits: below 2^28, so the number is the same wherever it is computed.
    return F.conv(F.substring(F.md5(F.concat_ws("|", *named)), 1, 7), 16, 10).cast("long")
