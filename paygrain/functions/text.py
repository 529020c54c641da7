"""Text clean-up for codes that arrive in mixed case or with stray blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_text(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.upper(F.trim(value))


def is_dirty(value: Column | str) -> Column:
    """True where the stored bytes differ from the normalized form."""
    value = F.col(value) if isinstance(value, str) else value
    return value != normalize_text(value)
