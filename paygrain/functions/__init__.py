"""Column functions; all of them stay inside whole-stage code generation."""

from .dates import (  # noqa: F401
    OPEN_END,
    completed_years,
    date_key,
    days_since_anniversary,
    inclusive_days,
    month_end,
    month_start,
    sunday_zero_dow,
)
from .keys import hash_percent, surrogate_key, unit_draw  # noqa: F401
from .money import money, signed  # noqa: F401
from .text import is_dirty, normalize_text  # noqa: F401
