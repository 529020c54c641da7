"""Date arithmetic with the conventions of the payroll marts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def open_end() -> Column:
    """The date that stands for "still in force"."""
    return F.lit(OPEN_END).cast("date")


def moment(value: datetime) -> Column:
    """A timestamp without zone as a literal. ``F.lit`` would read it in the driver's own zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def date_key(day: Column | str) -> Column:
    """yyyymmdd as an integer. Plain arithmetic, so no string is built per row."""
    day = _col(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "month")


def month_end(day: Column | str) -> Column:
    return F.last_day(_col(day))


def sunday_zero_dow(day: Column | str) -> Column:
    """Day of week with Sunday as 0 (the built-in counts from 1)."""
    return (F.dayofweek(_col(day)) - 1).cast("int")


def completed_years(start: Column | str, end: Column | str) -> Column:
    """Whole years between two dates; a year counts once its anniversary is reached."""
    start, end = _col(start), _col(end)
    calendar_years = F.year(end) - F.year(start)
    anniversary = F.add_months(start, calendar_years * 12)
    return (calendar_years - F.when(anniversary > end, 1).otherwise(0)).cast("int")


def days_since_anniversary(start: Column | str, end: Column | str) -> Column:
    """Days from the last anniversary of ``start`` up to ``end``."""
    start, end = _col(start), _col(end)
    return F.datediff(end, F.add_months(start, completed_years(start, end) * 12))


def inclusive_days(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start)) + 1


def at_second(day: Column | str, seconds: Column | int) -> Column:
    """The timestamp that lies ``seconds`` after midnight of ``day``."""
    seconds = F.lit(seconds) if isinstance(seconds, int) else seconds
    midnight = _col(day).cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds.cast("int"), midnight)
