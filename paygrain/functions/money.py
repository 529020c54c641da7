"""Money is decimal(18,2) from the source to the marts, never a float."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(18,2)"


def money(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.cast(MONEY_TYPE)


def sign_of(concept_type: Column | str) -> Column:
    """+1 for an earning, -1 for anything else."""
    concept_type = F.col(concept_type) if isinstance(concept_type, str) else concept_type
    return F.when(concept_type == "EARNING", 1).otherwise(-1).cast("int")


def signed(amount: Column | str, sign: Column | str) -> Column:
    amount = F.col(amount) if isinstance(amount, str) else amount
    sign = F.col(sign) if isinstance(sign, str) else sign
    return money(amount * sign)


def periods_per_month(pay_frequency: Column | str) -> Column:
    pay_frequency = F.col(pay_frequency) if isinstance(pay_frequency, str) else pay_frequency
    return F.when(pay_frequency == "BIWEEKLY", 2).otherwise(1).cast("int")
