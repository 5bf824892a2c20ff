"""Amounts as decimals, so that sums do not depend on the order in which tasks deliver the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Amounts have up to 22 digits before and 6 after the point; others are no valid amounts.
AMOUNT = "decimal(28,6)"
#: Sums have ten digits more, enough for ten billion of the largest amounts.
TOTAL = "decimal(38,6)"


def fitting(number: Column) -> Column:
    """The double if ``AMOUNT`` holds it without rounding, else NULL."""
    return F.when(number.try_cast(AMOUNT).cast("double") == number, number)


def exact_sum(amount: Column) -> Column:
    """Sum of doubles that are amounts (see ``fitting``), the same on every run.

    Doubles are added as decimals, whose sum is exact in any order, and the total becomes a
    double once. A total beyond ``TOTAL`` is an error, never a silent NULL, whatever the
    session's settings.
    """
    total = F.try_sum(amount.cast(AMOUNT).cast(TOTAL))
    missing = F.raise_error(F.lit("a sum of amounts exceeds its type"))
    return F.when(F.count(amount) > 0, F.coalesce(total, missing.cast(TOTAL))).cast("double")
