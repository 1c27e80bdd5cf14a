"""Divisions with an explicit result for zero and missing operands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: weeks of sale reported for stock that does not sell.
NEVER_SELLS_OUT = 9999.0


def ratio(top: Column, bottom: Column, by_zero: float = 0.0, missing: float = 0.0) -> Column:
    """``top / bottom``; ``by_zero`` for x/0, ``missing`` for 0/0 or a null operand."""
    zero_case = F.when(top == 0, F.lit(missing)).otherwise(F.lit(by_zero))
    return (
        F.when(top.isNull() | bottom.isNull(), F.lit(missing))
        .when(bottom == 0, zero_case)
        .otherwise(F.try_divide(top.cast("double"), bottom.cast("double")))
    )


def ratio_or_null(top: Column, bottom: Column) -> Column:
    """Plain quotient, null where it is undefined."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def relative_drop(high: Column, low: Column, base: Column) -> Column:
    """``(high - low) / base`` floored at zero; undefined counts as zero."""
    return F.greatest(F.coalesce(ratio_or_null(high - low, base), F.lit(0.0)), F.lit(0.0))


def weeks_of_sale(quantity: Column, daily_rate: Column) -> Column:
    """Weeks until the stock is gone at the given daily rate."""
    return ratio(quantity, daily_rate * 7, by_zero=NEVER_SELLS_OUT)


def is_true(condition: Column) -> Column:
    """A comparison with null counts as false."""
    return F.coalesce(condition, F.lit(False))
