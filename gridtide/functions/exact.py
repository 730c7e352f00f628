"""Sums and averages that do not depend on row order.

A sum of doubles changes in its last digits with the order in which tasks finish, so a
rerun after a lost executor would not reproduce it.  What decimals can hold of a value (six
digits after the point keeps a megawatt reading to the watt) is summed exactly; what they
cannot is summed beside it, so that nothing is left out, however large or small.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

DIGITS = 28


def as_decimal(value: Column, scale: int = 6) -> Column:
    """Value for running sums; NaN is missing, and what no decimal holds is an error."""
    number = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    too_large = F.concat(F.lit("value out of range of a running sum: "), number.cast("string"))
    return F.when(F.abs(number) >= 10.0 ** (DIGITS - scale), F.raise_error(too_large)).otherwise(
        value.try_cast(f"decimal({DIGITS},{scale})")
    )


def exact_sum(value: Column, scale: int = 6) -> Column:
    """Sum of the values present, NULL when there are none; NaN and infinity carry through."""
    number = value.try_cast(f"decimal({DIGITS},{scale})")
    rest = value.cast("double") - F.coalesce(number.cast("double"), F.lit(0.0))
    return F.coalesce(F.sum(number).cast("double"), F.lit(0.0)) + F.sum(rest)


def exact_avg(value: Column, scale: int = 6) -> Column:
    """Average of the values present, NULL when there are none."""
    return exact_sum(value, scale) / F.nullif(F.count(value), F.lit(0)).cast("double")


def running_sum(value: Column, over: WindowSpec, scale: int = 6) -> Column:
    return F.sum(as_decimal(value, scale)).over(over).cast("double")
