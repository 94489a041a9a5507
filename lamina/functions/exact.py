"""Order-independent sums and means of values held as doubles.

A double sum depends on the order in which partitions are merged, so a value that falls on a rounding
tie can come out differently on every run. A value that is a whole number of some unit (a cent, a second
of a minute) is added as that number instead, in a decimal, which is exact and associative. Every other
value (a finer one, a very large one, NaN, infinite) is added beside it as the double it is: nothing is
rounded before it is added, and only a group that holds such a value is a double sum again.

`per` is the number of units in 1: 10,000 for amounts to four decimals, 60 for minutes by the second.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Beyond it, doubles no longer tell neighbouring units apart well; the sum's 28 digits hold 10**18 such rows.
LARGEST_UNITS = 10**10


def units(name: str, per: int) -> Column:
    """The column as a whole number of units, null where it is none."""
    return F.when(_whole(name, per), F.rint(F.col(name) * F.lit(float(per))).cast("decimal(18,0)"))


def beyond(name: str, per: int) -> Column:
    """The column where `units` leaves it out."""
    return F.when(~_whole(name, per), F.col(name))


def total(unit_sum: Column, beyond_sum: Column, per: int, places: int) -> Column:
    """Sums of `units` and `beyond` -> double, rounded half up."""
    exact = unit_sum.cast("decimal(24,0)") / F.lit(per).cast("decimal(10,0)")
    return _either(exact, unit_sum, beyond_sum, per, F.lit(1), places)


def mean(unit_sum: Column, beyond_sum: Column, count: Column, per: int, places: int) -> Column:
    """Sums of `units` and `beyond` over a count -> double, rounded half up; null for no values."""
    values = F.nullif(count, F.lit(0))
    exact = unit_sum.cast("decimal(24,0)") / (values * F.lit(per)).cast("decimal(20,0)")
    return _either(exact, unit_sum, beyond_sum, per, values, places)


def _whole(name: str, per: int) -> Column:
    value, scale = F.col(name), F.lit(float(per))
    return (F.abs(value) <= F.lit(float(LARGEST_UNITS / per))) & (F.rint(value * scale) / scale == value)


def _either(exact: Column, unit_sum: Column, beyond_sum: Column, per: int, count: Column, places: int) -> Column:
    near = F.coalesce(unit_sum.cast("double"), F.lit(0.0)) / F.lit(float(per))
    return F.when(beyond_sum.isNull(), F.round(exact, places).cast("double")).otherwise(
        F.round((near + beyond_sum) / count, places)
    )
