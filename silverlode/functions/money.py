"""Money expressions over double columns.

Doubles added in task order give totals that differ in the last bits from run to
run, and after every retried task.  ``exact_sum`` adds values that are whole
cents as 64-bit integers instead, which is order-free and stays in generated
code (a decimal accumulator costs about ten times as much).  Anything else --
fractions of a cent, NaN, infinities, amounts beyond the integer range of a
double -- takes the plain double path, so no value is rounded or dropped.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: below this many units, cents are exact in a double (2**53 / 100).
_CENT_LIMIT = 9.0e13


def money(col: Column) -> Column:
    """Two decimals, halves away from zero."""
    return F.round(col, 2)


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; 0 when the whole is not positive or unknown."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def exact_sum(name: str) -> Column:
    value = F.col(name).cast("double")
    cents = F.rint(value * 100)
    whole_cents = (F.abs(value) < _CENT_LIMIT) & (cents / 100 == value)
    # A NULL value makes `whole_cents` NULL and falls to the second sum, so an
    # all-NULL group is NULL, as with a plain sum.
    in_cents = F.sum(F.when(whole_cents, cents.cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    other = F.sum(F.when(whole_cents, F.lit(0.0)).otherwise(value))
    return in_cents / F.lit(100.0) + other


def exact_avg(name: str) -> Column:
    return F.try_divide(exact_sum(name), F.count(name))
