"""Sums and averages of money that do not depend on row order.

Amounts are doubles in the tables.  Adding doubles gives a result that changes with
partitioning, so amounts are added as decimals and turned back into doubles last.  Ten
places hold what prices have, and 28 digits before the point hold any sum of them.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,10)"


def exact(amount: Column) -> Column:
    return amount.cast(MONEY)


def total(amount: Column) -> Column:
    return F.sum(exact(amount))


def to_cents(value: Column) -> Column:
    """Half-up to two places, still a decimal."""
    return F.round(value, 2)


def mean(total_amount: Column, count: Column) -> Column:
    """Decimal mean; null for no rows."""
    return F.try_divide(total_amount, count.cast("decimal(20,0)"))


def as_double(value: Column) -> Column:
    return value.cast("double")
