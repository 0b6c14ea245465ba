"""Numbers as text."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Parts of a unit: with three digits the least tie, 0.0005, is above 2^-11, so a double of that size or more is whole in them.
PARTS = 2**63
WHOLE = 2.0**53


def fixed(value: Column, digits: int) -> Column:
    """Fixed decimals, three at most, of the double itself as ``printf`` has them: 0.7875 lies below that and gives 0.787.

    A true tie goes to the even digit (0.8125 gives 0.812).  From 2^63 on the digits are those of the shortest text.
    """
    if not 0 < digits <= 3:
        raise ValueError("one to three digits")
    value, ten = value.cast("double"), 10**digits
    size = F.abs(value)
    # From 2^53 on every double is whole.
    units = F.when(size < WHOLE, F.floor(size))
    parts = ((size - units.cast("double")) * float(PARTS)).try_cast("bigint").cast("decimal(20,0)") * F.lit(Decimal(ten))
    one = F.lit(Decimal(PARTS))
    rest = parts % one
    steps = ((parts - rest) / one).cast("bigint")
    up = (rest * 2 > one) | ((rest * 2 == one) & (steps % 2 == 1))
    cents = steps + up.cast("bigint")
    whole = units + (cents == ten).cast("bigint")
    near = F.concat(whole.cast("string"), F.lit("."), F.lpad((cents % ten).cast("string"), digits, "0"))
    large = F.coalesce(F.when(size < float(PARTS), size.try_cast("bigint")).cast("string"), size.try_cast("decimal(38,0)").cast("string"), size.cast("string"))
    text = F.when(size < WHOLE, near).otherwise(F.concat(large, F.lit("." + "0" * digits)))
    text = F.when(F.isnan(size), "nan").when(size == float("inf"), "inf").otherwise(text)
    return F.concat(F.when(value.cast("string").startswith("-"), "-").otherwise(""), text)
