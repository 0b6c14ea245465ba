"""Quintile scores and rule tables as column expressions."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwise.constants import CLTV_BANDS, QUINTILES, RFM_SEGMENTS


def cuts_reached(value: Column, cuts: Column, *, low_is_good: bool = False) -> Column:
    """How many of the ascending quintile cut points the value reaches."""
    points = [cuts[i] for i in range(len(QUINTILES))]
    passed = [value <= p if low_is_good else value >= p for p in points]
    return sum((hit.cast("int") for hit in passed[1:]), passed[0].cast("int"))


def quintile_score(value: Column, cuts: Column, *, low_is_good: bool = False) -> Column:
    return F.coalesce(cuts_reached(value, cuts, low_is_good=low_is_good), F.lit(0)) + F.lit(1)


def first_match(rules: Sequence[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(condition, F.lit(label)) for condition, label in rules])


def rfm_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    return first_match(
        [
            (recency.between(*r) & frequency.between(*f) & monetary.between(*m), name)
            for name, r, f, m in RFM_SEGMENTS
        ]
    )


def cltv_band(value: Column, cuts: Column) -> Column:
    reached = F.coalesce(cuts_reached(value, cuts), F.lit(0))
    return F.element_at(F.array(*map(F.lit, CLTV_BANDS)), reached + F.lit(1))
