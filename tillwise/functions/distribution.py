"""Ranks and quantiles over a whole table without sorting it in one task.

Each measure is first reduced to its distinct values with their counts, so a value that
many rows share is one row.  The values are cut into ranges at approximate quantiles;
the running count inside a range plus the count of all ranges ahead of it is the exact
position of every value.
"""

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tillwise.constants import QUINTILES
from tillwise.functions.sketches import at_shares, quantile_sketch, rank_error

RANGES_PER_PARTITION = 4
#: Hash slots whose values are sketched side by side, so that no task merges all sketches.
SKETCHES = 16


def range_count(df: DataFrame) -> int:
    """A few ranges per shuffle partition, so they spread evenly over all tasks."""
    return RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _is_whole(df: DataFrame, measure: str) -> bool:
    return isinstance(df.schema[measure].dataType, IntegralType)


def _exact(df: DataFrame, measure: str) -> Column:
    """The value itself where it is a whole number: doubles are not exact beyond 2^53."""
    return F.col(measure).cast("bigint") if _is_whole(df, measure) else F.lit(None).cast("bigint")


def evaluated(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, where a lambda inside would do it again for every element."""
    return F.transform(F.array(value), use)[0]


def value_positions(df: DataFrame, measures: Sequence[str], *, descending: bool = False) -> DataFrame:
    """Rows ``(measure, value, whole, n, before, rows)`` for numeric columns.

    ``value`` is a double and ``whole`` the exact number of integer columns (else null), which
    tells values apart that are one double.  ``n`` rows hold the value and ``before`` rows lie
    ahead of it, of ``rows`` in all.  In descending order nulls are one value, the last; in
    ascending order they are left out.
    """
    ranges = range_count(df)
    # Bounds only balance the work, so sketches a little finer than the ranges are enough.
    shares, accuracy = [f"{i / ranges!r}D" for i in range(1, ranges)], 10 * ranges
    block = math.isqrt(ranges)
    pairs = [
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"), _exact(df, m).alias("whole"))
        for m in measures
    ]
    values = df.select(F.inline(F.array(*pairs)))
    if not descending:
        values = values.filter(F.col("value").isNotNull())
    counts = values.groupBy("measure", "value", "whole").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.expr(f"array({', '.join(shares)})")
    sketched = counts.groupBy("measure", F.pmod(F.xxhash64("value", "whole"), F.lit(SKETCHES)).alias("slot")).agg(
        F.percentile_approx("value", wanted, F.lit(accuracy)).alias("bounds"), F.sum("n").alias("n")
    )

    def even_bounds(every: Column) -> Column:
        step = F.size(every) / F.lit(ranges)
        places = F.when(F.size(every) > 0, F.sequence(F.lit(1), F.lit(ranges - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.element_at(every, F.greatest(F.ceil(step * i), F.lit(1)).cast("int")))

    def summary(name: str) -> Column:
        of_measure = F.col("measure") == name
        every = F.sort_array(F.flatten(F.collect_list(F.when(of_measure, F.col("bounds")))))
        bounds = evaluated(every, even_bounds)
        last_of_block = evaluated(
            bounds, lambda b: F.slice(F.filter(b, lambda _, i: (i + 1) % block == 0), 1, F.lit(ranges))
        )
        return F.struct(
            bounds.alias("bounds"),
            last_of_block.alias("blocks"),
            F.coalesce(F.sum(F.when(of_measure, F.col("n"))), F.lit(0)).alias("rows"),
        )

    # One row per measure and slot is left, whatever the size of the table.
    overview = sketched.agg(F.create_map(*[part for m in measures for part in (F.lit(m), summary(m))])).scalar()
    seen, value = F.col("_seen"), F.col("value")

    def below(bounds: Column) -> Column:
        return F.coalesce(F.size(F.filter(bounds, lambda b: b < value)), F.lit(0))

    # Whole blocks of bounds first, then inside one block.
    skipped = F.col("_skipped") * block
    inside_block = below(F.slice(seen["bounds"], skipped + 1, F.lit(block)))
    placed = (
        counts.withColumn("_seen", overview[F.col("measure")])
        .withColumn("_skipped", below(seen["blocks"]))
        .select("measure", "value", "whole", "n", seen["rows"].alias("rows"), (skipped + inside_block).alias("range"))
    )
    toward = -F.col("range") if descending else F.col("range")
    ahead = Window.partitionBy("measure").orderBy(toward).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range and measure, whatever the size of the table.
    offsets = (
        placed.groupBy("measure", "range")
        .agg(F.sum("n").alias("_in_range"))
        .select("measure", "range", F.coalesce(F.sum("_in_range").over(ahead), F.lit(0)).alias("offset"))
    )
    keys = [value, F.col("whole")]
    order = [k.desc_nulls_last() if descending else k.asc() for k in keys]
    inside = (
        Window.partitionBy("measure", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.join(offsets, ["measure", "range"]).select(
        "measure",
        "value",
        "whole",
        "n",
        (F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before"),
        "rows",
    )


def with_ranks(df: DataFrame, ranks: Mapping[str, str]) -> DataFrame:
    """Add rank columns: 1 is the largest, ties share a rank and leave a gap, nulls last.

    ``ranks`` maps each new column to the measure it ranks.
    """
    places = value_positions(df, list(ranks.values()), descending=True)
    for name, measure in ranks.items():
        of_measure = places.filter(F.col("measure") == measure).select(
            F.col("value").alias("_value"), F.col("whole").alias("_whole"), (F.col("before") + 1).alias(name)
        )
        same = F.col(measure).cast("double").eqNullSafe(F.col("_value")) & _exact(df, measure).eqNullSafe(F.col("_whole"))
        df = df.join(of_measure, same).drop("_value", "_whole")
    return df


def _wanted(share: float, rows: Column) -> Column:
    """How many rows the cut point of a share has to cover."""
    return F.ceil(F.lit(str(share)).cast("decimal(9,6)") * rows.cast("decimal(20,0)"))


def _sketched_quantiles(df: DataFrame, measures: Sequence[str], at: Sequence[float]) -> Column:
    """One sketch of each measure bounds every cut point; rows between the bounds decide it, so it is exact.

    The bounds' own ranks are counted.  Where a cut point is not between them after all, the rows on its side of
    them decide.
    """
    margin, seen, counted = rank_error(), F.col("_bounds"), F.col("_counted")
    around = [min(max(p + side, 0.0), 1.0) for p in at for side in (-margin, margin)]
    made = df.agg(*[quantile_sketch(df, m).alias(m) for m in measures])
    kinds = {m: "bigint" if _is_whole(df, m) else "double" for m in measures}
    bounds = made.select(F.struct(*[at_shares(F.col(m), kinds[m], around).alias(m) for m in measures])).scalar()
    bounded = df.select(*measures).withColumn("_bounds", bounds)
    spots = [(m, i) for m in measures for i in range(len(at))]
    counts = [
        F.struct(F.count(m).alias("rows"), F.count_if(F.col(m) < seen[m][2 * i]).alias("below"), F.count_if(F.col(m) <= seen[m][2 * i + 1]).alias("through"))
        for m, i in spots
    ]
    bounded = bounded.withColumn("_counted", bounded.agg(F.array(*counts).alias("counted")).scalar())
    near = []
    for spot, (m, i) in enumerate(spots):
        value, low, high, found = F.col(m), seen[m][2 * i], seen[m][2 * i + 1], counted[spot]
        wanted = F.greatest(_wanted(at[i], found["rows"]), F.lit(1))
        early, late = found["below"] >= wanted, found["through"] < wanted
        near.append(
            F.struct(
                F.lit(spot).alias("spot"),
                value.cast("double").alias("value"),
                _exact(df, m).alias("whole"),
                (wanted - F.when(early, 0).when(late, found["through"]).otherwise(found["below"])).alias("missing"),
                F.when(early, value < low).when(late, value > high).otherwise((value >= low) & (value <= high)).alias("inside"),
            )
        )
    values = bounded.select(F.inline(F.filter(F.array(*near), lambda x: x["inside"])))
    values = values.groupBy("spot", "value", "whole", "missing").agg(F.count(F.lit(1)).alias("n"))
    # Between its bounds each cut point has twice ``rank_error()`` of the rows, equal ones once.
    through = F.sum("n").over(Window.partitionBy("spot").orderBy("value", "whole").rowsBetween(Window.unboundedPreceding, 0))
    reached = values.withColumn("through", through).filter(F.col("through") >= F.col("missing"))

    def cut(spot: int, measure: str) -> Column:
        return F.min(F.when(F.col("spot") == spot, F.col("whole") if _is_whole(df, measure) else F.col("value")))

    cuts = {m: F.array(*[cut(spot, m) for spot, (own, _) in enumerate(spots) if own == m]) for m in measures}
    return reached.agg(F.struct(*[cuts[m].alias(m) for m in measures])).scalar()


def quantiles(
    df: DataFrame, measures: Sequence[str], at: Sequence[float] = QUINTILES, *, sketch: bool = False
) -> Column:
    """Scalar struct of arrays: per measure the smallest values that cover each share.

    ``sketch`` merges one quantile sketch per measure instead of counting the positions of all values; only those
    near a cut point are shuffled.  Both are exact.
    """
    if sketch:
        return _sketched_quantiles(df, measures, at)
    through = F.col("before") + F.col("n")
    wanted = [_wanted(p, F.col("rows")) for p in at]

    def cuts(measure: str) -> Column:
        mine = F.col("measure") == measure
        value = F.col("whole") if _is_whole(df, measure) else F.col("value")
        return F.array(*[F.min(F.when(mine & (through >= w), value)) for w in wanted])

    return value_positions(df, measures).agg(F.struct(*[cuts(m).alias(m) for m in measures])).scalar()
