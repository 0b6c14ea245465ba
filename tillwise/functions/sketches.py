"""Mergeable sketches kept in tables: quantiles (KLL), distinct values (HLL), and sets that meet (theta).

A table of sketches has one row per key (a day, a country), whatever the lines below it, and coarser tables are merged
from it without reading lines again.  All functions are Spark's own.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: Size of quantile sketches.  Exact up to about this many values.
KLL_K = 4096
#: Logarithm of the size of distinct sketches.
LG_K = 12


def rank_error(k: int = KLL_K) -> float:
    """What a cut point's rank may be off, as a share of all rows.

    The published bound of the sketch holds for 99 of 100 cut points; three times as much is practically never left.
    """
    return 3 * 2.296 / k**0.9723


def distinct_error(lg_k: int = LG_K) -> float:
    """Five standard deviations of a distinct count, relative."""
    return 5 * 1.04 / 2 ** (lg_k / 2)


def _kind(df: DataFrame, measure: str) -> str:
    return "bigint" if isinstance(df.schema[measure].dataType, IntegralType) else "double"


def _typed(df: DataFrame, measure: str) -> Column:
    return F.col(measure).cast(_kind(df, measure))


def quantile_sketch(df: DataFrame, measure: str, k: int = KLL_K) -> Column:
    """Aggregate: the sketch of a numeric column, exact in type; nulls are left out."""
    return getattr(F, f"kll_sketch_agg_{_kind(df, measure)}")(_typed(df, measure), F.lit(k))


def at_shares(sketch: Column, kind: str, at: Sequence[float]) -> Column:
    """The smallest values that cover each share; null for an empty sketch."""
    n = getattr(F, f"kll_sketch_get_n_{kind}")(sketch)
    return F.when(n > 0, getattr(F, f"kll_sketch_get_quantile_{kind}")(sketch, F.array(*[F.lit(float(p)) for p in at])))


def quantile_table(df: DataFrame, measures: Sequence[str], keys: Sequence[str], k: int = KLL_K) -> DataFrame:
    """One row per key: the sketch of each measure, under its name."""
    return df.groupBy(*keys).agg(*[quantile_sketch(df, m, k).alias(m) for m in measures])


def merged_quantiles(table: DataFrame, kinds: Mapping[str, str], at: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Quantiles of coarser keys from a table of sketches: an array of cut points under each measure's name.

    ``kinds`` tells of each measure whether its sketches are of ``bigint`` or ``double``.
    """
    merged = table.groupBy(*keys).agg(*[getattr(F, f"kll_merge_agg_{kind}")(m).alias(m) for m, kind in kinds.items()])
    return merged.select(*keys, *[at_shares(F.col(m), kind, at).alias(m) for m, kind in kinds.items()])


def rank_errors(df: DataFrame, measures: Sequence[str], cuts: Column, at: Sequence[float]) -> DataFrame:
    """(measure, share, n, error): how far the share of rows that each cut point covers is from the one asked for.

    ``cuts`` is a struct of arrays, one for each measure.  One pass over the rows.
    """
    seen = F.col("_cuts")
    counts = [
        F.struct(
            F.lit(m).alias("measure"),
            F.lit(float(p)).alias("share"),
            F.count(m).alias("n"),
            F.count_if(F.col(m) < seen[m][i]).alias("below"),
            F.count_if(F.col(m) <= seen[m][i]).alias("through"),
        )
        for m in measures
        for i, p in enumerate(at)
    ]
    found = df.withColumn("_cuts", cuts).agg(F.array(*counts).alias("found")).select(F.inline("found"))
    wanted = F.col("share") * F.col("n")
    off = F.greatest(wanted - F.col("through"), F.col("below") - wanted, F.lit(0.0))
    return found.select("measure", "share", "n", F.try_divide(off, F.col("n")).alias("error"))


def distinct_table(df: DataFrame, columns: Sequence[str], keys: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """One row per key: for each column an HLL sketch of its values under its name, and a theta sketch as ``set_<name>``."""
    hll = [F.hll_sketch_agg(F.col(c), F.lit(lg_k)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*hll, *[F.theta_sketch_agg(F.col(c), F.lit(lg_k)).alias(f"set_{c}") for c in columns])


def merged_distinct(table: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Distinct counts (estimates, bigint) of coarser keys."""
    return table.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])


def returning(table: DataFrame, column: str, period: Column, keys: Sequence[str] = ()) -> DataFrame:
    """``keys``, period, ``returning`` and ``seen``: values of a period (a whole number) that were there in the one before, and in either.

    One row per period is left when periods meet, whatever the lines; values that null keys share are met too.
    """
    sets = table.groupBy(*keys, period.alias("period")).agg(F.theta_union_agg(f"set_{column}").alias("now"))
    before = sets.select(*[F.col(k).alias(f"before_{k}") for k in keys], (F.col("period") + 1).alias("next"), F.col("now").alias("was"))
    same = F.col("period") == F.col("next")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"before_{key}"))
    both = sets.join(before, same)
    met = F.theta_sketch_estimate(F.theta_intersection("now", "was"))
    return both.select(*keys, "period", met.alias("returning"), F.theta_sketch_estimate(F.theta_union("now", "was")).alias("seen"))


def ks_distance(one: Column, other: Column, kind: str = "double", points: int = 200) -> Column:
    """Largest distance of two distribution functions, from sketches: at most twice ``rank_error`` and 2 / ``points`` off.

    Both functions are compared at evenly spaced quantiles of either; null if a sketch is empty.
    """
    shares = [i / points for i in range(points + 1)]
    sides = [at_shares(sketch, kind, shares) for sketch in (one, other)]

    def apart(place: Column) -> Column:
        below = [F.size(F.filter(side, lambda x: x <= place)) for side in sides]
        return F.abs(below[0] - below[1]) / float(points + 1)

    return F.when(sides[0].isNotNull() & sides[1].isNotNull(), F.array_max(F.transform(F.concat(*sides), apart)))
