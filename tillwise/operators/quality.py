"""Null profiles, completeness and outliers, each in one scan."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.types import DoubleType, FloatType

from tillwise.constants import OUTLIER_SIGMAS

MAY_BE_EMPTY = ("CustomerID",)


def missing(df: DataFrame, column: str, *, nan: bool = False) -> Column:
    """Null test; with ``nan`` also NaN, for the column types that can hold it."""
    empty = F.col(column).isNull()
    if nan and isinstance(df.schema[column].dataType, (FloatType, DoubleType)):
        empty = empty | F.isnan(column)
    return empty


def missing_cells(df: DataFrame, names: Sequence[str], *, nan: bool = False) -> Column:
    """Aggregate: empty cells over the named columns; 0 for an empty table."""
    flags = [missing(df, name, nan=nan).cast("bigint") for name in names]
    return F.coalesce(F.sum(sum(flags[1:], flags[0])), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """Half-up to two places; null when there is nothing to divide by."""
    share = F.try_divide(part.cast("decimal(20,0)") * 100, whole.cast("decimal(20,0)"))
    return F.round(share, 2).cast("double")


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column with its null count and the completeness (0..1) of the table."""
    names = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(missing(df, name)).alias(f"n{i}") for i, name in enumerate(names)],
    )
    nulls = [F.col(f"n{i}") for i in range(len(names))]
    cells = F.col("total_rows") * F.lit(len(names))
    share = F.try_divide(sum(nulls[1:], nulls[0]).cast("double"), cells.cast("double"))
    per_column = F.array(
        *[F.struct(F.lit(name).alias("name"), n.alias("n")) for name, n in zip(names, nulls)]
    )
    return counted.select(
        "total_rows",
        (F.lit(1.0) - share).alias("completeness_score"),
        F.explode(per_column).alias("column"),
    ).select(
        F.col("column.name").alias("column_name"),
        F.col("column.n").alias("null_count"),
        "total_rows",
        "completeness_score",
    )


def columns_with_nulls(profile: DataFrame) -> DataFrame:
    """The columns of a null profile that have any."""
    return profile.filter(F.col("null_count") > 0).select("column_name", "null_count")


def completeness_score(counts: DataFrame, columns: int) -> DataFrame:
    """Percentage of filled cells from ``total_rows`` and ``null_cells``."""
    cells = F.col("total_rows") * F.lit(columns)
    return counts.select(
        "total_rows",
        "null_cells",
        percent(cells - F.col("null_cells"), cells).alias("completeness_score"),
    )


def silver_completeness(df: DataFrame, exclude: Sequence[str] = MAY_BE_EMPTY) -> DataFrame:
    """Share of filled cells in percent, leaving out columns that may be empty."""
    names = [name for name in df.columns if name not in exclude]
    counts = df.agg(F.count(F.lit(1)).alias("total_rows"), missing_cells(df, names).alias("null_cells"))
    return completeness_score(counts, len(names))


def quantity_outliers(
    df: DataFrame, column: str = "Quantity", sigmas: int = OUTLIER_SIGMAS
) -> DataFrame:
    """Rows of a whole-number column outside mean ± sigmas; the low limit is at least 0.

    The column is counted by value first: one scan, combined before the shuffle, so a
    frequent value is one row.  Mean and sample deviation come from exact sums over
    those counts, and the outliers are counted on them too.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"{column} is {kind.simpleString()}; outliers are counted for whole numbers")
    values = df.groupBy(F.col(column).cast("bigint").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    value, n = F.col("value").cast("decimal(19,0)"), F.col("n").cast("decimal(18,0)")
    rows, first, second = (F.col(c) for c in ("rows", "first", "second"))
    spread = (second * rows.cast("decimal(18,0)") - first * first).cast("double")
    pairs = rows.cast("double") * (rows - 1).cast("double")
    stats = (
        values.agg(
            F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("rows"),
            F.sum((value * n).cast("decimal(38,0)")).cast("decimal(38,0)").alias("first"),
            F.sum((value * value * n).cast("decimal(38,0)")).cast("decimal(38,0)").alias("second"),
        )
        .select(
            F.struct(
                F.try_divide(first.cast("double"), rows.cast("double")).alias("mean"),
                F.sqrt(F.try_divide(spread, pairs)).alias("deviation"),
            )
        )
    ).scalar()
    mean, deviation = F.col("_stats")["mean"], F.col("_stats")["deviation"]
    high = mean + sigmas * deviation
    low = F.when(deviation.isNotNull(), F.greatest(F.lit(0.0), mean - sigmas * deviation))
    outside = (F.col("value") > high) | (F.col("value") < low)
    return (
        values.withColumn("_stats", stats)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("outlier_count"),
            F.first("_stats").alias("_stats"),
        )
        .select(
            "total_rows",
            "outlier_count",
            percent(F.col("outlier_count"), F.col("total_rows")).alias("outlier_percentage"),
            F.round(mean, 2).alias("mean_quantity"),
            F.round(deviation, 2).alias("stddev_quantity"),
        )
    )
