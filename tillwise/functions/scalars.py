"""Values computed over a whole table and used on every row of it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_wide(df: DataFrame, **aggregates: Column) -> Column:
    """Scalar subquery: a struct of the given aggregates over ``df``.

    The largest value of every column is carried along.  With that the subquery needs all
    columns of ``df``, as the table itself does, so both have the same shuffle below them
    and Spark runs it once; a subquery on fewer columns would scan the source again.
    """
    kept = F.struct(*[F.max(F.col(c)).alias(c) for c in df.columns])
    named = [value.alias(name) for name, value in aggregates.items()]
    return df.agg(F.struct(*named, kept.alias("kept"))).scalar()
