"""Rules kept in a table: spellings and the name each stands for."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def checked_aliases(aliases: DataFrame) -> DataFrame:
    """(found, wanted), one row per spelling; a spelling with several targets fails the query that uses it.

    Repeated rows are one rule; rows without a spelling or a target are no rule.
    """
    rules = aliases.filter(F.col("found").isNotNull() & F.col("wanted").isNotNull())
    targets = rules.groupBy("found").agg(F.min("wanted").alias("wanted"), F.max("wanted").alias("other"))
    several = F.concat(F.lit("several targets for "), F.col("found"), F.lit(": "), F.col("wanted"), F.lit(", "), F.col("other"))
    wanted = F.when(F.col("wanted") == F.col("other"), F.col("wanted")).otherwise(F.raise_error(several).cast("string"))
    return targets.select("found", wanted.alias("wanted"))


def with_aliases(df: DataFrame, column: str, aliases: DataFrame, key: Column | None = None) -> DataFrame:
    """``df`` with the spellings in ``column`` replaced by what ``aliases(found, wanted)`` says; others stay.

    ``key`` is what is looked up, the column itself unless given.  The rules meet the rows in a left join: the planner
    broadcasts them only where it finds them small, and joins by shuffle beyond, where AQE splits a hot spelling.
    """
    rules = checked_aliases(aliases).select(F.col("found").alias("alias_found"), F.col("wanted").alias("alias_wanted"))
    joined = df.withColumn("alias_key", F.col(column) if key is None else key).join(rules, F.col("alias_key") == F.col("alias_found"), "left")
    replaced = F.coalesce(F.col("alias_wanted"), F.col(column)).alias(column)
    return joined.select(*[replaced if c == column else F.col(c) for c in df.columns])
