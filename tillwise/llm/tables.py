"""Small helpers that the operators of this folder share."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Code points 0x20 and 0x09 to 0x0D separate words, nothing else does.
WORD = "[^\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text as long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def replacing(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with the named columns at the end; older columns of these names (in any case) go.

    The expressions must not refer to a column that is replaced.
    """
    names = {n.lower() for n in columns}
    kept = [df[f"`{c}`"] for c in df.columns if c.lower() not in names]
    return df.select(*kept, *[e.alias(n) for n, e in columns.items()])


def text_key(text: Column) -> Column:
    """128-bit digest that stands for a text in joins; null stays null."""
    return F.md5(text)


def numbered(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with ``copy``: 0, 1, 2, ... for the rows that agree in ``keys`` (null as a value like others).

    ``row`` must hold stored values of ``monotonically_increasing_id()``.  Rows are counted inside the tasks that wrote
    them and tasks by their counts, so no key is sorted in one task, however many rows it has.
    """
    packed = rows.withColumn("same", F.struct(*keys)).withColumn("task", F.shiftright("row", 33))
    in_tasks = packed.groupBy("same", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("same").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task and key.
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    firsts = in_tasks.select(F.col("same").alias("first_same"), F.col("task").alias("first_task"), before)
    inside = F.row_number().over(Window.partitionBy("same", "task").orderBy("row")) - 1
    here = F.col("same").eqNullSafe(F.col("first_same")) & (F.col("task") == F.col("first_task"))
    found = packed.withColumn("inside_task", inside).join(firsts, here)
    return found.select(*[F.col(c) for c in rows.columns], (F.col("before") + F.col("inside_task")).alias("copy"))
