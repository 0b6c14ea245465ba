"""Connected components of a graph given by its links.

Alternating star contraction: each round points every node's larger neighbours at its smallest
one, then every node's smaller neighbours at the smallest, until only stars remain.  A round
is two aggregations (minima, combined inside each task) and two joins on node ids; rounds are
logarithmic in the longest path.  Every round is a written table, so lineage stays short.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.sources.workspace import stored


def _fingerprint(links: DataFrame) -> tuple:
    """Tells two sets of links apart: their number and two order-free sums."""
    mixed = [F.xxhash64(F.lit(seed), "u", "v").cast("decimal(38,0)") for seed in (1, 2)]
    return tuple(links.agg(F.count(F.lit(1)), *[F.sum(m) for m in mixed]).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    larger = both.join(least, "u").filter(F.col("v") > F.col("u"))
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(least, "u").filter(F.col("v") != F.col("m"))
    moved = others.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node in ``links`` (two columns of longs, any order, repeats allowed).

    The root is the smallest node of the component.  Links of a node to itself and links with
    a null end are ignored; nodes without links have no row; no links, no rows.
    """
    a, b = links.columns
    ordered = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(b).alias("b"), F.col(a).alias("a"))
    ordered = ordered.filter("a is not null and b is not null and u <> v").select("u", "v").distinct()
    current = stored(ordered, "links")
    seen = _fingerprint(current)
    while seen[0]:
        current = stored(_small_star(_large_star(current)), "links")
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
