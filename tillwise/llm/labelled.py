"""Bounded, repeatable samples of labelled documents for fitting classifiers."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the doc_id as text, modulo ``folds``; null for null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def sampled(labels: DataFrame, label: str, most: int, *, per_class: bool = False) -> DataFrame:
    """doc_id and ``label`` of at most ``most`` labelled documents (of each class), by a hash of the id.

    Rows with a null id or label are left out; a document labelled more than once has its largest label.
    """
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    if not per_class:
        return rows.orderBy(*order).limit(most)
    taken = [rows.filter(F.col(label) == c).orderBy(*order).limit(most) for c in (0, 1)]
    return taken[0].unionByName(taken[1])


def one_text_each(docs: DataFrame, chosen: DataFrame, *columns: str, bounded: bool = True) -> DataFrame:
    """The rows of ``chosen`` with ``columns`` and text of one document of that id; a ``bounded`` number of ids goes to every task.

    Where an id is on several rows, that with the smallest digest of the text counts; the others never leave their tasks'
    aggregates, so the bound on ids is one on rows, even if an id holds a third of the table.
    """
    kept = docs.select("doc_id", F.struct(*columns, "text").alias("doc"), F.coalesce(F.md5("text"), F.lit("")).alias("digest"))
    met = kept.join(F.broadcast(chosen) if bounded else chosen, "doc_id")
    return met.groupBy(*chosen.columns).agg(F.min_by("doc", "digest").alias("doc")).select(*chosen.columns, "doc.*")
