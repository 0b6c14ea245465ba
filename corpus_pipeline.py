"""The corpus pipeline: quality, line dedup, near-dedup, mixing, encoding.

Every stage takes all documents that its predecessor kept and returns the columns of
``documents``; the last one returns the encoded mix: doc_id, ids (packed), n_tokens and the digests of
the ids and of the bytes they decode to, one row per copy that the mix takes.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import byte_bpe, line_dedup, mixing, ordinal_quality, text_overlap
from tillwise.llm.tables import read
from tillwise.sources.workspace import stored


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones among them, does not reject."""
    return ordinal_quality.accepted(docs, read(spark, sf_dir, "labels"))


def remove_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines found on several sites stay in one document only."""
    cleaned = line_dedup.without_shared_lines(docs)
    return cleaned.withColumn("n_chars", F.length("text")) if "n_chars" in docs.columns else cleaned


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard index of 0.8 or more.

    SimHash fingerprints find links first, minhashes those beyond their reach; all are checked exactly.
    """
    return text_overlap.overlap_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; the better its expected grade, the likelier a document is."""
    grade = "mix_grade"
    while grade.lower() in {c.lower() for c in docs.columns}:
        grade += "_"
    # Fitted on all documents: among those that were accepted hardly any has the lower grade.
    model = ordinal_quality.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    packed = ordinal_quality.score(docs.select(F.struct("*").alias("doc"), "text"), model)
    graded = stored(packed.select("doc.*", F.col("expected_grade").alias(grade)), "graded")
    return mixing.mix_documents(graded, F.col(grade)).drop(grade)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document and proof that they decode to its text."""
    return byte_bpe.encode_documents(docs)


STAGES = [
    ("quality classifier", accept_quality),
    ("line dedup", remove_shared_lines),
    ("near-dedup", keep_one_of_each),
    ("mixing sources to target weights", mix),
    ("byte-level BPE", encode),
]

#: SQL cannot express the classifier, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{place}")
    return docs
