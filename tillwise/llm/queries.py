"""The registered queries of this folder: thin wrappers that derive the required columns."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import (
    benchmark_search,
    bin_packing,
    byte_bpe,
    cover_tree,
    huffman,
    learned_partitions,
    line_dedup,
    mixing,
    ordinal_quality,
    periodic_runs,
    simhash,
    toxic_cnn,
    whitening,
)
from tillwise.llm.tables import read
from tillwise.sources.workspace import new_folder, stored


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_amounts(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(read(spark, sf_dir, "documents")).drop("ids")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = ordinal_quality.train(docs, read(spark, sf_dir, "labels"))
    keep = (F.col("tail_probability") >= ordinal_quality.LEAST_TAIL).alias("keep")
    return ordinal_quality.score(docs, model).select("doc_id", "expected_grade", "tail_probability", keep)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.search(read(spark, sf_dir, "embeddings"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.without_shared_lines(read(spark, sf_dir, "documents"), counts=True)
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_packing.pack_documents(read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_cnn.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(read(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stored(simhash.fingerprints(read(spark, sf_dir, "documents")), "fingerprints")
    shown = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return simhash.classes(prints).select("doc_id", shown.alias("fingerprint"), "component_id")


def op10_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    huffman.write(stored(huffman.token_ids(read(spark, sf_dir, "documents")), "token-ids"), path)
    ids_crc32 = F.crc32("ids").alias("ids_crc32")
    return huffman.read_documents(spark, path).select("doc_id", "start", "n_tokens", ids_crc32)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read(spark, sf_dir, "embeddings"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.without_repeats(periodic_runs.with_planted_repeats(read(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[n].cast("string") for n in ("start", "length", "period")]), F.lit("\n")))
    top = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[top[n].alias(n) for n in ("start", "length", "period")],
        F.floor(top["length"] * 1000 / top["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_search.occurrences(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"])
    # A null id is written as an empty string.
    ids = F.sort_array(F.transform("items", lambda i: F.coalesce(i.cast("string"), F.lit(""))))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


QUERIES = {
    q.__name__: q
    for q in (
        op1_mix_sources,
        op2_byte_bpe,
        op3_quality,
        op4_nearest,
        op5_line_dedup,
        op6_shards,
        op7_toxicity,
        op8_cover_tree,
        op9_simhash,
        op10_huffman,
        op11_whitening,
        op12_runs,
        op13_benchmark,
    )
}
