"""Shards by vector bin packing: bytes, tokens and rows balanced jointly.

Documents with equal texts are a group and stay in one shard, unless the group is larger than a
shard: then it is split into pieces.  Each group is placed, largest first, where the dot
product of its sizes with the residual capacity is highest.

Placing is sequential, so it works on a bounded list: groups above 1 / ``LOTS`` of any total stand
alone (at most 3 * ``LOTS`` of them, as each dimension has at most ``LOTS``), the others
are put together by hash into ``LOTS`` bundles.  Groups with many rows are cut into lots of about
1 / ``LOTS`` of all rows, so that numbering rows inside lots never sorts a large group in one task: by their ids, and
where one id (or none) has more rows than a lot, by the copy's number, which is counted inside the tasks first.
Lots, at most 5 * ``LOTS`` plus pieces, are all that comes to the driver and all that is broadcast.

Cases: a null text has no bytes or tokens, size 1 and checksum 0, and its group is apart from the
empty text's; repeated rows are rows of their own; null doc_ids are an id like others; an empty table
gives an empty result; other columns are not part of the result.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.tables import numbered, text_key, word_count
from tillwise.sources.workspace import stored

SHARDS = 16
LOTS = 4096
#: Bytes weigh more than tokens and rows: they are what must come out near equal.
WEIGHTS = (4.0, 1.0, 1.0)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, tokens, text_crc32, group_key and row (a number of its own) of every document."""
    raw = F.col("text").cast("binary")
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(raw), F.lit(0)) + 1).cast("long").alias("size"),
        word_count(F.col("text")).alias("tokens"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(text_key(F.col("text")), F.lit("null")).alias("group_key"),
        F.monotonically_increasing_id().alias("row"),
    )


def _sums() -> list:
    return [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]


def place(sizes: np.ndarray, shards: int = SHARDS) -> np.ndarray:
    """Shard of each item; ``sizes`` has a row per item and a column per dimension."""
    totals = np.maximum(sizes.sum(axis=0, dtype=np.float64), 1)
    share = sizes / totals * np.array(WEIGHTS)
    residual = np.tile(np.array(WEIGHTS) / shards, (shards, 1))
    out = np.zeros(len(sizes), np.int64)
    for i in np.argsort(-share.max(axis=1, initial=0), kind="stable"):
        best = int(np.argmax(residual @ share[i]))
        out[i] = best
        residual[best] -= share[i]
    return out


def _with_copies(known: DataFrame) -> DataFrame:
    """``copy``: from 0 on for rows that share group and id, where they are more than a lot or piece; else 0.

    Rows that share both are alike, so it does not matter which of them has which number.
    """
    grouped = known.filter("pieces is not null").groupBy("group_key", "doc_id", "pieces", "parts", "group_rows")
    # At most as many as there are lots and pieces.
    often = grouped.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * F.greatest("pieces", "parts") > F.col("group_rows"))
    often = stored(often.select(F.col("group_key").alias("often_key"), F.col("doc_id").alias("often_id")), "often-repeated")
    same = (F.col("group_key") == F.col("often_key")) & F.col("doc_id").eqNullSafe(F.col("often_id"))
    task = F.shiftright("row", 33).alias("task")
    alike = known.join(F.broadcast(often), same).select(*known.columns)
    counted = numbered(alike, "group_key", "doc_id")
    rest = known.join(F.broadcast(often), same, "left_anti").withColumn("copy", F.lit(0).cast("long"))
    return rest.unionByName(counted)


def packed(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows of ``sized`` with shard and slot (gapless from 0 in each shard)."""
    spark = rows.sparkSession
    totals = rows.agg(*_sums()).first()
    all_rows = max(totals["rows"] or 0, 1)
    over = [F.col(c) * LOTS > max(totals[c] or 0, 1) for c in ("bytes", "tokens", "rows")]
    largest = F.greatest(*[F.col(c) / max(totals[c] or 0, 1) for c in ("bytes", "tokens", "rows")])
    heavy = stored(
        rows.groupBy("group_key")
        .agg(*_sums())
        .filter(over[0] | over[1] | over[2])
        .select(
            "group_key",
            F.when(largest * shards > 1, F.ceil(largest * shards * 4)).otherwise(1).cast("int").alias("pieces"),
            F.ceil(F.col("rows") * LOTS / all_rows).cast("int").alias("parts"),
            F.col("rows").alias("group_rows"),
        ),
        "heavy-groups",
    )
    # At most 3 * LOTS rows; see above.
    known = _with_copies(rows.join(F.broadcast(heavy), "group_key", "left"))
    pieces = F.coalesce("pieces", F.lit(1))
    n_parts = pieces * F.ceil(F.coalesce("parts", F.lit(1)) / pieces)
    part = F.pmod(F.pmod(F.xxhash64("doc_id"), n_parts) + F.col("copy"), n_parts).cast("int")
    bundle = F.concat(F.lit("bundle-"), F.pmod(F.xxhash64("group_key"), F.lit(LOTS)).cast("string"))
    dealt = (
        known.withColumn("part", F.when(F.col("pieces").isNull(), 0).otherwise(part))
        .withColumn("item", F.when(F.col("pieces").isNull(), bundle).otherwise(F.col("group_key")))
        .withColumn("piece", F.pmod("part", pieces))
        .drop("pieces", "parts", "group_rows", "copy")
    )
    lots = dealt.groupBy("item", "piece", "part").agg(*_sums()).toPandas()
    lots = lots.sort_values(["item", "piece", "part"]).reset_index(drop=True)
    items = lots.groupby(["item", "piece"], sort=True)[["bytes", "tokens", "rows"]].sum().reset_index()
    items["shard"] = place(items[["bytes", "tokens", "rows"]].to_numpy(np.float64), shards)
    lots = lots.merge(items[["item", "piece", "shard"]], on=["item", "piece"])
    lots["first"] = lots.groupby("shard")["rows"].cumsum() - lots["rows"] if len(lots) else pd.Series(dtype="int64")
    chosen = [(r.item, int(r.part), int(r.shard), int(r.first)) for r in lots.itertuples()]
    table = spark.createDataFrame(chosen, "item string, part int, shard int, first long")
    order = Window.partitionBy("item", "part").orderBy("group_key", F.col("doc_id").asc_nulls_first(), "size")
    placed = dealt.withColumn("inside", F.row_number().over(order) - 1).join(F.broadcast(table), ["item", "part"])
    return placed.withColumn("slot", (F.col("first") + F.col("inside")).cast("long"))


def pack_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    placed = packed(stored(sized(docs), "sized-documents"), shards)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
