"""Remove lines that many sites share (boilerplate), by their spread over distinct sites.

A line is what stands between newlines, without the white space (code points 0x20 and 0x09 to 0x0D) at its ends, so a
site that ends its lines with a carriage return has the same lines as others; blank lines are never removed.  HyperLogLog
sketches of the sites of each line hash merge by aggregation, first inside each task, so a line
found in a third of all documents is a few small rows per task.  Lines whose estimate is near
the threshold get an exact distinct count; lines far from it are decided by the sketch, whose
error is far smaller than the distance.

One document keeps each shared line (the smallest doc_id, then digest of the text), so a passage
is never lost from the corpus.  Everything runs on built-in functions.

Cases: a null text stays null, an empty one empty; a null source is no site; documents equal
in doc_id and text are treated alike and all keep a line they own; a document whose lines all go
keeps an empty text; an empty table gives an empty result; other columns stay as they are,
except for ``n_lines`` and ``n_removed`` where they are asked for.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.tables import text_key
from tillwise.sources.workspace import stored

#: White space besides the space that may stand inside a line.
ODD_SPACES = "\t\r\x0b\x0c"
#: Sites that make a line boilerplate.
MIN_SITES = 3
#: Log2 of the sketch's registers; its standard error is 1.04 / sqrt(2**LG_K), 1.6 %.
LG_K = 12
#: Estimates within so many standard errors (and one site at least) are counted exactly.
ERRORS = 6
#: Groups that each shared line's documents are dealt to when they are looked up.
SALTS = 32


def trimmed(line: Column) -> Column:
    """Without white space at its ends; the slower trim by a set of characters only where one of them is met."""
    plain, odd = F.trim(line), F.lit(False)
    for c in ODD_SPACES:
        odd = odd | F.startswith(plain, F.lit(c)) | F.endswith(plain, F.lit(c))
    return F.when(odd, F.trim(plain, F.lit(f" {ODD_SPACES}"))).otherwise(plain)


def line_hash(line: Column) -> Column:
    """128 bits of a trimmed line, so that different lines do not meet even among 10^12 of them."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def document_lines(docs: DataFrame) -> DataFrame:
    """One row per non-blank line: line_a, line_b (its hash), site, doc_id, doc_key."""
    rows = docs.filter(F.col("text").isNotNull()).select(
        F.col("doc_id"),
        F.col("source").alias("site"),
        text_key(F.col("text")).alias("doc_key"),
        F.explode(_lines(F.col("text"))).alias("line"),
    )
    rows = rows.withColumn("line", trimmed(F.col("line"))).filter("line <> ''").withColumn("h", line_hash(F.col("line")))
    return rows.select(F.col("h.a").alias("line_a"), F.col("h.b").alias("line_b"), "site", "doc_id", "doc_key")


def shared_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Lines on at least ``min_sites`` sites, with the document that keeps each of them."""
    margin = max(1.0, ERRORS * 1.04 / 2 ** (LG_K / 2) * min_sites)
    owner = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_key"))
    spread = lines.groupBy("line_a", "line_b").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("estimate"),
        F.count(F.lit(1)).alias("occurrences"),
        owner.alias("owner"),
    )
    # A line found once is on one site at most.
    likely = spread.filter((F.col("occurrences") > 1) & (F.col("estimate") >= min_sites - margin))
    likely = stored(likely, "line-spread")
    near = likely.filter(F.col("estimate") <= min_sites + margin).select("line_a", "line_b")
    # Distinct inside each task first: a line of a third of all documents is a few rows per site.
    exact = (
        lines.select("line_a", "line_b", "site")
        .distinct()
        .join(near, ["line_a", "line_b"], "left_semi")
        .groupBy("line_a", "line_b")
        .agg(F.count("site").alias("sites"))
        .filter(F.col("sites") >= min_sites)
        .select("line_a", "line_b")
    )
    far = likely.filter(F.col("estimate") > min_sites + margin).select("line_a", "line_b")
    found = likely.join(far.unionByName(exact), ["line_a", "line_b"], "left_semi")
    return stored(found.select("line_a", "line_b", "owner.doc_id", "owner.doc_key"), "shared-lines")


def without_shared_lines(docs: DataFrame, min_sites: int = MIN_SITES, counts: bool = False) -> DataFrame:
    """``docs`` with shared lines taken out of their texts; with ``counts`` also n_lines and n_removed."""
    lines = document_lines(docs)
    shared = shared_lines(lines, min_sites).withColumnsRenamed({"doc_id": "owner_id", "doc_key": "owner_key"})
    owned = F.col("doc_id").eqNullSafe(F.col("owner_id")) & (F.col("doc_key") == F.col("owner_key"))
    # A line of a third of all documents is met in ``SALTS`` groups, not in one.
    shared = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id", "doc_key"), F.lit(SALTS)).cast("int"))
    hits = (
        salted.join(shared, ["line_a", "line_b", "salt"])
        .filter(~owned)
        .groupBy(F.col("doc_id").alias("hit_id"), F.col("doc_key").alias("hit_key"))
        .agg(F.collect_set(F.struct(F.col("line_a").alias("a"), F.col("line_b").alias("b"))).alias("hit_lines"))
    )
    # The document travels as one struct, so no name of its columns can clash.
    own, text = F.col("doc"), F.col("doc.text")
    same = own["doc_id"].eqNullSafe(F.col("hit_id")) & (text_key(text) == F.col("hit_key"))
    joined = docs.select(F.struct("*").alias("doc")).join(hits, same, "left")
    kept = F.filter(_lines(text), lambda line: ~F.array_contains(F.col("hit_lines"), line_hash(trimmed(line))))
    cleaned = F.when(F.col("hit_lines").isNull(), text).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(text.isNull(), 0).otherwise(F.size(_lines(text))).cast("long")
    n_kept = F.when(F.col("hit_lines").isNull(), n_lines).otherwise(F.size(kept))
    made = joined.select("doc", cleaned.alias("new_text"), n_lines.alias("all_lines"), n_kept.alias("kept_lines"))
    results = {"text": F.col("new_text")}
    if counts:
        removed = (F.col("all_lines") - F.col("kept_lines")).cast("long")
        results |= {"n_lines": F.col("all_lines"), "n_removed": removed}
    old = [c for c in docs.columns if c == "text" or c.lower() not in results]
    new = [n for n in results if n != "text"]
    return made.select(*[results.get(c, own[c]).alias(c) for c in old], *[results[n].alias(n) for n in new])
