"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Each document gets the key ``-ln(u) / weight`` with a repeatable uniform ``u``; ascending keys
are a weighted sample without replacement.  A source whose target exceeds its size is first
taken whole as often as it fits (complete epochs); the rest is filled by the documents with
the smallest keys, up to the budget.

Prefix sums need no sort of a whole source: the range of keys in which the budget ends is cut into ``PARTS`` parts, their
totals are summed up, and the part in which it ends is the next range, until it holds at most ``SORTED_ROWS`` rows.  Only
these are sorted, without their texts.  The rest is one comparison of each document's key with its source's plan.  A
source with a third of all rows, or weights as unlike as can be, takes a few turns more.

Cases: an empty table gives an empty result; null texts have size 0; a null source is a source of its own, last in order;
documents without a positive weight get ``LEAST_WEIGHT``; rows repeated in id, text and source get a key each, so any
number of them may be taken; other columns, whatever their names, are kept by ``mix_documents`` and not part of
``mix_amounts``.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.tables import numbered, text_key, word_count
from tillwise.sources.workspace import stored

SOURCE_WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2.0
SORTED_ROWS = 10_000
PARTS = 256
LEAST_WEIGHT = 0.05
SEED = "mix-1"


def letter_share(text: Column) -> Column:
    """A plain quality weight: the share of ASCII letters among the characters, at least ``LEAST_WEIGHT``."""
    letters = F.length(F.regexp_replace(text, "[^A-Za-z]", ""))
    share = letters.cast("double") / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(share, F.lit(LEAST_WEIGHT)), F.lit(LEAST_WEIGHT))


def _uniform(doc_id: Column, key: Column, copy: Column, seed: str) -> Column:
    """In (0, 1], from 52 bits of a digest of the document (and the copy's number above 0); equal on every run."""
    again = F.when(copy > 0, copy.cast("string"))
    digest = F.md5(F.concat_ws("|", F.lit(seed), doc_id.cast("string"), key, again))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1) / float(2**52)


def _slim(docs: DataFrame, weight: Column | None) -> DataFrame:
    """What the plan needs of each document, without keys."""
    weight = letter_share(F.col("text")) if weight is None else weight
    return docs.select(
        F.col("doc_id"),
        F.col("source").alias("mix_source"),
        text_key(F.col("text")).alias("mix_text"),
        word_count(F.col("text")).alias("mix_size"),
        F.when(weight > 0, weight.cast("double")).otherwise(LEAST_WEIGHT).alias("mix_weight"),
    )


_SAME = ("doc_id", "mix_text", "mix_source")


def _alike(rows: DataFrame, repeated: DataFrame) -> Column:
    return reduce(Column.__and__, [rows[c].eqNullSafe(repeated[f"again_{c}"]) for c in _SAME])


def _with_keys(rows: DataFrame, repeated: DataFrame, seed: str, purpose: str) -> DataFrame:
    """``rows`` (with the columns of ``_slim``) and their ``mix_key``; ``repeated`` names those that are not alone."""
    key = (-F.log(_uniform(F.col("doc_id"), F.col("mix_text"), F.col("copy"), seed)) / F.col("mix_weight")).alias("mix_key")
    if repeated.isEmpty():
        return rows.withColumn("copy", F.lit(0)).select(*rows.columns, key)
    alone = rows.join(repeated, _alike(rows, repeated), "left_anti").withColumn("copy", F.lit(0).cast("long"))
    again = rows.join(repeated, _alike(rows, repeated), "left_semi").withColumn("row", F.monotonically_increasing_id())
    again = numbered(stored(again, purpose), *_SAME).drop("row")
    return alone.unionByName(again).select(*rows.columns, key)


def keyed(docs: DataFrame, weight: Column | None = None, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """The stored rows that the plan needs, with their keys, and which documents are on more than one row."""
    slim = stored(_slim(docs, weight), "mix-sizes")
    repeated = slim.groupBy(*_SAME).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = stored(repeated.select(*[F.col(c).alias(f"again_{c}") for c in _SAME]), "mix-repeated")
    return stored(_with_keys(slim, repeated, seed, "mix-copies").drop("mix_text"), "mix-keys"), repeated


def source_targets(
    slim: DataFrame,
    weights: Sequence[int] = SOURCE_WEIGHTS,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
) -> DataFrame:
    """One row per source: its size and the words the mix should take from it.

    Targets share ``share`` times all words by weight; none exceeds ``most`` times its source,
    and what is cut off goes to the others by weight.  That is a common level L with target
    ``min(most * size, L * weight)``; L is found on the sources in the order in which they fill up.
    The windows run over one row per source.
    """
    sums = slim.groupBy("mix_source").agg(
        F.sum("mix_size").alias("source_size"),
        F.count(F.lit(1)).alias("source_rows"),
        F.min("mix_key").alias("low"),
        F.max("mix_key").alias("high"),
    )
    place = F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last())) - 1
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = sums.withColumn("share_weight", turn).withColumn("cap", F.col("source_size") * float(most))
    fills = F.col("cap") / F.col("share_weight")
    everyone = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("fills", F.col("mix_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everyone) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("share_weight").over(everyone) - F.coalesce(F.sum("share_weight").over(before), F.lit(0))
    )
    levels = ranked.withColumn("fills", fills).withColumn("level", level)
    final = F.max(F.when(F.col("fills") >= F.col("level"), F.col("level"))).over(everyone)
    return levels.select(
        "mix_source",
        "source_size",
        "source_rows",
        "low",
        "high",
        F.least(F.col("cap"), final * F.col("share_weight")).alias("target"),
    )


def _in_range(slim: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows whose key lies in the range of their source, with its plan."""
    plan = edges.withColumnRenamed("mix_source", "plan_source")
    joined = slim.join(plan, F.col("mix_source").eqNullSafe(F.col("plan_source")))
    return joined.filter(F.col("mix_key").between(F.col("low"), F.col("high")))


def _narrowed(slim: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges whose range is the part of the old one in which the budget ends (none where it ends nowhere)."""
    width = F.greatest(F.col("high") - F.col("low"), F.lit(1e-300))
    part = F.least(F.floor((F.col("mix_key") - F.col("low")) / width * PARTS), F.lit(PARTS - 1)).alias("part")
    sums = (
        _in_range(slim, edges)
        .groupBy("plan_source", "rest", "before", part)
        .agg(
            F.sum("mix_size").alias("words"),
            F.count(F.lit(1)).alias("rows"),
            F.min("mix_key").alias("part_low"),
            F.max("mix_key").alias("part_high"),
        )
    )
    upto = Window.partitionBy("plan_source").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        sums.withColumn("through", F.col("before") + F.sum("words").over(upto))
        .filter(F.col("through") > F.col("rest"))
        .groupBy("plan_source")
        .agg(F.min_by(F.struct("part_low", "part_high", "rows", (F.col("through") - F.col("words")).alias("until")), "part").alias("end"))
    )
    joined = edges.join(ends, F.col("mix_source").eqNullSafe(F.col("plan_source")), "left")
    kept = [c for c in edges.columns if c not in ("low", "high", "rows", "before")]
    return joined.select(
        *kept, F.col("end.part_low").alias("low"), F.col("end.part_high").alias("high"), F.col("end.rows").alias("rows"), F.col("end.until").alias("before")
    )


def mixing_plan(slim: DataFrame, **targets) -> DataFrame:
    """One row per source: target, complete epochs, and up to which key documents are taken once more.

    The document at the budget's edge is taken when that comes nearer to the budget.
    """
    size = F.greatest(F.col("source_size"), F.lit(1))
    goals = source_targets(slim, **targets).withColumn("epochs", F.floor(F.col("target") / size))
    goals = goals.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    edges = goals.withColumn("rows", F.col("source_rows")).withColumn("before", F.lit(0.0))
    edges = stored(_narrowed(slim, stored(edges, "mix-targets")), "mix-edges")
    # Each turn leaves about one of ``PARTS`` rows; a range of one key cannot be cut.
    while edges.filter((F.col("rows") > SORTED_ROWS) & (F.col("low") < F.col("high"))).limit(1).count():
        edges = stored(_narrowed(slim, edges), "mix-edges")
    # One short range of each source, and of it only keys and sizes.
    order = [F.col("mix_key"), F.col("doc_id").asc_nulls_last(), F.col("mix_size")]
    running = F.sum("mix_size").over(Window.partitionBy("mix_source").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    edge = _in_range(slim, edges).withColumn("running", running)
    cuts = (
        edge.filter(F.col("before") + F.col("running") - F.col("mix_size") / 2 <= F.col("rest"))
        .groupBy(F.col("mix_source").alias("cut_source"))
        .agg(F.max("mix_key").alias("cut_key"))
    )
    plan = edges.join(cuts, F.col("mix_source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")
    return stored(plan, "mix-plan")


def copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with mix_source and mix_key) and how often the mix takes each: ``mix_copies``."""
    once_more = (F.col("mix_key") < F.col("low")) | (F.col("mix_key") <= F.col("cut_key"))
    extra = F.coalesce(once_more, F.lit(False)).cast("long")
    plan = plan.withColumnRenamed("mix_source", "plan_source")
    joined = rows.join(plan, F.col("mix_source").eqNullSafe(F.col("plan_source")))
    return joined.withColumn("mix_copies", F.col("epochs") + extra)


def mix_amounts(docs: DataFrame, weight: Column | None = None, **targets) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs, copies and taken (words) of every document."""
    slim, _ = keyed(docs, weight)
    taken = copies(slim, mixing_plan(slim, **targets))
    return taken.select(
        "doc_id",
        F.col("mix_source").alias("source"),
        F.col("mix_size").alias("size"),
        "source_size",
        "target",
        "epochs",
        F.col("mix_copies").alias("copies"),
        (F.col("mix_copies") * F.col("mix_size")).cast("long").alias("taken"),
    )


def mix_documents(docs: DataFrame, weight: Column | None = None, **targets) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with the columns of ``docs``."""
    slim, repeated = keyed(docs, weight)
    plan = mixing_plan(slim, **targets)
    # The document travels as one struct, so no name of its columns can clash.
    weight = letter_share(F.col("text")) if weight is None else weight
    rows = docs.select(
        F.struct("*").alias("mix_doc"),
        F.col("doc_id"),
        F.col("source").alias("mix_source"),
        text_key(F.col("text")).alias("mix_text"),
        F.when(weight > 0, weight.cast("double")).otherwise(LEAST_WEIGHT).alias("mix_weight"),
    )
    # Documents on more than one row are alike, so the plan holds whichever of them has which number.
    taken = copies(_with_keys(rows, repeated, SEED, "mix-repeated-docs"), plan).filter("mix_copies > 0")
    taken_doc = taken.select("mix_doc", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
    return taken_doc.select("mix_doc.*")
