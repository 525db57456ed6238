"""Mixing sources to target weights (Efraimidis-Spirakis sampling).

A source's target is its share of all words by weight, at most
``MAX_EPOCHS`` times its own size; what a cap leaves over is shared again by
weight among the others (water filling).  A target of ``e`` whole sizes and
a rest takes every document of the source ``e`` times; the rest is filled in
the order of the exponential keys ``-ln(u) / quality weight`` (smallest
first, which is Efraimidis-Spirakis order), prefix-summed to the word
budget; the document that crosses the budget gives its first words only.

``u`` is a hash of the document's id and the seed, so reruns agree.

The prefix sums never put a source into one task: keys are mapped to one of
``BUCKETS`` equal slices of their distribution, sizes are pre-aggregated per
(source, slice), the slices are summed up per source, and only the slice
that a budget ends in is ordered row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.common import materialise, prepare, read_table, unused

#: Fixed values of the contract: weights of the sources in order, cap.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"
SEED = 7_919
BUCKETS = 4096
#: Quality weight of a document: labelled good, labelled poor, not labelled.
GOOD, POOR, UNLABELLED = 2.0, 0.5, 1.0


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size`` -> plus ``target`` (double).  One row per source.

    With weights w and caps c = MAX_EPOCHS * size, the reshared targets are
    min(c, L * w) for the level L at which they add up to the whole.
    Sources are capped in the order of c / w, so L follows from running
    sums: it is the level at the first source in this order that is not capped.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]),
                     ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))
    s = sizes.withColumn("_w", w).withColumn("_cap", (F.col("source_size") * MAX_EPOCHS).cast("double"))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight_left = F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    total = F.sum("source_size").over(whole).cast("double")
    s = s.withColumn("_level", (total - capped) / weight_left)
    # up to the first uncapped source the level rises, after it it falls
    level = F.max(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))).over(whole)
    share = F.least(F.col("_cap"), F.coalesce(level, F.lit(0.0)) * F.col("_w"))
    return s.select("source", "source_size", share.alias("target"))


def mix_sized(sized: DataFrame, *, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, epochs, part, taken`` for every row
    of ``doc_id, source, size, weight``: ``epochs`` whole copies and the
    first ``part`` words of one more.

    ``weight`` is the quality weight; null, zero, negative and NaN weights
    count as 1.  A size of 0 (null or empty text) is never taken; null
    sources form one source, last in order; rows with equal keys are ordered
    by id, then size, so repeated rows get shares of their own; an empty
    table gives an empty result; of the other columns only ``keep`` is passed on.
    """
    keep = keep or []
    prepare(sized.sparkSession)
    w = F.col("weight").cast("double")
    w = F.when((w > 0) & ~F.isnan(w), w).otherwise(1.0)
    # 53 random bits, in (0, 1)
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11).cast("double") + 0.5) / float(1 << 53)
    rows = materialise(sized.select("doc_id", "source", "size", *keep, (-F.log(u) / w).alias("_key"))
                       .withColumn("_slice", F.floor((1 - F.exp(-F.col("_key"))) * BUCKETS).cast("int")))
    per_slice = materialise(rows.groupBy("source", "_slice").agg(F.sum("size").alias("_in")))
    goals = targets(per_slice.groupBy("source").agg(F.sum("_in").alias("source_size")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    goals = goals.withColumn("epochs", whole).withColumn(
        "_rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint"))
    ahead = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    p = per_slice.withColumn("_before", F.coalesce(F.sum("_in").over(ahead), F.lit(0))).alias("p")
    g = goals.alias("g")
    plan = p.join(g, F.col("p.source").eqNullSafe(F.col("g.source"))).select(
        "p.source", "_slice", "_in", "_before", "source_size", "target", "epochs", "_rest")
    r, q = rows.alias("r"), plan.alias("q")
    joined = r.join(q, F.col("r.source").eqNullSafe(F.col("q.source")) & (F.col("r._slice") == F.col("q._slice"))).select(
        "r.doc_id", "r.source", "size", *keep, "_key", "r._slice", "_in", "_before", "_rest", "source_size", "target", "epochs")
    at_end = (F.col("_before") < F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_in"))
    out = ["doc_id", "source", "size", *keep, "source_size", "target", "epochs"]
    clear = joined.where(~at_end).select(*out, F.when(
        F.col("_before") + F.col("_in") <= F.col("_rest"), F.col("size")).otherwise(F.lit(0)).alias("part"))
    order = (Window.partitionBy("source", "_slice").orderBy("_key", "doc_id", "size", *keep)
             .rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("_rest") - F.col("_before") - F.coalesce(F.sum("size").over(order), F.lit(0))
    edge = joined.where(at_end).withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), left))).select(*out, "part")
    return clear.unionByName(edge).withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))


def with_quality(sized: DataFrame, labels: DataFrame) -> DataFrame:
    """``sized`` with ``weight``: GOOD, POOR or UNLABELLED (a document that is
    labelled more than once has its best label)."""
    best = labels.where("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").alias("_label_id")).agg(F.max("quality").alias("_q"))
    weight = F.when(F.col("_q") >= 1, GOOD).when(F.col("_q") < 1, POOR).otherwise(UNLABELLED)
    return (sized.join(best, F.col("doc_id") == F.col("_label_id"), "left")
            .withColumn("weight", weight).drop("_label_id", "_q"))


def mix(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``mix_sized`` over the words of whole texts, weighted by ``labels.quality``."""
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return mix_sized(with_quality(sized, labels))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    got = mix(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return got.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs", "part")


def first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its n-th word."""
    space = r"[\x20\x09-\x0D]"
    ends = F.split(text, f"(?<=[^\\x20\\x09-\\x0D])(?={space})", -1)
    return F.array_join(F.slice(ends, F.lit(1), n.cast("int")), "")


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: one row per copy that the mix takes, with the columns of
    ``docs`` and ``copy`` (from 1), ``size``, ``taken``; the copy that crosses its
    source's budget holds the first ``taken`` words of its text.  Columns of ``docs``
    keep their names: if one is called like a new column, the new one gets an underscore.

    Rows that agree in id, source and text are numbered on both sides, so
    each gets the share of one row.  Null and empty texts have no words and are not
    taken; a null source is a source; an empty table gives no rows.
    """
    names = docs.columns
    copy, size, taken = unused(docs, "copy", "size", "taken")
    tagged = docs.select(F.struct(*[F.col(c) for c in names]).alias("_doc"), "doc_id", "source",
                         n_words(F.col("text")).alias("_size"), F.xxhash64("text").alias("_tag"))
    same = Window.partitionBy("doc_id", "source", "_tag").orderBy("_size")
    keyed = tagged.withColumn("_row", F.row_number().over(same))
    sized = tagged.select("doc_id", "source", F.col("_size").alias("size"), "_tag")
    shares = mix_sized(with_quality(sized, read_table(spark, sf_dir, "labels")), keep=["_tag"]).where("taken > 0")
    shares = shares.withColumn("_row", F.row_number().over(
        Window.partitionBy("doc_id", "source", "_tag").orderBy(F.desc("epochs"), F.desc("part"))))
    d, t = keyed.alias("d"), shares.alias("t")
    on = (F.col("d._tag") == F.col("t._tag")) & (F.col("d._row") == F.col("t._row"))
    for c in ("doc_id", "source"):
        on = on & F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}"))
    n_copies = F.col("epochs") + F.when(F.col("part") > 0, 1).otherwise(0)
    out = (d.join(t, on).select("d._doc", F.col("t.size").alias("_size"), "epochs", "part",
                                F.explode(F.sequence(F.lit(1), n_copies.cast("int"))).alias("_copy")))
    whole = F.col("_copy") <= F.col("epochs")
    text = F.col("_doc").getField("text")
    cut = F.when(whole | (F.col("part") == F.col("_size")), text).otherwise(first_words(text, F.col("part")))
    return out.select(*[cut.alias(c) if c == "text" else F.col("_doc").getField(c).alias(c) for c in names],
                      F.col("_copy").alias(copy), F.col("_size").alias(size),
                      F.when(whole, F.col("_size")).otherwise(F.col("part")).alias(taken))
