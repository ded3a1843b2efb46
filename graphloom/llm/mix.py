"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash of its id and text. A source takes the documents
below a threshold, so a larger budget takes a superset of a smaller one. The threshold is
found by sums of words over 4,096 hash ranges per source; the range in which the budget
ends is divided again (only its own rows are read on) until it holds one unit, which is
taken if that brings the source nearer to its target. Documents are then filtered by their
own hash: no sort, no join of texts.

Defined cases: a null text has size 0; null is a source of its own, after all others; rows
equal in id and text are one unit (taken together, since no hash tells them apart); a
source without words takes nothing and its target is 0; an empty table gives an empty
result; further columns of the input are left as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import hex_long, numbered, stage, word_count

HASH_BITS = 60
STEP_BITS = 12  # 4,096 ranges a source and level


def doc_hash(doc_id: Column, text: Column) -> Column:
    """60-bit hash of id and text (an MD5 prefix, so that other engines can follow it)."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.md5(text), F.lit("")))
    return hex_long(F.md5(key), 1, HASH_BITS // 4)


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Targets per source: (source, source_size, target) from (source, source_size).

    Weights go round the sources in code-point order, null last. The budget is ``share``
    times all sizes; a target stops at ``most`` times its source's size, and the excess is
    shared by weight among the others, again and again until none is above. The level
    (target per weight) only rises, and only two sums come to the driver in each round.
    """
    ranked = numbered(sizes, [F.col("source").isNull(), F.col("source")], "place")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = stage(ranked.select("source", "source_size", F.get(cycle, (F.col("place") % len(weights)).cast("int")).alias("weight"),
                                 (F.col("source_size") * F.lit(float(most))).alias("cap")), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        above = F.col("weight") * F.lit(level) > F.col("cap")
        capped, free = ranked.agg(F.sum(F.when(above, F.col("cap")).otherwise(0.0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if not free:
            break
        new = (share * total - capped) / free
        if new <= level:
            break
        level = new
    return ranked.select("source", "source_size", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def thresholds(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, cut): every document of the source is taken
    ``whole`` times, those with a hash below ``cut`` once more.

    ``docs`` has (source, size, hash). Each level sums the words of 4,096 ranges per source
    and goes on with the rows of the one range in which the rest of the budget ends.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = targets.withColumn("whole", whole.cast("long"))
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    state = stage(plan.select("source", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("spent")), "level")
    for left in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        own = state.select(F.col("source").alias("_s"), "rest", "prefix", "spent")
        inside = docs.where("size > 0").join(own, F.col("source").eqNullSafe(F.col("_s")) & (F.shiftright("hash", left + STEP_BITS) == F.col("prefix")))
        ranges = inside.groupBy("source", F.shiftright("hash", left).alias("range")).agg(
            F.first("rest").alias("rest"), F.first("spent").alias("spent"), F.sum("size").alias("words"),
            (F.min("hash") == F.max("hash")).alias("single"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("range"))
        ends = ranges.withColumn("upto", F.col("spent") + upto).where(F.col("upto") > F.col("rest"))
        first = ends.groupBy("source").agg(F.min(F.struct("range", "upto", "words", "single", "rest")).alias("at"))
        state = stage(first.select("source", F.col("at.rest").alias("rest"), F.col("at.range").alias("prefix"),
                                   (F.col("at.upto") - F.col("at.words")).alias("spent"), F.col("at.words").alias("words"),
                                   F.col("at.single").alias("single")), "level")
        if left == 0 or state.where(~F.col("single")).isEmpty():
            break
    nearer = 2 * (F.col("l.rest") - F.col("spent")) > F.col("words")
    cut = F.shiftleft(F.col("prefix") + F.when(nearer, 1).otherwise(0), left)
    joined = plan.alias("p").join(state.alias("l"), F.col("p.source").eqNullSafe(F.col("l.source")), "left")
    return joined.select("p.source", "source_size", "target", "whole", F.coalesce(cut, F.lit(0)).cast("long").alias("cut"))


def copies(hash_: Column, size: Column) -> Column:
    """How often a document is taken; one without words has no part in the rest of a budget."""
    return (F.col("whole") + F.when((hash_ < F.col("cut")) & (size > 0), 1).otherwise(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    return stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), doc_hash(F.col("doc_id"), F.col("text")).alias("hash")), "sizes")


def plan_mix(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Thresholds of all sources of a ``sized`` table."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    return stage(thresholds(sizes, source_targets(sources, weights, share, most)), "plan")


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mixed corpus: the rows of ``docs`` with all their columns, taken rows repeated."""
    plan = plan_mix(sized(docs), weights, share, most).select(F.col("source").alias("_source"), "whole", "cut")
    n = copies(doc_hash(F.col("text_id"), F.col("text_of")), word_count(F.col("text_of")))
    own = docs.select(F.struct("*").alias("row"), F.col("source").alias("source_of"), F.col("doc_id").alias("text_id"), F.col("text").alias("text_of"))
    taken = own.join(plan, F.col("source_of").eqNullSafe(F.col("_source"))).select("row", n.alias("n")).where("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("row.*")


def mix_report(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: what the mix takes of each row."""
    sizes = sized(docs)
    plan = plan_mix(sizes, weights, share, most).withColumnRenamed("source", "_source")
    joined = sizes.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    return joined.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * copies(F.col("hash"), F.col("size"))).alias("taken"))
