"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and
share the words of all documents; a target stops at ``MAX_EPOCHS`` times its
source's words, and the excess is shared again by weight.

Curriculum: over training time u in [0, 1] the rate of a source is
target * (1 + g * (2u - 1)); g depends on its weight, so heavy sources come
early and light ones late. Its integral, the cumulative demand, is
target * (u + g * (u^2 - u)), and is 1 x target at u = 1. The copies of a
source's documents, epoch after epoch in hash order, lie one after the other on
the axis of words taken; the demand inverted at the middle of a copy is
its training position. Documents are range-sorted by position.

A source takes whole passes over its documents and one partial pass that stops
nearest to its target, so it misses the target by half a document at most, and no
document is taken more than ``MAX_EPOCHS`` times.

Words are counted over whole texts. A null or empty text has size 0, is
taken 0 times if a pass misses it, and moves nothing. Repeated rows are separate rows. The result depends on doc_id and
text only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.prefix import running_total
from hazardlake.llm.staging import bounded, stage

WEIGHTS = [5, 2, 1]
#: Slope g of the curriculum for each weight.
SLOPES = [-0.5, 0.0, 0.5]
MAX_EPOCHS = 3
_GAP = r"[\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, slope, target) from rows (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_total(totals, [F.col("source").asc_nulls_last()], "at")
    kind = F.pmod(F.col("at"), F.lit(len(WEIGHTS))).cast("int") + 1
    src = stage(ranked.select("source", "source_size",
                              F.element_at(F.array(*map(F.lit, WEIGHTS)), kind).alias("weight"),
                              F.element_at(F.array(*map(F.lit, SLOPES)), kind).alias("slope")), "sources")
    total, weights = src.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (total / weights if weights else 0.0), 0
    while weights:
        # Words per unit of weight; a round shares what the sources at their cap leave.
        full = F.col("weight") * level > MAX_EPOCHS * F.col("source_size")
        n, used, rest = src.agg(F.sum(F.when(full, 1).otherwise(0)),
                                F.sum(F.when(full, MAX_EPOCHS * F.col("source_size")).otherwise(0)),
                                F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if n == capped or not rest:
            break
        level, capped = (total - used) / rest, n
    target = F.least((MAX_EPOCHS * F.col("source_size")).cast("double"), F.col("weight") * F.lit(float(level)))
    return src.select("source", "source_size", "slope", target.alias("target"))


def demand_time(share: Column, slope: Column) -> Column:
    """Time u at which ``share`` of a source's words are used up: inverse of u + g (u^2 - u)."""
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * share)
    return F.when(slope == 0, share).otherwise((slope - 1 + root) / F.nullif(2 * slope, F.lit(0.0)))


def mix_plan(docs: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, text_hash, size, source_size, target, taken, copies, positions.

    ``positions`` (ascending) has one training time in [0, 1] for each copy.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sizes = stage(docs.select("doc_id", "source", F.xxhash64(text).alias("text_hash"),
                              F.size(F.array_remove(F.split(text, _GAP), "")).cast("long").alias("size")), "sizes")
    targets = stage(source_targets(sizes), "targets")
    shuffled = F.xxhash64("doc_id", "text_hash")
    placed = running_total(sizes, [shuffled, F.col("doc_id"), F.col("text_hash")], "before",
                           value="size", groups=["source"])
    t = targets.withColumnRenamed("source", "of")
    d = placed.join(bounded(t, 80), placed.source.eqNullSafe(t.of), "left").drop("of")
    passes = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    d = d.withColumn("passes", passes)
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    middle = F.col("before") + F.col("size") / 2
    extra = (F.col("passes") < MAX_EPOCHS) & (middle < rest)
    d = d.withColumn("copies", F.col("passes") + extra.cast("long")).withColumn("middle", middle)
    times = F.transform(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1), lambda k: demand_time(
        F.least(F.lit(1.0), F.try_divide(k * F.col("source_size") + F.col("middle"), F.col("target"))),
        F.col("slope")))
    positions = F.when(F.col("copies") > 0, times).otherwise(F.array().cast("array<double>"))
    return d.select("doc_id", "text_hash", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken"), "copies", positions.alias("positions"))


def training_order(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken, range-sorted by training position."""
    plan = mix_plan(docs).where("copies > 0").select(F.col("doc_id").alias("plan_id"), F.col("text_hash"), "positions")
    plan = stage(plan.dropDuplicates(["plan_id", "text_hash"]), "plan")
    same = docs["doc_id"].eqNullSafe(plan["plan_id"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == plan["text_hash"])
    at = "__training_position"
    copies = docs.join(bounded(plan, 64), same).select(*[docs[c] for c in docs.columns],
                                                       F.explode(plan["positions"]).alias(at))
    return copies.orderBy(at, "doc_id").drop(at)
