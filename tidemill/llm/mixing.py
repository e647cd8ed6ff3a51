"""Mixing sources to target weights: Efraimidis-Spirakis sampling to word budgets, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize

_UNIT = 1 << 52


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """A plain quality weight in (0, 1]: the share of a text's characters that are not digits or symbols."""
    odd = F.length(F.translate(text, "#*$%&|<>0123456789{}[]\\^~=+@_", ""))
    return F.coalesce(F.greatest(odd / F.greatest(F.length(text), F.lit(1)), F.lit(0.05)), F.lit(1.0))


def uniform(row: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the row's name and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.coalesce(row.cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) / float(_UNIT)


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, source: str = "source") -> DataFrame:
    """From (source, source_size) to (source, source_size, weight, target).

    Sources in code point order, null last, take the weights in turn. Targets share the sum of all sizes by weight;
    none is above `most` times its source's size. In order of most * size / weight, a source is held at its limit
    if what the sources before it leave, shared by weight, reaches that limit; the rest share what is then left.
    One row for each source: small next to the documents.
    """
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    x = sizes.withColumn("weight", w).withColumn("limit", F.col("source_size") * most)
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col(source).asc_nulls_last())
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("all_size", F.sum("source_size").over(whole)).withColumn("all_weight", F.sum("weight").over(whole))
    x = x.withColumn("level", (F.col("all_size") - F.coalesce(F.sum("limit").over(before), F.lit(0))) / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    x = x.withColumn("held", F.col("limit") <= F.col("level") * F.col("weight"))
    held = F.coalesce(F.sum(F.when(F.col("held"), F.col("limit"))).over(whole), F.lit(0))
    free = F.coalesce(F.sum(F.when(~F.col("held"), F.col("weight"))).over(whole), F.lit(0))
    target = F.when(F.col("held"), F.col("limit").cast("double")).otherwise((F.col("all_size") - held) * F.col("weight") / free)
    return x.select(source, "source_size", "weight", target.cast("double").alias("target"))


def mix_sources(
    docs: DataFrame, size: Column | None = None, quality: Column | None = None, weights: tuple[int, ...] = (1, 2, 3), most: int = 3,
    seed: int = 7, slots: int = 4096, most_sent: int = 10_000, doc_id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """All rows of docs with size, source_size, target and taken: how many words of each the mix takes.

    A source's target is whole epochs, in which all its documents are taken, and a rest. For the rest, documents
    in ascending order of -ln(u) / quality are taken while their sizes' sum stays within it (a weighted sample
    without replacement), and then one more, the one whose size comes nearest to what is still missing, if it
    brings the sum nearer. u comes from the document's id, so reruns agree.

    The order within a source is never one task's sort: keys fall into `slots` slots of equal expected count, the
    slots are summed and prefix-summed (sources x slots rows), and only the one slot that the budget ends in is
    sorted. Tables of one row a source are broadcast if they are counted to hold at most `most_sent`; more are joined
    by shuffles. Taking the nearest size last bends the sampling law for that one document of a source. Null texts have size 0 and are taken 0 words; a null quality counts as 1; a null source is a source.
    Rows that repeat whole tie: all of them are in, or none. Columns of docs with the added names are replaced.
    """
    added = ("size", "source_size", "target", "taken")
    own = [c for c in docs.columns if c not in added and not c.startswith("_m_")]
    q = F.lit(1.0) if quality is None else F.coalesce(quality, F.lit(1.0))
    x = docs.withColumns({"_m_size": word_count(F.col(text)) if size is None else size, "_m_q": q}).select(
        *own, F.col("_m_size").alias("size"), (-F.log(uniform(F.col(doc_id), seed)) / F.col("_m_q")).alias("_m_key"), F.xxhash64(text).alias("_m_text")
    )
    # exp(-key) is uniform where quality is 1; any monotone slotting is right, an even one is fast.
    x = x.withColumn("_m_slot", F.least(F.floor((1 - F.exp(-F.col("_m_key"))) * slots), F.lit(slots - 1)).cast("int"))
    narrow = materialize(x.select(F.col(source).alias("source"), F.col(doc_id).alias("id"), "size", "_m_key", "_m_text", "_m_slot"), "sizes")

    order = F.struct("_m_key", "id", "_m_text")
    per_slot = narrow.groupBy("source", "_m_slot").agg(F.sum("size").alias("sum"))
    goal = targets(per_slot.groupBy("source").agg(F.sum("sum").alias("source_size")), weights, most)
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("long"))
    goal = materialize(goal.withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")), "goals")
    few = goal.count() <= most_sent

    # The slot that the rest ends in, and what the slots before it hold.
    upto = per_slot.withColumn("upto", F.sum("sum").over(Window.partitionBy("source").orderBy("_m_slot")))
    ends = _join(upto, goal.select("source", "rest"), few).where("upto > rest").groupBy("source").agg(
        F.min("_m_slot").alias("slot"), F.min_by(F.col("upto") - F.col("sum"), "_m_slot").alias("used")
    )
    goal = _join(goal, ends, few, "left").withColumn("slot", F.coalesce("slot", F.lit(slots))).withColumn("used", F.coalesce("used", "rest"))
    edge = _join(narrow, goal.select("source", "slot", "used", "rest"), few).where("_m_slot = slot")
    # The default frame takes equal rows together, so that they are decided alike.
    edge = edge.withColumn("upto", F.col("used") + F.sum("size").over(Window.partitionBy("source").orderBy("_m_key", "id", "_m_text")))
    bound = edge.where("upto <= rest").groupBy("source").agg(F.max(order).alias("bound"), F.max("upto").alias("filled"))
    goal = _join(goal, bound, few, "left").withColumn("lack", F.col("rest") - F.coalesce("filled", "used"))

    within = (F.col("_m_slot") < F.col("slot")) | ((F.col("_m_slot") == F.col("slot")) & F.coalesce(order <= F.col("bound"), F.lit(False)))
    spare = _join(narrow, goal.select("source", "slot", "bound", "lack"), few).where(~within & (F.col("size") > 0) & (F.col("size") < 2 * F.col("lack")))
    last = spare.groupBy("source").agg(F.min_by(order, F.struct(F.abs(F.col("size") - F.col("lack")), order)).alias("last"))
    goal = materialize(_join(goal, last, few, "left").select("source", "source_size", "target", "epochs", "slot", "bound", "last"), "goals")

    x = x.withColumn("_m_order", F.struct("_m_key", F.col(doc_id).alias("id"), "_m_text"))
    goal = goal.select(*[F.col(c).alias(f"_m_g_{c}") for c in goal.columns])
    x = x.join(F.broadcast(goal) if few else goal, F.col(source).eqNullSafe(F.col("_m_g_source")))
    extra = (F.col("_m_slot") < F.col("_m_g_slot")) | ((F.col("_m_slot") == F.col("_m_g_slot")) & F.coalesce(F.col("_m_order") <= F.col("_m_g_bound"), F.lit(False)))
    extra |= F.coalesce(F.col("_m_order") == F.col("_m_g_last"), F.lit(False))
    taken = F.col("size") * F.least(F.col("_m_g_epochs") + F.when(extra, 1).otherwise(0), F.lit(most))
    return x.select(*own, "size", F.col("_m_g_source_size").alias("source_size"), F.col("_m_g_target").alias("target"), taken.cast("long").alias("taken"))


def _join(left: DataFrame, right: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """Join on source, null equal to null; right has one row for each source, sent to all tasks where sources are few."""
    right = right.withColumnRenamed("source", "_m_r_source")
    right = right.select(*[c for c in right.columns if c == "_m_r_source" or c not in left.columns])
    right = F.broadcast(right) if few else right
    return left.join(right, F.col("source").eqNullSafe(F.col("_m_r_source")), how).drop("_m_r_source")
