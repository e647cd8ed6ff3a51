"""Label data: cleaning, sampling, splits, validation and metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import clean

# Old labels and what they are called now, and the topics.
LEGACY_LABELS = {"very_positive": "positive", "positive": "positive", "neutral": "neutral", "mixed": "neutral", "negative": "negative", "very_negative": "negative"}
TOPICS = ("Chính sách tiền tệ", "Kết quả kinh doanh", "M&A", "Biến động vĩ mô", "Tin đồn thị trường", "Khác")
LABELS = ("positive", "negative", "neutral")


def seeded_order(*keys: str, seed: int = 42) -> Column:
    """A number that orders rows the same way each time: 52 bits of a hash."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *keys, F.lit(str(seed)))), 1, 13), 16, 10).cast("long")


def light_clean(text: Column | str) -> Column:
    """Tags and control signs out, white space collapsed."""
    t = F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"<[^>]*>", " ")
    return clean.collapse(F.regexp_replace(t, r"[\x00-\x1f*#$%&|<>]", " "))


def prompt_text(title: Column, body: Column, most: int = 800) -> Column:
    """Title and body, cut."""
    return F.substring(F.concat(light_clean(title), F.lit(". "), light_clean(body)), 1, most)


_BITS, _SLOT_BITS = 52, 12  # of seeded_order, and of the slots it is cut into


def beyond(df: DataFrame, strata: Sequence[str], key: str, cuts: Sequence[Callable[[Column], Column]], seed: int = 42) -> DataFrame:
    """df with _beyond: how many of the ascending cuts, numbers of rows, a row's place in its stratum's seeded order is past; and _n, the stratum's rows.

    A cut is a function of the stratum's number of rows. Rows are counted by slots of the seeded order, 4096 a
    stratum, and each cut falls into one slot; only rows of such slots are sorted. So a stratum of any size is never
    one task's. Null strata are strata; rows of one key have places next to each other.
    """
    order = seeded_order(key, seed=seed)
    named = [F.col(c).alias(f"_c_{i}") for i, c in enumerate(strata)]
    names = [f"_c_{i}" for i in range(len(strata))]
    x = df.withColumns({"_order": order, "_slot": F.shiftright(order, _BITS - _SLOT_BITS).cast("int")})
    slots = x.select(*named, "_slot").groupBy(*names, "_slot").agg(F.count("*").alias("n"))
    s = slots.groupBy(*names).agg(F.sum("n").alias("_n"), F.array_sort(F.collect_list(F.struct("_slot", "n"))).alias("s"))

    def cut(at: Column) -> Column:
        """The slot that place `at` is in, and the rows of the slots before it."""
        start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("int").alias("slot"))
        step = lambda a, v: F.when(a.slot.isNotNull() | (a.before + v.n > at), F.struct(a.before.alias("before"), F.coalesce(a.slot, v["_slot"]).alias("slot"))).otherwise(F.struct((a.before + v.n).alias("before"), a.slot.alias("slot")))
        return F.aggregate("s", start, step)

    s = s.select(*names, "_n", F.array(*[F.struct(f(F.col("_n")).cast("long").alias("at"), cut(f(F.col("_n")).cast("long")).alias("c")) for f in cuts]).alias("_cuts"))
    same = F.lit(True)
    for c, n in zip(strata, names, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(n))
    x = x.join(s, same).drop(*names)
    open_ = F.exists("_cuts", lambda c: F.col("_slot").eqNullSafe(c.c.slot))
    w = Window.partitionBy(*strata, "_slot").orderBy("_order", key)
    past = lambda c: F.coalesce((F.col("_slot") > c.c.slot).cast("int"), F.lit(0))  # noqa: E731  no slot, no row past it
    clear = x.where(~open_).withColumn("_beyond", F.aggregate("_cuts", F.lit(0), lambda a, c: a + past(c)))
    unclear = x.where(open_).withColumn("_place", F.row_number().over(w))
    side = lambda c: F.when(F.col("_slot") == c.c.slot, (c.c.before + F.col("_place") > c["at"]).cast("int")).otherwise(past(c))
    unclear = unclear.withColumn("_beyond", F.aggregate("_cuts", F.lit(0), lambda a, c: a + side(c))).drop("_place")
    return clear.unionByName(unclear).drop("_order", "_slot", "_cuts")


def _below(share: float) -> Callable[[Column], Column]:
    """How many of n places k = 0, 1, ... have k / n below the share, in the arithmetic of doubles."""

    def count(n: Column) -> Column:
        c = F.ceil(n * share)
        return F.when((c > 0) & ((c - 1) / n >= share), c - 1).when(c / n < share, c + 1).otherwise(c)

    return count


def balanced_sample(df: DataFrame, target: int, publishers: int = 3, by: str = "source", key: str = "article_id", seed: int = 42) -> DataFrame:
    """Of each publisher target // publishers rows, or all it has."""
    return beyond(df, [by], key, [lambda n: F.lit(target // publishers)], seed).where("_beyond = 0").drop("_beyond", "_n")


def stratified_split(df: DataFrame, strata: Sequence[str], key: str, shares: tuple[float, float] = (0.7, 0.15), seed: int = 42) -> DataFrame:
    """Split train, validation or test: within each stratum the first shares of a seeded order."""
    x = beyond(df, strata, key, [_below(shares[0]), _below(shares[0] + shares[1])], seed)
    return x.withColumn("split", F.element_at(F.array(F.lit("train"), F.lit("validation"), F.lit("test")), F.col("_beyond") + 1)).drop("_beyond", "_n")


def route(df: DataFrame, least: float = 0.75, confidence: str = "confidence") -> DataFrame:
    """N18: 'accept' or 'review'; an unknown confidence is reviewed."""
    return df.withColumn("route", F.when(F.col(confidence) >= least, "accept").otherwise("review"))


def review_tasks(df: DataFrame, key: str = "article_id", text: str = "text", label: str = "label", confidence: str = "confidence") -> DataFrame:
    """Nested review tasks: the data, and the prediction as a result with its score."""
    value = F.struct(F.array(label).alias("choices"))
    result = F.array(F.struct(F.lit("sentiment").alias("from_name"), F.lit("text").alias("to_name"), F.lit("choices").alias("type"), value.alias("value")))
    return df.select(F.struct(F.col(key).alias("id"), F.col(text).alias("text")).alias("data"), F.array(F.struct(F.col(confidence).alias("score"), result.alias("result"))).alias("predictions"))


def record_errors(df: DataFrame, topics: Sequence[str] = TOPICS) -> DataFrame:
    """Errors of each label record (label, confidence, topics array, topic_distribution map)."""
    d, names = F.col("topic_distribution"), F.array(*map(F.lit, topics))
    total = F.aggregate(F.map_values(d), F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0)))
    rules = {
        "label": F.col("label").isin(*LABELS), "confidence": F.col("confidence").between(0, 1), "topics": F.size(F.array_except("topics", names)) == 0,
        "distribution_keys": F.size(F.array_except(F.map_keys(d), names)) == 0, "distribution_range": F.forall(F.map_values(d), lambda v: (v >= 0) & (v <= 1)), "distribution_sum": total.between(0.85, 1.15),
    }
    return df.withColumn("errors", F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()))))


def canonical_label(label: Column | str, table: Mapping[str, str] = LEGACY_LABELS) -> Column:
    """today's label; null if there is none, which makes the row an error row."""
    return clean.lookup(F.lower(F.trim(label)), table)


def oversample(df: DataFrame, label: str, least: int, key: str, seed: int = 42) -> DataFrame:
    """Rows of labels with fewer than `least` rows repeated, the first of a seeded order once more than the others, up to exactly `least`. A null label is one."""
    x = beyond(df, [label], key, [lambda n: F.lit(least) % n], seed)
    times = F.when(F.col("_n") >= least, F.lit(1)).otherwise(F.floor(F.lit(least) / F.col("_n")) + F.when(F.col("_beyond") == 0, 1).otherwise(0))
    return x.withColumn("copy", F.explode(F.sequence(F.lit(1), times.cast("int")))).drop("_n", "_beyond")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(term, polarity) of a tab-separated lexicon: comments, short lines and bad numbers are left out; the mean of a term's rows."""
    parts = F.split("value", "\t")
    x = spark.read.text(path).where(~F.col("value").startswith("#")).where(F.size(parts) >= 6)
    x = x.select(F.lower(F.trim(parts[4])).alias("term"), (parts[2].try_cast("double") - parts[3].try_cast("double")).alias("polarity"))
    return x.where("polarity is not null and term <> ''").groupBy("term").agg(F.avg("polarity").alias("polarity"))


def add_external(base: DataFrame, external: DataFrame, label: str, cap: int, key: str, seed: int = 42) -> DataFrame:
    """At most cap external rows of each label, added to the base by name."""
    x = beyond(external, [label], key, [lambda n: F.lit(cap)], seed).where("_beyond = 0").drop("_beyond", "_n")
    return base.unionByName(x, allowMissingColumns=True)


def topics_of(distribution: Column | str, least: float = 0.3, default: str = "Khác") -> Column:
    """Topics with at least that share, largest first by name order; the default if there is none."""
    d = F.col(distribution) if isinstance(distribution, str) else distribution
    t = F.array_sort(F.map_keys(F.map_filter(d, lambda k, v: v >= least)))
    return F.when(F.size(t) > 0, t).otherwise(F.array(F.lit(default)))


def label_shares(df: DataFrame, label: str) -> DataFrame:
    """Count and share of each label, with flags below 5 and above 50 percent."""
    n = df.groupBy(label).agg(F.count("*").alias("n"))
    x = n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("_all")))).withColumn("share", F.col("n") / F.col("_all")).drop("_all")
    return x.withColumns({"too_rare": F.col("share") < 0.05, "too_common": F.col("share") > 0.5})


def confusion(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """(truth, guess, n)."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(F.count("*").alias("n"))


def class_metrics(matrix: DataFrame) -> DataFrame:
    """Precision, recall and F1 of each class from its confusion counts."""
    true, said = matrix.groupBy(F.col("truth").alias("label")).agg(F.sum("n").alias("support")), matrix.groupBy(F.col("guess").alias("label")).agg(F.sum("n").alias("predicted"))
    hit = matrix.where("truth = guess").select(F.col("truth").alias("label"), F.col("n").alias("tp"))
    x = true.join(said, "label", "full").join(hit, "label", "left").fillna(0)
    p, r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")), F.lit(0.0)), F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    return x.select("label", "support", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"))


def overall_metrics(matrix: DataFrame, least_accuracy: float = 0.80, least_f1: float = 0.78) -> DataFrame:
    """Accuracy, macro and weighted F1 over classes that occur, and whether both targets are met."""
    c = class_metrics(matrix).where("support > 0").agg(F.avg("f1").alias("macro_f1"), (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))
    a = matrix.agg((F.sum(F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))
    return a.crossJoin(F.broadcast(c)).withColumn("passed", (F.col("accuracy") >= least_accuracy) & (F.col("macro_f1") >= least_f1))


def multilabel_metrics(df: DataFrame, truth: str, guess: str, least: float = 0.3) -> DataFrame:
    """Micro and macro F1 and Hamming loss of two maps of label to share, thresholded at `least`."""
    labels = F.array_union(F.map_keys(truth), F.map_keys(guess))
    x = df.select(F.explode(labels).alias("label"), truth, guess).select(
        "label", (F.coalesce(F.try_element_at(truth, F.col("label")), F.lit(0.0)) >= least).alias("t"), (F.coalesce(F.try_element_at(guess, F.col("label")), F.lit(0.0)) >= least).alias("g"))
    c = x.groupBy("label").agg(F.count_if(F.expr("t and g")).alias("tp"), F.count_if(F.expr("not t and g")).alias("fp"), F.count_if(F.expr("t and not g")).alias("fn"), F.count("*").alias("n"))
    f1 = lambda tp, fp, fn: F.coalesce(F.try_divide((2 * tp).cast("double"), (2 * tp + fp + fn).cast("double")), F.lit(0.0))
    tp, fp, fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
    return c.agg(f1(tp, fp, fn).alias("micro_f1"), F.avg(f1(F.col("tp"), F.col("fp"), F.col("fn"))).alias("macro_f1"), ((fp + fn) / F.sum("n")).alias("hamming_loss"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """N / (classes * n of the class)."""
    n = df.groupBy(label).agg(F.count("*").alias("n"))
    x = n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("_all"), F.count("*").alias("_k"))))
    return x.select(label, "n", (F.col("_all") / (F.col("_k") * F.col("n"))).alias("weight"))
