"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions alone.

A sketch is the ascending array of the k least hashes of a text's shingles, all of them if there are fewer. Sketches of
parts merge into that of the whole and estimate resemblance, containment and the number of different shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hex digits of a hash; 16 are 64 bits.
DIGITS = 16

_BLANKS = r"[\x20\x09-\x0D]+"


def shingle_hashes(text: Column, words: int = 5) -> Column:
    """Hashes of all runs of so many words, repeats included; of the whole sequence if it is shorter, none without words.

    The hash of a shingle is the first half of the md5 of its words, joined by a space, in hex.
    """
    found = F.array_remove(F.split(F.coalesce(text, F.lit("")), _BLANKS), "")
    # Bound once: a lambda's argument is evaluated a single time, where a repeated column would be split anew.
    whole = F.transform(F.array(found), lambda w: F.when(
        F.size(w) > 0,
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (words - 1), F.lit(1))), lambda i: F.substring(F.md5(F.array_join(F.slice(w, i, words), " ").cast("binary")), 1, DIGITS)),
    ).otherwise(F.array().cast("array<string>")))
    return F.element_at(whole, 1)


def bottom(hashes: Column, k: int = 128) -> Column:
    """The sketch of an array of hashes."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = 128, words: int = 5) -> Column:
    return bottom(shingle_hashes(text, words), k)


def merge(a: Column, b: Column, k: int = 128) -> Column:
    """The sketch of what two sketched sets hold together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated intersection over union, exact while both have fewer than k shingles; 1 for two sets without any.

    Of the k least hashes of the union, the share that both sketches hold.
    """
    union = F.transform(F.array(merge(a, b, k)), lambda u: F.when(F.size(u) == 0, 1.0).otherwise(F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u)))
    return F.element_at(union, 1)


def distinct_count(a: Column, k: int = 128) -> Column:
    """Estimated number of different shingles: (k - 1) / the k-th least hash as a fraction, or the exact number below k."""
    last = F.conv(F.substring(F.element_at(a, k), 1, 13), 16, 10).cast("double")
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / ((last + 1) / float(1 << 52)))


def containment(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated share of a's shingles that b holds, from the resemblance and both numbers; 1 if a has none."""
    both = distinct_count(merge(a, b, k), k) * resemblance(a, b, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(both / distinct_count(a, k), F.lit(1.0)))


def as_text(a: Column) -> Column:
    """A sketch as one string: its hashes in order, DIGITS hex digits each."""
    return F.array_join(a, "")


def from_text(fingerprint: Column) -> Column:
    """The sketch of a string made by as_text."""
    return F.regexp_extract_all(fingerprint, F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0))


def sketch_groups(df: DataFrame, keys: list[str], sketched: str = "sketch", k: int = 128, salts: int = 64) -> DataFrame:
    """(keys, sketch): the rows' sketches merged for each key.

    Only hashes move, at most k for each salt of a key once they are cut, so a key with a third of all rows is shared
    by `salts` tasks first. Null sketches hold nothing; null keys are a key.
    """
    x = df.select(*keys, F.explode_outer(sketched).alias("_s_hash"))
    x = x.groupBy(*keys, "_s_hash").agg(F.lit(1).alias("_s_one")).withColumn("_s_salt", F.pmod(F.hash("_s_hash"), F.lit(salts)))
    low = Window.partitionBy(*keys, "_s_salt").orderBy("_s_hash")
    x = x.withColumn("_s_rank", F.row_number().over(low)).where(F.col("_s_rank") <= k + 1)  # a null hash may be among them
    return x.groupBy(*keys).agg(bottom(F.collect_list("_s_hash"), k).alias("sketch"))


def _bounds(docs: DataFrame, doc_id: str, rows_each: int, most: int, sample: int) -> list[int]:
    """Ascending ids of which each begins a range of about rows_each rows, the least id first; at most `most` + 1 numbers.

    Quantiles of about `sample` ids; how even the ranges are depends on the sample, no result does.
    """
    key = F.col(doc_id).cast("long")
    n, least = docs.agg(F.count(key), F.min(key)).first()
    parts = max(1, min(most, -(-n // rows_each)))
    drawn = docs.select(key.alias("id")).sample(min(1.0, sample / max(n, 1)), seed=1)
    at = F.expr(f"array({','.join(f'{i / parts:.8f}D' for i in range(parts))})")
    found = drawn.agg(F.percentile_approx("id", at, 10 * max(parts, 1000))).first()[0] or []
    return sorted({*found, least} - {None})


def _range_of(value: Column, bounds: Column, n: int) -> Column:
    """How many of the n ascending bounds are at most value, by halving."""
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(max(1, n.bit_length())))])
    ahead = lambda at, s: (at + s <= n) & (F.get(bounds, at + s - 1) <= value)
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(ahead(at, s), at + s).otherwise(at))


def with_next(
    docs: DataFrame, columns: list[str], made: dict[str, Column] | None = None, rows_each: int = 500, most: int = 10_000, sample: int = 1_000_000, doc_id: str = "doc_id", into: str = "next",
) -> DataFrame:
    """Docs with columns made and, in `into`, a struct of the named columns and those made of the next row in ascending doc_id.

    The next of the last row is the first. Rows go once, in one shuffle, to ranges of ids that hold about rows_each
    rows each (at most `most` ranges). The first row of a range is sent to the range before it too, where it only
    serves as next, and that of the first range to the last; so no task but that of its range sees a row. `made` is
    computed after the shuffle. Equal ids follow each other by the hash of the columns; a row without an id stands
    outside the order, is dealt by that hash and has no next. A column of docs named `into` is replaced.
    """
    made = made or {}
    own = [c for c in docs.columns if c != into]
    ids = _bounds(docs, doc_id, rows_each, most, sample)
    n = len(ids)
    bounds = F.expr(f"array({','.join(f'{i}L' for i in ids)})") if n else F.array(F.lit(0).cast("long"))
    place = lambda r, guest: F.struct(r.cast("int").alias("r"), F.lit(guest).alias("guest"))
    places = lambda r: F.when(F.get(bounds, r - 1) == F.col("_n_key"), F.array(place(r, False), place(F.when(r == 1, n).otherwise(r - 1), True))).otherwise(F.array(place(r, False)))
    alone = F.array(place(-1 - F.pmod("_n_tie", F.lit(8 * max(n, 1))), False))
    x = docs.withColumns({"_n_key": F.col(doc_id).cast("long"), "_n_tie": F.xxhash64(*columns)})
    found = F.element_at(F.transform(F.array(_range_of(F.col("_n_key"), bounds, n)), places), 1)
    x = x.select(*own, "_n_key", "_n_tie", F.explode(F.when(F.col("_n_key").isNull(), alone).otherwise(found)).alias("_n_place"))
    x = x.select(*own, "_n_key", "_n_tie", F.col("_n_place.r").alias("_n_range"), F.col("_n_place.guest").alias("_n_guest"))
    # Guests stand last: the end of a range's own rows. Both windows share one shuffle and one sort.
    order = Window.partitionBy("_n_range").orderBy("_n_guest", "_n_key", "_n_tie")
    x = x.withColumn("_n_next", F.lead(F.struct(*columns)).over(order))
    if made:
        x = x.withColumns(made).withColumn("_n_made", F.lead(F.struct(*made)).over(order))
    parts = [F.col(f"_n_next.{c}").alias(c) for c in columns] + [F.col(f"_n_made.{c}").alias(c) for c in made]
    return x.where("not _n_guest").select(*own, *made, F.when(F.col("_n_key").isNotNull(), F.struct(*parts)).alias(into))


def edited_text(text: Column, following: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the first as many, or all, of another."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprint_documents(docs: DataFrame, k: int = 128, words: int = 5, rows_each: int = 500, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Docs with n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text ends with the beginning of the next document's, in ascending doc_id, instead of its own second
    half; after the last comes the first. near_edited and near_next estimate the resemblance of the document's shingle
    set to the edited text's and the next document's. Null texts are empty; texts without words have the empty
    fingerprint and resemble each other fully. One document alone is its own next. Rows that share an id follow each
    other by their hash; a row without an id has no next, which is as an empty text. Texts are shuffled once.
    Columns with the added names are replaced.
    """
    added = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    own = [c for c in docs.columns if c not in added]
    x = docs.select(*own, F.coalesce(F.col(text), F.lit("")).alias("_p_text"))
    x = with_next(x, ["_p_text"], {"_p_a": sketch(F.col("_p_text"), k, words)}, rows_each, doc_id=doc_id, into="_p_next")
    after = F.coalesce(F.col("_p_next._p_text"), F.lit(""))
    x = x.withColumn("_p_edited", edited_text(F.col("_p_text"), after)).withColumn("_p_c", F.coalesce(F.col("_p_next._p_a"), F.array().cast("array<string>")))
    x = x.withColumn("_p_b", sketch(F.col("_p_edited"), k, words))
    return x.select(
        *own, F.length("_p_text").cast("long").alias("n_chars"), F.sha2(F.col("_p_edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("_p_a")).alias("fingerprint"), as_text(F.col("_p_b")).alias("edited_fingerprint"),
        resemblance(F.col("_p_a"), F.col("_p_b"), k).alias("near_edited"), resemblance(F.col("_p_a"), F.col("_p_c"), k).alias("near_next"),
    )
