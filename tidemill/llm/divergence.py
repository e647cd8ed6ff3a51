"""Source divergence audit: how far the term frequencies of a language's sources lie apart.

Terms are counted in numpy by length buckets: up to 8 and up to 16 bytes are packed into one or two 64-bit words, which
are radix-sorted and run-counted; longer terms are sorted as bytes, one bucket a length. Spark adds the counts up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, pieces, text_blocks

_TERM = np.ones(256, bool)
_TERM[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: p and q are parts of 10^9, which is this number three times over.
_STEP = 1000


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """A stable order of rows by 64-bit words, the first the most significant: 16 bits a pass, equal digits skipped."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]  # numpy sorts 16-bit numbers by radix
    return order


def _packed(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, words: int) -> list[np.ndarray]:
    """Spans of at most 8 * words bytes as big-endian words, filled up with zeros, which no term holds."""
    at = np.arange(8 * words)
    field = raw[np.minimum(starts[:, None] + at, len(raw) - 1)] * (at < sizes[:, None]).astype(np.uint8)
    return [field[:, 8 * k : 8 * k + 8].copy().view(">u8").ravel().astype(np.uint64) for k in range(words)]


def _runs(order: np.ndarray, fresh: np.ndarray, texts: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted occurrences, those that begin a (term, group), their counts, and in how many texts they are.

    fresh marks where another term begins. Sorting is stable and texts come by group, so a term's occurrences do too.
    """
    g, t = groups[order], texts[order]
    new = fresh.copy()
    new[1:] |= g[1:] != g[:-1]
    at = np.flatnonzero(new)
    text = new.copy()
    text[1:] |= t[1:] != t[:-1]
    return order[at], np.diff(np.append(at, len(order))), np.add.reduceat(text.astype(np.int64), at)


def count_terms(texts: list[bytes], groups: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, groups, counts, numbers of texts) of each length bucket; texts of a group have to stand together."""
    raw = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    inside = np.zeros(len(raw) + 1, bool)
    inside[1:] = _TERM[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    whole = raw.tobytes()
    for low, high in ((0, 8), (8, 16)):
        here = np.flatnonzero((sizes > low) & (sizes <= high))
        if len(here):
            words = _packed(raw, starts[here], sizes[here], high // 8)
            order = radix_order(words)
            fresh = np.ones(len(order), bool)
            fresh[1:] = np.any([w[order][1:] != w[order][:-1] for w in words], axis=0)
            first, count, n_texts = _runs(order, fresh, text[here], groups[text[here]])
            at = here[first]
            yield [whole[a : a + s] for a, s in zip(starts[at].tolist(), sizes[at].tolist(), strict=True)], groups[text[at]], count, n_texts
    for size in np.unique(sizes[sizes > 16]).tolist():
        here = np.flatnonzero(sizes == size)
        terms = np.array([whole[a : a + size] for a in starts[here].tolist()], f"S{size}")
        order = np.argsort(terms, kind="stable")
        fresh = np.ones(len(order), bool)
        fresh[1:] = terms[order][1:] != terms[order][:-1]
        first, count, n_texts = _runs(order, fresh, text[here], groups[text[here]])
        at = here[first]
        yield [whole[a : a + size] for a in starts[at].tolist()], groups[text[at]], count, n_texts


def term_counts(docs: DataFrame, most: int = 1_000_000) -> DataFrame:
    """From (lang, source, text), none null, to (lang, source, term, count, n_docs).

    A task counts about `most` bytes of text at a time, which also bounds its arrays unless one text alone is longer;
    these counts are added up in the task again before they are shuffled, so a hot source sends a term once a task.
    """
    names = ["lang", "source", "term", "count", "n_docs"]

    def counts(langs, sources, texts):
        keys = sorted(set(zip(langs, sources, strict=True)))
        key = [pa.array([k[i] for k in keys], pa.string()) for i in range(2)]
        number = {k: i for i, k in enumerate(keys)}
        group = np.array([number[k] for k in zip(langs, sources, strict=True)])
        order = np.argsort(group, kind="stable")
        group = group[order]
        at = 0
        for block in text_blocks([texts[i] for i in order], most):
            for terms, g, n, d in count_terms(block, group[at : at + len(block)]):
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(g)) for c in key), pa.array(terms, pa.binary()), pa.array(n), pa.array(d)], names)
            at += len(block)

    def make(batches):
        held: list[list] = [[], [], []]
        size = 0
        for batch in pieces(batches):
            for column, new in zip(held, batch.columns, strict=True):
                column.extend(new.to_pylist())
            size += batch.column(2).nbytes
            if size >= most:
                yield from counts(*held)
                held, size = [[], [], []], 0
        if held[0]:
            yield from counts(*held)

    x = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    x = x.mapInArrow(make, "lang string, source string, term binary, count long, n_docs long")
    x = x.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("n_docs").alias("n_docs"))
    return x.withColumn("term", F.col("term").cast("string"))


def part(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / (total + kept)): long division by thousands, exact for totals below 9 * 10^15."""
    whole = total + kept
    left, out = (count + 1).cast("long"), F.lit(0).cast("long")
    for _ in range(3):
        out, left = out * _STEP + F.call_function("div", left * _STEP, whole), (left * _STEP) % whole
    return out + 1


def divergence(p, q):
    """floor((p - q)^2 / q), on columns or arrays."""
    d = (p - q) * (p - q)
    return F.call_function("div", d, q) if isinstance(p, Column) else d // q


def pair_sums(terms: DataFrame, block: int = 256, most_held: int = 1 << 26) -> DataFrame:
    """From (lang, n_sources, zeros, here) to (lang, a, b, value): sums of divergence(p of a, p of b) over the rows.

    A row is one term: zeros has the p that each source of the language would have without it, here the (at, p) of
    those that hold it. A language of up to `block` sources sends its terms once, a larger one once for each pair of
    its blocks of sources. A task keeps one matrix of sums for each pair of blocks it meets, most_held bytes at most.
    """
    n = F.ceil(F.col("n_sources") / block).cast("int")
    tiles = F.explode(F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.struct(i.alias("i"), j.alias("j"))))))
    x = terms.withColumn("tile", tiles)
    side = lambda k: (F.slice("zeros", F.col(f"tile.{k}") * block + 1, F.lit(block)), F.filter("here", lambda h: F.floor(h.at / block) == F.col(f"tile.{k}")))
    cols = [c.alias(a) for k in "ij" for c, a in zip(side(k), (f"zeros_{k}", f"here_{k}"), strict=True)]
    x = x.select("lang", F.col("tile.i").alias("i"), F.col("tile.j").alias("j"), *cols)

    def dense(zeros: pa.ListArray, here: pa.ListArray, rows: np.ndarray, at: int) -> np.ndarray:
        """p of each source (row) and term (column)."""
        p = np.repeat(np.array(zeros[int(rows[0])].as_py(), np.int64)[:, None], len(rows), axis=1)
        own = here.take(pa.array(rows))
        flat = own.flatten()
        term = np.repeat(np.arange(len(rows)), own.value_lengths().to_numpy())
        p[flat.field("at").to_numpy() - at * block, term] = flat.field("p").to_numpy()
        return p

    def told(held):
        for (lang, a, b), total in held.items():
            r, c = np.indices(total.shape)
            cols = [pa.array([lang] * total.size, pa.string()), *(pa.array(v.ravel()) for v in (r + a * block, c + b * block, total))]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "a", "b", "value"])

    def sums(batches):
        held: dict[tuple, np.ndarray] = {}
        for batch in pieces(batches):
            langs, i, j = (batch.column(c).to_pylist() for c in ("lang", "i", "j"))
            by: dict[tuple, list[int]] = {}
            for row, key in enumerate(zip(langs, i, j, strict=True)):
                by.setdefault(key, []).append(row)
            for key, rows in by.items():
                at = np.array(rows)
                p = dense(batch.column("zeros_i"), batch.column("here_i"), at, key[1])
                q = dense(batch.column("zeros_j"), batch.column("here_j"), at, key[2])
                total = held.setdefault(key, np.zeros((len(p), len(q)), np.int64))
                for k, row in enumerate(p):
                    total[k] += divergence(row, q).sum(axis=1)
            if sum(t.nbytes for t in held.values()) > most_held:
                yield from told(held)
                held = {}
        yield from told(held)

    x = x.mapInArrow(sums, "lang string, a long, b long, value long")
    return x.where("a <> b").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = 3, top: int = 200, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): how each source differs from its language's others and from all of it.

    Terms are runs of ASCII letters and of code points from U+0080, A-Z lower-cased. A language keeps the V terms that
    at least min_docs of its rows hold. A group, (lang, source) or lang, gives each kept term, with its count there,
    p = 1 + floor(10^9 * (count + 1) / (N + V)); N is its number of kept occurrences. f = floor((p - q)^2 / q).
    Part `pair`: each other source of the language, by the sum of f over all kept terms, q the other's p. Part `term`:
    the kept terms of the source with p > q, q the language's p, by f, ranks up to top. Integers throughout.

    Null text, lang and source count as ''. Each row is a document, repeated or not. A language without kept terms has
    pairs of value 0 and no terms; one with one source has no pairs; an empty table gives no rows. Counts go through
    two tables in the shared folder, the second of which stays until the folder is cleared. Groups are as many as
    sources, so tables of one row a group meet the terms by joins that Spark broadcasts where they are small; the
    pairs of a language are as many as the result's rows. A rank is cut to `top` before rows are shuffled.
    """
    empty = F.lit("")
    x = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    old: list[str] = []
    counts = materialize(term_counts(x), "terms", old)
    words = counts.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"), F.sum("n_docs").alias("docs")).where(F.col("docs") >= min_docs)
    kept = materialize(counts.join(words.drop("docs"), ["lang", "term"]).drop("n_docs"), "kept")

    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    sizes = kept.groupBy("lang", "term").agg(F.max("lang_count").alias("c")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("c").alias("lang_n"))
    groups = x.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0)
    groups = groups.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = materialize(groups.withColumn("zero", F.when(F.col("v") > 0, part(F.lit(0), F.col("n"), F.col("v")))), "groups")
    discard(docs.sparkSession, old)

    p = part(F.col("count"), F.col("n"), F.col("v"))
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", p)

    zeros = groups.where("v > 0").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "zero"))).alias("z"))
    zeros = zeros.select("lang", F.size("z").alias("n_sources"), F.col("z.zero").alias("zeros"))
    here = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("at", "p")).alias("here"))
    summed = pair_sums(here.join(zeros, "lang").select("lang", "n_sources", "zeros", "here"))
    a, b = (groups.select("lang", F.col("source").alias(s), F.col("at").alias(k)) for s, k in (("source", "a"), ("item", "b")))
    pairs = a.join(b, "lang").where("a <> b").join(summed, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    f = divergence(F.col("p"), F.col("q"))
    terms = shares.withColumn("q", part(F.col("lang_count"), F.col("lang_n"), F.col("v"))).where("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), f.alias("value"))

    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(by).cast("int"))
    return ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= top))
