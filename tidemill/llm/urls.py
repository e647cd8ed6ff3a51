"""URL filters: domain and path rules, then a ratio of character language models."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import extended, pieces, text_blocks

#: (verdict, host, path). A rule fits its host and all subdomains.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; '' without ://."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; '' without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as written, and its verdict; null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for says, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _ngram_slots(urls: list[bytes], order: int, bits: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each character of all urls, with an end, its slot for each context length; the characters; their url."""
    pad = b"\x02" * order
    flat = np.frombuffer(b"".join(pad + u + b"\x03" for u in urls), np.uint8)
    n = np.array([len(u) + 1 for u in urls], np.int64)
    ends = np.cumsum(n + order)
    keep = np.ones(len(flat), bool)
    for k in range(order):
        keep[ends - n - order + k] = False
    at = np.flatnonzero(keep)
    code = np.zeros(len(at), np.uint64)
    slots = []
    for k in range(order + 1):  # the context of k characters before
        h = (code + np.uint64(k * 0x51ED27)) * np.uint64(0x9E3779B97F4A7C15)
        slots.append((h >> np.uint64(64 - bits)).astype(np.int64))
        if k < order:
            code = code * np.uint64(257) + flat[at - 1 - k].astype(np.uint64) + np.uint64(1)
    return slots, flat[at].astype(np.int64), np.repeat(np.arange(len(urls)), n)


def _times(of: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each character, how often its value stands in its own URL."""
    _, dense = np.unique(value, return_inverse=True)
    _, back, n = np.unique(of * (dense.max(initial=0) + 1) + dense, return_inverse=True, return_counts=True)
    return n[back]


def _looked_up(keys: np.ndarray, counts: list[np.ndarray], wanted: np.ndarray) -> list[np.ndarray]:
    """The counts of each wanted key, 0 for those that are not among the sorted keys."""
    if not len(keys):
        return [np.zeros(len(wanted)) for _ in counts]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return [np.where(hit, c[at], 0) for c in counts]


@dataclass
class UrlModel:
    """Counts of characters after contexts of 0 to `order` characters, for accepted and rejected URLs.

    A context is named by `bits` bits of its hash, 40 of them, so that two of a model's contexts hardly ever share a
    name. A model has at most a context an order and character of the different URLs it was fitted on.
    """

    order: int
    bits: int
    keys: list[np.ndarray]  # sorted (context * 256 + character) by order
    counts: list[list[np.ndarray]]  # of the two classes
    contexts: list[np.ndarray]  # sorted, by order
    totals: list[list[np.ndarray]]  # of the two classes
    cuts: tuple[int, int] = (0, 0)  # of each class, URLs whose hash is at most this are counted
    threshold: float = 0.0
    strength: float = 4.0

    def score(self, urls: list[bytes], left_out: int | None = None, counted: np.ndarray | None = None) -> np.ndarray:
        """Mean log-likelihood difference a character, accepted less rejected; the end counts as a character.

        left_out names the class (0 accepted, 1 rejected) that the URLs, or those marked as counted, were counted in:
        each is then scored as if it alone had not been counted.
        """
        if not urls:
            return np.zeros(0)
        slots, chars, of = _ngram_slots(urls, self.order, self.bits)
        own = np.ones(len(chars)) if counted is None else counted[of].astype(float)
        p = np.full((2, len(chars)), 1 / 256)
        for k, slot in enumerate(slots):
            key = slot * 256 + chars
            found = zip(_looked_up(self.keys[k], self.counts[k], key), _looked_up(self.contexts[k], self.totals[k], slot), strict=True)
            for c, (count, total) in enumerate(found):
                if c == left_out:
                    count, total = count - _times(of, key) * own, total - _times(of, slot) * own
                p[c] = (count + self.strength * p[c]) / (total + self.strength)
        gain = np.bincount(of, weights=np.log(p[0]) - np.log(p[1]), minlength=len(urls))
        return gain / np.bincount(of, minlength=len(urls))


def _drawn(text: str) -> Column:
    """What URLs are sampled by."""
    return F.xxhash64(text, F.lit(5))


def train(labelled: DataFrame, order: int = 5, bits: int = 40, most_urls: int = 20_000, keep_accepted: float = 0.95, steps: int = 4096) -> UrlModel:
    """Fit on (text, accepted) rows and set the threshold.

    Of each class the rows of most_urls different URLs are counted, those with the least hashes, and all rows if there
    are no more; this documented sample bounds the model, and the driver and the workers that get it, whatever the
    rows. Contexts are counted whole. The threshold is the (1 - keep_accepted) quantile of the scores of all accepted
    rows, from a histogram of `steps` steps, each counted one scored as if it had not been counted, if that is below 0;
    so no more than about that share of accepted URLs is lost. Rows that repeat count, and stand, as often as they are
    there. Without rows of both kinds the ratio says nothing and all is accepted.
    """

    def count(batches):
        key, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in pieces(batches):
            urls, ok = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for c in (0, 1):
                for block in text_blocks([u or b"" for u, is_ok in zip(urls, ok) if is_ok == c]):
                    slots, chars, _ = _ngram_slots(block, order, bits)
                    new = np.concatenate([(((k << bits) + slot) * 256 + chars) * 2 + c for k, slot in enumerate(slots)])
                    new, m = np.unique(new, return_counts=True)
                    key, back = np.unique(np.concatenate([key, new]), return_inverse=True)
                    n = np.bincount(back, weights=np.concatenate([n, m])).astype(np.int64)
        for i in range(0, len(key), 10000):
            yield pa.RecordBatch.from_arrays([pa.array(key[i : i + 10000]), pa.array(n[i : i + 10000])], ["key", "n"])

    named = labelled.select("text", "accepted", _drawn("text").alias("h"))
    least = lambda ok: named.where(F.col("accepted") == ok).select("h").distinct().orderBy("h").limit(most_urls).agg(F.max("h")).first()[0]
    cuts = tuple(-(1 << 63) if h is None else h for h in (least(True), least(False)))
    rows = named.where(F.col("h") <= F.when(F.col("accepted"), cuts[0]).otherwise(cuts[1]))
    rows = rows.select(F.col("text").cast("binary").alias("text"), F.col("accepted").cast("int").alias("accepted"))
    sums = rows.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    key, n = sums["key"].to_numpy(np.int64), sums["n"].to_numpy(np.float64)
    keys, counts, contexts, totals = [], [], [], []
    for k in range(order + 1):
        own = (key >> (bits + 9)) == k
        slot_char = (key[own] >> 1) & ((1 << (bits + 8)) - 1)
        uniq, back = np.unique(slot_char, return_inverse=True)
        by = [np.bincount(back[(key[own] & 1) == c], weights=n[own][(key[own] & 1) == c], minlength=len(uniq)) for c in (1, 0)]
        keys.append(uniq)
        counts.append(by)
        slot, of = np.unique(uniq >> 8, return_inverse=True)
        contexts.append(slot)
        totals.append([np.bincount(of, weights=b, minlength=len(slot)) for b in by])
    model = UrlModel(order, bits, keys, counts, contexts, totals, cuts)
    if min(totals[0][0].sum(), totals[0][1].sum()) == 0:
        model.threshold = -np.inf
        return model
    scored = score(labelled.where("accepted").select("text"), model, "text", [], left_out=0)
    steps_of = F.floor(F.greatest(F.least(F.col("url_score"), F.lit(8.0)), F.lit(-8.0)) * (steps / 16))
    histogram = scored.groupBy(steps_of.alias("at")).agg(F.count("*").alias("n")).toPandas().sort_values("at")
    cum = histogram["n"].cumsum() / max(histogram["n"].sum(), 1)
    below = histogram["at"][cum > 1 - keep_accepted]
    model.threshold = min(0.0, float(below.iloc[0]) * 16 / steps) if len(below) else 0.0
    return model


def score(rows: DataFrame, model: UrlModel, url: str, keep: list[str], left_out: int | None = None) -> DataFrame:
    """keep columns and url_score, see UrlModel.score; a null URL is an empty one. left_out concerns the URLs that were counted."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by the sample, see train
    schema = extended(rows.select(*keep).schema, "url_score double")
    n = len(keep)
    counted = F.lit(False) if left_out is None else _drawn(url) <= model.cuts[left_out]

    def apply(batches):
        for batch in pieces(batches):
            got, at = [np.zeros(0)], 0
            marks = batch.column(n + 1).to_numpy(zero_copy_only=False)
            for block in text_blocks([u or b"" for u in batch.column(n).to_pylist()]):
                got.append(shared.value.score(block, left_out, marks[at : at + len(block)]))
                at += len(block)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(np.concatenate(got), pa.float64())], [*batch.schema.names[:n], "url_score"])

    return rows.select(*keep, F.col(url).cast("binary").alias("_u"), counted.alias("_counted")).mapInArrow(apply, schema)


def filter_urls(pages: DataFrame, rules=RULES, url: str = "url", **fit) -> DataFrame:
    """All rows of pages with host, path, rule, url_score and verdict (allow or block).

    The longest fitting rule decides. Where none fits, the language models do, which are trained on all the URLs
    that a rule decides, or a sample of them (see train): allow if the score is at least the threshold. The models read the whole URL, scheme, query
    and fragment included. A null URL has an empty host and path and scores as an empty text. Columns of pages with the added names are replaced.
    """
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "url_score", "verdict", "_says", "_text")]
    x = pages.select(*own, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    x = x.withColumns({"rule": rule, "_says": says, "_text": F.coalesce(F.col(url), F.lit(""))})
    model = train(x.where("_says is not null").select(F.col("_text").alias("text"), (F.col("_says") == "allow").alias("accepted")), **fit)
    scored = score(x, model, "_text", [*own, "host", "path", "rule", "_says"])
    by_model = F.when(F.col("url_score") >= model.threshold, "allow").otherwise("block")
    return scored.select(*own, "host", "path", "rule", "url_score", F.coalesce("_says", by_model).alias("verdict"))
