"""LM scoring: a context-tree-weighting model of bytes, and add-half word frequencies as its base."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, pieces, row_key, span_hashes, text_blocks, word_spans

_END = 0xFF  # no byte of UTF-8; pads the first contexts and ends each text


def _byte_codes(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of each text, and its end, behind the depth bytes before it: one integer; and the text it is of."""
    pad = bytes([_END]) * depth
    flat = np.frombuffer(b"".join(pad + t + b"\xff" for t in texts), np.uint8)
    n = np.array([len(t) + 1 for t in texts], np.int64)
    code = np.zeros(max(len(flat) - depth, 0), np.uint64)
    for k in range(depth + 1):
        code <<= np.uint64(8)
        code |= flat[k : len(flat) - depth + k]
    ends = np.cumsum(n + depth)
    keep = np.ones(len(code), bool)
    for k in range(depth):  # windows that end in a padding byte of the next text
        keep[ends[:-1] - depth + k] = False
    return code[keep], np.repeat(np.arange(len(texts)), n)


def _word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of each text, A-Z lower-cased, and 0 for its end; and the text it is of."""
    flat = b"\n".join(texts).lower()
    starts, ends = word_spans(flat)
    begin = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    of = np.searchsorted(begin, starts, "right") - 1
    return np.concatenate((span_hashes(flat, starts, ends), np.zeros(len(texts), np.uint64))), np.concatenate((of, np.arange(len(texts))))


def count_codes(rows: DataFrame, codes_of: Callable, most: int = 500_000) -> DataFrame:
    """(code, n, seen) from (text, held_out): how often each code is in rows that are not held out, and in all.

    A task adds up what it has counted, and hands it on whenever that comes to more than `most` different codes.
    """

    def added(parts: list[tuple]) -> tuple:
        code, n, seen = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(code)
        code = code[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(len(code), 1), bool), code[1:] != code[:-1])))
        return code[first], *(np.add.reduceat(x[order], first) for x in (n, seen))

    def record(part: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1]), pa.array(part[2])], ["code", "n", "seen"])

    def count(batches):
        parts, size = [], 0
        for batch in pieces(batches):
            out, texts = np.array(batch.column(1).to_pylist(), bool), [t or b"" for t in batch.column(0).to_pylist()]
            for held in (False, True):
                for part in text_blocks([t for t, o in zip(texts, out, strict=True) if o == held]):
                    code, n = np.unique(codes_of(part)[0], return_counts=True)
                    parts.append((code, np.zeros_like(n) if held else n, n))
                    size += len(code)
                    if size > 2 * most:
                        parts = [added(parts)]
                        size = len(parts[0][0])
                        if size > most:
                            yield record(parts[0])
                            parts, size = [], 0
        if parts:
            yield record(added(parts))

    return rows.mapInArrow(count, "code long, n long, seen long").groupBy("code").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


def _log_gamma(x: Column) -> Column:
    """Stirling's series after a shift by 6, exact to about 1e-9 for x >= 0.5."""
    x = x.cast("double")
    y = x + 6.0
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return series - F.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))


def _log_kt(n0: Column, n1: Column) -> Column:
    """Log of the Krichevsky-Trofimov block probability."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1) - 1.1447298858494002


def _log_kt_of(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """As _log_kt, over arrays."""

    def log_gamma(x: np.ndarray) -> np.ndarray:
        y = x + 6.0
        series = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
        return series - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))

    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1) - 1.1447298858494002


class _Nodes:
    """Nodes of one depth for one of the eight decisions: sorted names, counts, and each code's node."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, j: int):
        shift = np.uint64(8 - j)
        group = codes >> shift
        new = np.ones(len(codes), bool)
        new[1:] = group[1:] != group[:-1]
        first = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1
        head = codes[first]
        self.name = (head >> np.uint64(8) << np.uint64(8)) | np.uint64(1 << j) | ((head & np.uint64(255)) >> shift)
        bit = ((codes >> np.uint64(7 - j)) & np.uint64(1)).astype(np.float64)
        total, self.n1 = (np.add.reduceat(x, first) if len(first) else np.zeros(0) for x in (n, n * bit))
        self.n0 = total - self.n1
        self.log_pw = _log_kt_of(self.n0, self.n1)
        self.log_beta = np.zeros(len(first))

    def weigh(self, children: "_Nodes", up: np.ndarray) -> None:
        """Against the product of the children's weighted probabilities; up holds each child's parent here."""
        own, below = self.log_pw, np.bincount(up, weights=children.log_pw, minlength=len(self.name))
        self.log_beta = own - below
        self.log_pw = np.logaddexp(own, below) - 0.6931471805599453

    def mixed(self, acc: np.ndarray, rem: np.ndarray) -> None:
        """one, acc and rem as mixed_levels has them, from the parents' acc and rem."""
        own, w = (self.n1 + 0.5) / (self.n0 + self.n1 + 1), 1 / (1 + np.exp(-np.clip(self.log_beta, -700, 700)))
        self.one, self.acc, self.rem = acc + rem * own, acc + rem * w * own, rem * (1 - w)


def _subtrees(code: np.ndarray, n: np.ndarray, depth: int, top: int) -> tuple[list[list[_Nodes]], list[list[np.ndarray]]]:
    """All nodes of depths top to depth below whole contexts of top bytes, weighted: levels, and parents by level and decision."""
    order = np.argsort(code)
    code, n = code[order], n[order].astype(np.float64)
    levels, ups = [], []
    for d in range(depth, top - 1, -1):
        if d < depth:
            code, back = np.unique(code & np.uint64((1 << (8 * (d + 1))) - 1), return_inverse=True)
            n = np.bincount(back, weights=n, minlength=len(code))
        level = [_Nodes(code, n, j) for j in range(8)]
        if levels:
            mask = np.uint64((1 << (8 * (d + 1))) - 1)
            ups.append([np.searchsorted(x.name, y.name & mask) for x, y in zip(level, levels[-1], strict=True)])
            for x, y, up in zip(level, levels[-1], ups[-1], strict=True):
                x.weigh(y, up)
        levels.append(level)
    return levels[::-1], ups[::-1]


def _by_context(batches, most: int = 100_000):
    """Tables of whole contexts, about `most` rows at a time, of batches in order of their first column."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if size >= most and held:
            last = held[-1].column(0)[-1].as_py()
            cut = int(np.searchsorted(batch.column(0).to_numpy(), last, "right"))
            held.append(batch.slice(0, cut))
            if cut < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size, batch = [], 0, batch.slice(cut)
            else:
                size += batch.num_rows
                continue
        held.append(batch)
        size += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _context(name: str, top: int) -> Column:
    """The top bytes before, of a code or node."""
    return (F.shiftrightunsigned(F.col(name), 8)).bitwiseAND((1 << (8 * top)) - 1)


def tree_levels(grams: DataFrame, depth: int, top: int = 3, scratch: list[str] | None = None) -> list[DataFrame]:
    """Nodes of the depths 0 to top: (node, n0, n1, log_beta), node the context bytes and the bits of the byte so far.

    A byte is eight binary decisions, each with a context tree of its own. log_beta weighs a node's own estimate
    against its children's: KT block probability over the product of the children's weighted probabilities. All that
    hangs below the same top bytes is in one task, which goes up from depth to top by itself: at most
    256**(depth + 1 - top) codes a context, whatever the corpus. The levels above are sums of the one below.
    """
    top = min(top, depth)

    def climb(batches):
        for t in _by_context(pieces(batches, 10_000)):
            levels, _ = _subtrees(t.column(1).to_numpy().view(np.uint64), t.column(2).to_numpy(), depth, top)
            for x in levels[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (x.name.view(np.int64), x.n0.astype(np.int64), x.n1.astype(np.int64), x.log_beta, x.log_pw)], ["node", "n0", "n1", "log_beta", "log_pw"])

    dealt = grams.select(_context("code", top).alias("context"), "code", "n").repartition("context").sortWithinPartitions("context")
    below = materialize(dealt.mapInArrow(climb, "node long, n0 long, n1 long, log_beta double, log_pw double"), "nodes", scratch)
    levels = [below]
    for d in range(top - 1, -1, -1):
        x = below.groupBy(F.col("node").bitwiseAND((1 << (8 * (d + 1))) - 1).alias("node")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("log_pw").alias("log_children"))
        x = x.withColumn("log_kt", _log_kt(F.col("n0"), F.col("n1"))).withColumn("log_beta", F.col("log_kt") - F.col("log_children"))
        most, least = F.greatest("log_kt", "log_children"), F.least("log_kt", "log_children")
        x = x.withColumn("log_pw", most + F.log1p(F.exp(least - most)) - 0.6931471805599453)
        below = materialize(x.select("node", "n0", "n1", "log_beta", "log_pw"), "nodes", scratch)
        levels.append(below)
    return levels[::-1]


def mixed_levels(levels: list[DataFrame], scratch: list[str] | None = None) -> list[DataFrame]:
    """Nodes of each depth: (node, one, acc, rem), one the probability of a one where no deeper node is there.

    p = (beta * own + deeper) / (beta + 1), unrolled from the root down: acc is what the nodes up to this one give,
    rem the weight left for deeper ones. A node meets its parent, and a parent has at most 256 children.
    """
    out: list[DataFrame] = []
    for d, x in enumerate(levels):
        x = x.select("node", ((F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)).alias("own"), F.expr("1 / (1 + exp(-log_beta))").alias("w"))
        if d:
            parent = out[-1].select(F.col("node").alias("up"), "acc", "rem")
            x = x.join(parent, F.col("node").bitwiseAND((1 << (8 * d)) - 1) == F.col("up"))
        else:
            x = x.withColumns({"acc": F.lit(0.0), "rem": F.lit(1.0)})
        x = x.select("node", F.expr("acc + rem * own").alias("one"), F.expr("acc + rem * w * own").alias("acc"), F.expr("rem * (1 - w)").alias("rem"))
        out.append(materialize(x, "mixed", scratch))
    return out


def deep_values(codes: DataFrame, mixed: DataFrame, depth: int, top: int = 3) -> DataFrame:
    """(code, seen, value, lack) from (code, n, seen) and the mixed nodes of depth top.

    value is the log10 probability of the code's last byte by its decisions' deepest nodes of the depths top to
    depth; lack has a bit for each decision that has none of them. As in tree_levels a task has whole contexts.
    """
    top = min(top, depth)

    def descend(batches):
        for t in _by_context(pieces(batches, 10_000)):
            code, n, seen, one, acc, rem = (t.column(i).to_numpy() for i in range(1, 7))
            code, upper = code.view(np.uint64), seen < 0
            node, by = code[upper], np.argsort(code[upper])
            node, parts = node[by], [x[upper][by] for x in (one, acc, rem)]
            code, n, seen = (x[~upper] for x in (code, n, seen))
            levels, ups = _subtrees(code[n > 0], n[n > 0], depth, top)
            for x in levels[0]:
                at = np.searchsorted(node, x.name)
                x.one, x.acc, x.rem = (p[at] for p in parts)
            for level, above, up in zip(levels[1:], levels, ups, strict=False):
                for x, y, u in zip(level, above, up, strict=True):
                    x.mixed(y.acc[u], y.rem[u])
            value, lack = np.zeros(len(code)), np.zeros(len(code), np.int32)
            known = np.flatnonzero(n > 0)
            known = known[np.argsort(code[known])]
            new = np.flatnonzero(n == 0)
            for j in range(8):
                p = np.full(len(code), -1.0)
                p[known] = levels[-1][j].one[levels[-1][j].of]
                left, prefix = new, np.uint64(1 << j) | ((code & np.uint64(255)) >> np.uint64(8 - j))
                for level, d in zip(levels[::-1], range(depth, top - 1, -1), strict=True):
                    x = level[j]
                    if not len(left) or not len(x.name):
                        continue
                    want = (((code[left] >> np.uint64(8)) & np.uint64((1 << (8 * d)) - 1)) << np.uint64(8)) | prefix[left]
                    at = np.minimum(np.searchsorted(x.name, want), len(x.name) - 1)
                    hit = x.name[at] == want
                    p[left[hit]] = x.one[at[hit]]
                    left = left[~hit]
                lack[left] |= 1 << j
                bit = ((code >> np.uint64(7 - j)) & np.uint64(1)).astype(bool)
                value += np.where(p < 0, 0.0, np.log10(np.where(p < 0, 1.0, np.where(bit, p, 1 - p))))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (code.view(np.int64), seen, value, lack)], ["code", "seen", "value", "lack"])

    none = F.lit(0.0)
    rows = codes.select(_context("code", top).alias("context"), "code", "n", "seen", none.alias("one"), none.alias("acc"), none.alias("rem"))
    upper = mixed.select(_context("node", top).alias("context"), F.col("node").alias("code"), F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("seen"), "one", "acc", "rem")
    dealt = rows.unionByName(upper).repartition("context").sortWithinPartitions("context")
    return dealt.mapInArrow(descend, "code long, seen long, value double, lack int")


def code_values(codes: DataFrame, levels: list[DataFrame], depth: int, scratch: list[str] | None = None) -> DataFrame:
    """(code, seen, value): log10 probability of each code's last byte after its context, by every counted node.

    Each of the eight decisions takes its deepest node: those that a level lacks are looked up in the next one. The
    two topmost levels have at most 65,280 nodes and are broadcast.
    """
    x = materialize(deep_values(codes, levels[-1], depth, len(levels) - 1), "values", scratch)
    out, todo = x.where("lack = 0").select("code", "seen", "value"), x.where("lack <> 0")
    for d in range(len(levels) - 2, -1, -1):
        x = todo.withColumn("j", F.explode(F.expr("filter(sequence(0, 7), j -> (lack >> j) & 1 = 1)")))
        x = x.withColumn("node", F.expr(f"(((code >> 8) & {(1 << (8 * d)) - 1}L) << 8) | (1L << j) | ((code & 255) >> (8 - j))"))
        level = levels[d].select("node", "one")
        x = x.join(F.broadcast(level) if d < 2 else level, "node", "left")
        p = F.expr("log10(case when (code >> (7 - j)) & 1 = 1 then one else 1 - one end)")
        gain, lack = F.sum(F.coalesce(p, F.lit(0.0))), F.sum(F.when(F.col("one").isNull(), F.expr("1 << j")).otherwise(0)).cast("int")
        x = x.groupBy("code").agg(F.max("seen").alias("seen"), (F.max("value") + gain).alias("value"), lack.alias("lack"))
        x = materialize(x, "values", scratch)
        out, todo = out.unionByName(x.where("lack = 0").select("code", "seen", "value")), x.where("lack <> 0")
    return out.unionByName(todo.select("code", "seen", F.expr("value + bit_count(lack) * log10(0.5)").alias("value")))


class _Table:
    """Values by code: the more frequent codes in slots by hash, any others by binary search."""

    def __init__(self, code: np.ndarray, value: np.ndarray, seen: np.ndarray, bits: int = 20):
        by = np.argsort(code)
        self.code, self.value, self.shift = code[by], value[by], np.uint64(64 - bits)
        rank = np.argsort(seen[by], kind="stable")  # of codes that share a slot the most frequent is written last
        slot = self.slots(self.code[rank])
        self.slot_code, self.slot_value = np.full(1 << bits, np.uint64(1)), np.full(1 << bits, np.nan)
        self.slot_code[slot], self.slot_value[slot] = self.code[rank], self.value[rank]

    def slots(self, code: np.ndarray) -> np.ndarray:
        return ((code * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, code: np.ndarray) -> np.ndarray:
        """Values, NaN where a code isn't there."""
        slot = self.slots(code)
        out = np.where(self.slot_code[slot] == code, self.slot_value[slot], np.nan)
        miss = np.flatnonzero(np.isnan(out))
        if len(miss) and len(self.code):
            at = np.minimum(np.searchsorted(self.code, code[miss]), len(self.code) - 1)
            out[miss] = np.where(self.code[at] == code[miss], self.value[at], np.nan)
        return out


def code_sums(docs: DataFrame, codes_of: Callable, values: DataFrame, otherwise: float, most_head: int, scratch: list[str] | None = None) -> DataFrame:
    """From (key, text) to one row a key: (key, n, known, sum), how many codes, how many of them are in values (code, seen, value, known), and the sum of their values.

    The values of the most frequent codes (at most most_head, by rungs of powers of 2**(1/4)) go to every task; what
    a document has of other codes is joined with their values, `otherwise` where there is none; so every code has its
    own value whatever their number. Rows that repeat whole share a key and one row.
    """
    rung, least, total = F.floor(F.log2("seen") * 4), 1 << 40, 0
    for r in sorted(values.groupBy(rung.alias("r")).agg(F.count("*").alias("c")).collect(), reverse=True):
        total += r.c
        if total > most_head:
            break
        least = r.r
    head = values.where((rung >= least) & F.col("known")).select("code", "value", "seen").toArrow()
    code, value, seen = (head.column(i).to_numpy() for i in range(3))
    shared = docs.sparkSession.sparkContext.broadcast((code, value.astype(np.float64), seen))  # bounded by most_head

    def look_up(batches):
        table = _Table(shared.value[0].view(np.uint64), *shared.value[1:])
        for batch in pieces(batches):
            keys, texts = batch.column(0).to_numpy(), [t or b"" for t in batch.column(1).to_pylist()]
            start = 0
            for part in text_blocks(texts):
                own = keys[start : start + len(part)]
                start += len(part)
                code, of = codes_of(part)
                worth = table.find(code)
                miss = np.isnan(worth)
                n, known = np.bincount(of, minlength=len(part)), np.bincount(of[~miss], minlength=len(part))
                s = np.bincount(of[~miss], weights=worth[~miss], minlength=len(part))
                # One row for each of a text's other codes, one (without code) for the text.
                left, text = code[miss], of[miss]
                by = np.lexsort((left, text))
                left, text = left[by], text[by]
                first = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (text[1:] != text[:-1])))) if len(left) else np.zeros(0, np.int64)
                times, none = np.diff(np.append(first, len(left))), np.zeros(len(first))
                code_of = pa.concat_arrays([pa.array(left[first].view(np.int64)), pa.nulls(len(part), pa.int64())])
                cols = [np.concatenate(c) for c in ((own[text[first]], own), (times, n), (none.astype(np.int64), known), (none, s))]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), code_of, *(pa.array(c) for c in cols[1:])], ["key", "code", "n", "known", "sum"])

    parts = materialize(docs.mapInArrow(look_up, "key long, code long, n long, known long, sum double"), "sums", scratch)
    tail = parts.where("code is not null").select("key", "code", "n").join(values.where((rung < least) | ~F.col("known")).select("code", "value", F.col("known").alias("is")), "code", "left")
    tail = tail.groupBy("key").agg(F.sum(F.when(F.col("is"), F.col("n")).otherwise(0)).alias("k2"), F.sum(F.col("n") * F.coalesce("value", F.lit(otherwise))).alias("s2"))
    # Rows that repeat whole share a key: the tail then holds their codes as often as there are rows.
    x = parts.where("code is null").groupBy("key").agg(F.count("*").alias("rows"), *(F.max(c).alias(c) for c in ("n", "known", "sum"))).join(tail, "key", "left")
    known, total_ = F.col("known") + F.coalesce("k2", F.lit(0)) / F.col("rows"), F.col("sum") + F.coalesce("s2", F.lit(0.0)) / F.col("rows")
    return x.select("key", "n", known.cast("long").alias("known"), total_.alias("sum"))


def word_scores(rows: DataFrame, most_head: int = 300_000, scratch: list[str] | None = None) -> DataFrame:
    """From (key, text, held_out) to one row a key: (key, n_tokens, n_known, train_tokens, base_score) by the word counts of rows that are not held out."""
    counts = materialize(count_codes(rows.select("text", "held_out"), _word_codes), "words", scratch)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    floor = float(np.log10(total.n + 0.5 * (total.v + 1)))
    values = counts.select("code", "seen", F.log10(F.col("n") + 0.5).alias("value"), (F.col("n") > 0).alias("known"))
    got = code_sums(rows.select("key", "text"), _word_codes, values, float(np.log10(0.5)), most_head, scratch)
    return got.select("key", F.col("n").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(total.n).cast("long").alias("train_tokens"), (F.col("sum") - F.col("n") * F.lit(floor)).alias("base_score"))


def score_texts(docs: DataFrame, held_out: Column | None = None, depth: int = 5, most_head: int = 1_000_000, top: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of docs with held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte.

    score is the log10 probability of the text's bytes and its end under the tree grown from the rows that are not
    held out (by default those whose crc32(doc_id) mod 5 is not 1; a null id is not held out). Null texts are empty.
    Every node of the tree counts; most_head bounds only how many codes' scores are broadcast rather than joined, and
    top the depth down to which nodes are Spark's rows rather than a task's arrays. Neither changes a score.
    Without training rows every bit has probability 1/2. Columns of docs with the added names are replaced.
    """
    added = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
    own = [c for c in docs.columns if c not in (*added, "_key", "_raw")]
    out = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 1 if held_out is None else held_out
    x = docs.select(*own, F.coalesce(out, F.lit(False)).alias("held_out"), row_key(doc_id, text).alias("_key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_raw"))
    codes_of, old = partial(_byte_codes, depth=depth), []
    grams = materialize(count_codes(x.select("_raw", "held_out"), codes_of), "grams", old)
    levels = mixed_levels(tree_levels(grams.where("n > 0").select("code", "n"), depth, top, old), old)
    values = materialize(code_values(grams, levels, depth, old).withColumn("known", F.lit(True)), "codes")
    discard(docs.sparkSession, old)
    texts = x.select(F.col("_key").alias("key"), F.col("_raw").alias("text"), "held_out")
    got = code_sums(texts.select("key", "text"), codes_of, values, 0.0, most_head)
    both = word_scores(texts).join(got.select("key", F.col("n").alias("n_bytes"), F.col("sum").alias("score")), "key")
    both = both.withColumn("bits_per_byte", -F.col("score") / float(np.log10(2)) / F.col("n_bytes")).withColumnRenamed("key", "_key")
    return x.select(*own, "held_out", "_key").join(both, "_key").select(*own, *added)
