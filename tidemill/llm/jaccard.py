"""N-gram Jaccard join by parity sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Sequence, components, discard, materialize, mix, pieces, row_key, span_hashes, text_blocks, word_spans

#: Bits of the sketch that screens candidates.
_BITS = 512
_SKETCHED = 256
#: A tag is a band (under 40 of them) times _TAG and one more than the spares that are left.
_TAG = 1 << 24


def shingles(texts: list[bytes], width: int = 5) -> Iterator[np.ndarray]:
    """Each text's sorted distinct hashes of its word shingles, A-Z lower-cased; a shorter text is one shingle."""
    for block in text_blocks(texts):
        flat = b"\n".join(block).lower()
        starts, ends = word_spans(flat)
        seq = Sequence(span_hashes(flat, starts, ends))
        windows = seq.windows(width)
        at = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in block)])).tolist()
        for a, b in zip(at, at[1:], strict=False):
            if b - a < width:
                yield seq.runs(np.array([a]), np.array([b])) if b > a else np.zeros(0, np.uint64)
                continue
            x = np.sort(windows[a : b - width + 1])
            first = np.ones(len(x), bool)
            np.not_equal(x[1:], x[:-1], out=first[1:])
            yield x[first]


class Bands:
    """Size bands: band k joins sizes whose pairs differ in 2**(k - 1) + 1 to 2**k tokens at the threshold.

    Sizes n and m allow a symmetric difference of at most t = (100 - percent) * (n + m) / (100 + percent), which is
    between a fourth and a third of n at 75 %; so a set is in one band or two. There it sends 2**k + 1 segments and a
    sixth more. A difference reaches t segments at most, so at least parts - t are alike in every pair (pigeonhole),
    whatever the family and its sizes; what a set may leave out follows from the largest t that it can have.
    """

    def __init__(self, percent: int):
        self.percent = percent

    def _differences(self, n: int) -> tuple[int, int]:
        """The most tokens in which a set of n may differ from its smallest and from its largest partner."""
        low, high = -(-n * self.percent // 100), n * 100 // self.percent
        return tuple((100 - self.percent) * (n + m) // (100 + self.percent) for m in (low, high))

    def of(self, n: int) -> range:
        """The bands of a set; none if only its equals are alike."""
        low, high = self._differences(n)
        return range((max(low, 1) - 1).bit_length(), (high - 1).bit_length() + 1) if high else range(0)

    def parts(self, band: int) -> int:
        return (1 << band) + 1 + (1 << band) // 6

    def spare(self, n: int, band: int) -> int:
        """How many segments of a set of n may go unused."""
        return self.parts(band) - 1 - min(1 << band, self._differences(n)[1])


def segments(tokens: np.ndarray, band: int, bands: Bands) -> tuple[np.ndarray, int]:
    """Keys of the parity sketch's segments for a band, and how many more may be left out (-1: none are spare).

    A segment is the XOR of the 64-bit hashes of its tokens. Empty segments tell nothing and use up spares; a set
    with too many of them sends those too.
    """
    parts, spare = bands.parts(band), bands.spare(len(tokens), band)
    salt = mix(np.array([band + 1], np.uint64))
    h = mix(tokens ^ salt)
    part = (((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part, h = part[order], mix(h[order])
    first = np.flatnonzero(np.concatenate((np.ones(min(len(part), 1), bool), part[1:] != part[:-1])))
    xor = np.bitwise_xor.reduceat(h, first) if len(first) else np.zeros(0, np.uint64)
    have = part[first]
    empty = parts - len(have)
    if empty > spare:
        gone = np.setdiff1d(np.arange(parts), have)
        have, xor = np.concatenate((have, gone)), np.concatenate((xor, np.zeros(len(gone), np.uint64)))
    return mix(xor ^ mix(have.astype(np.uint64) + salt)), max(spare - empty, -1)


def _level(n: int) -> int:
    """The sketch that screens a set holds about a 2**-level share of its tokens."""
    return max(0, int(n // _SKETCHED).bit_length() - 1)


def sketch(tokens: np.ndarray, level: int) -> np.ndarray:
    """Parity bits of the tokens of a level."""
    h = mix(tokens + np.uint64(0x1234567))
    h = h[(h >> np.uint64(64 - level)) == 0] if level else h
    n = np.bincount((h & np.uint64(_BITS - 1)).astype(np.int64), minlength=_BITS)
    return np.packbits((n & 1).astype(np.uint8)).view(np.int64)


def _name(tokens: np.ndarray) -> np.ndarray:
    """One number for a set."""
    with np.errstate(over="ignore"):
        return mix(np.array([np.bitwise_xor.reduce(mix(tokens)) + np.uint64(len(tokens)) * np.uint64(0x9E3779B97F4A7C15)], np.uint64)).view(np.int64)


def describe(rows: DataFrame, width: int) -> DataFrame:
    """From (key, doc_id, text) to n, the set's name sid and two screening sketches; texts without words have no sid."""

    def sets(batches):
        for batch in pieces(batches):
            out: list[list] = [[] for _ in range(4)]
            for x in shingles(batch.column(2).to_pylist(), width):
                level = _level(len(x))
                for c, v in zip(out, (len(x), int(_name(x)[0]), level, np.concatenate((sketch(x, level), sketch(x, level + 1)))) if len(x) else (0, None, None, None), strict=True):
                    c.append(v)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(out, types, strict=True))], ["key", "doc_id", "n", "sid", "level", "sketch"])

    return rows.mapInArrow(sets, "key long, doc_id long, n long, sid long, level int, sketch array<long>")


def sent_segments(rows: DataFrame, bands: Bands, width: int, share: int = 0, shares: int = 1, at_once: int = 200_000) -> DataFrame:
    """From (text) to (key, sid, tag): every set's segment keys in each of its bands, of all keys one share."""

    def send(batches):
        out: list[list] = [[], [], []]

        def record() -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in out]
            for c in out:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0].view(np.int64)), pa.array(cols[1]), pa.array(cols[2])], ["key", "sid", "tag"])

        size = 0
        for batch in pieces(batches):
            for x in shingles(batch.column(0).to_pylist(), width):
                if not len(x):
                    continue
                sid = _name(x)
                for band in bands.of(len(x)):
                    k, left = segments(x, band, bands)
                    k = k[k % np.uint64(shares) == share] if shares > 1 else k
                    size += len(k)
                    for c, v in zip(out, (k, np.repeat(sid, len(k)), np.full(len(k), band * _TAG + left + 1, np.int32)), strict=True):
                        c.append(v)
                if size > at_once:
                    yield record()
                    size = 0
        if size:
            yield record()

    return rows.mapInArrow(send, "key long, sid long, tag int")


_WORDS = _BITS // 64
_SKETCH = [f"p{i}" for i in range(_WORDS)] + [f"q{i}" for i in range(_WORDS)]


def _named(sets: DataFrame, side: str) -> DataFrame:
    """Every column but the row key's own name, marked with the pair's side."""
    return sets.select(*(F.col(c).alias(f"{side}_{c}") for c in sets.columns))


def _may_link(percent: int, exact: bool = False) -> str:
    """Whether sizes and sketches allow a pair: their Hamming distance can't exceed the symmetric difference.

    p words are of a set's own level, q words of the next, and levels of a pair differ by one at most. Beyond level 0
    a sketch holds a share of the tokens; six standard deviations are allowed for, or with `exact` such pairs pass.
    """
    apart = lambda a, b: " + ".join(f"bit_count(a_{a}{i} ^ b_{b}{i})" for i in range(_WORDS))
    most = f"({100 - percent} * (a_n + b_n) / {100 + percent} * power(0.5, greatest(a_level, b_level)))"
    slack = f"(case when a_level = 0 and b_level = 0 then 0 else {'1e18' if exact else f'6 * sqrt({most}) + 6'} end)"
    d = f"(case when a_level = b_level then {apart('p', 'p')} when a_level < b_level then {apart('q', 'p')} else {apart('p', 'q')} end)"
    return f"(a_n * 100 >= b_n * {percent} and b_n * 100 >= a_n * {percent} and {d} <= {most} + {slack})"


def screened(pairs: DataFrame, sets: DataFrame, percent: int, exact: bool = False) -> DataFrame:
    """The pairs (a, b) that _may_link, with their rows' keys."""
    x = pairs.join(_named(sets, "a"), F.col("a") == F.col("a_sid")).join(_named(sets, "b"), (F.col("b") == F.col("b_sid")) & F.expr(_may_link(percent, exact)))
    return x.select("a", "b", F.col("a_key").alias("ka"), F.col("b_key").alias("kb"))


def only(rows: DataFrame, keys: DataFrame, bits: int = 24) -> DataFrame:
    """rows (key first) less most of those whose key isn't among keys: by one hash into 2**bits bits, 2 MB whatever the data.

    Spares the shuffle of texts that no candidate needs; a join on the key follows, so false hits do no harm.
    """
    slot = F.col("key").bitwiseAND((1 << bits) - 1)
    maps = keys.select(slot.alias("s")).distinct().groupBy(F.expr("bitmap_bucket_number(s + 1)").alias("b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(s + 1))").alias("m"))
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for r in maps.collect():  # at most 2**bits / 32768 rows
        bitmap[(r.b - 1) * 4096 : r.b * 4096] = np.frombuffer(r.m, np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def keep(batches):
        for batch in batches:
            s = batch.column(0).to_numpy() & ((1 << bits) - 1)
            yield batch.filter(pa.array((shared.value[s >> 3] >> (s & 7).astype(np.uint8)) & 1 > 0))

    return rows.mapInArrow(keep, rows.schema)


def verified(pairs: DataFrame, rows: DataFrame, percent: int, width: int) -> DataFrame:
    """Of the screened pairs, a table that is read twice, those whose sets reach the threshold on the texts' own shingles: (a, b)."""
    texts = only(rows.select("key", "text"), pairs.select(F.explode(F.array("ka", "kb")).alias("key")))
    x = pairs.join(texts.select(F.col("key").alias("kb"), F.col("text").alias("tb")), "kb").join(texts.select(F.col("key").alias("ka"), F.col("text").alias("ta")), "ka")

    def check(batches):
        last, of_last = None, None
        for batch in pieces(batches):
            a, ta, tb = (batch.column(i).to_pylist() for i in (0, 2, 3))
            ok = []
            for i, x, y in zip(a, ta, tb, strict=True):
                if i != last:
                    last, (of_last,) = i, shingles([x], width)
                (other,) = shingles([y], width)
                common = len(np.intersect1d(of_last, other, assume_unique=True))
                ok.append(100 * common >= percent * (len(of_last) + len(other) - common))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], ["a", "b"])

    return x.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def partners(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b), each at the end that has fewer of them: (sid, met). So no list is longer than the root of twice their number."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("sid")).groupBy("sid").agg(F.count("*").alias("c"))
    x = pairs.join(ends.select(F.col("sid").alias("a"), F.col("c").alias("ca")), "a").join(ends.select(F.col("sid").alias("b"), F.col("c").alias("cb")), "b")
    fewer = F.col("ca") <= F.col("cb")
    x = x.select(F.when(fewer, F.col("a")).otherwise(F.col("b")).alias("sid"), F.when(fewer, F.col("b")).otherwise(F.col("a")).alias("other"))
    return x.groupBy("sid").agg(F.collect_set("other").alias("met"))


def tokens_of(sets: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """From sets (key, sid, label, need) and all rows (key, text) to (token, sid, label, need): each set's shingles once."""
    texts = only(rows.select("key", "text"), sets.select("key")).dropDuplicates(["key"])

    def send(batches):
        for batch in pieces(batches, 100):
            each = list(shingles(batch.column(3).to_pylist(), width))
            n = [len(x) for x in each]
            if sum(n):
                cols = [np.concatenate(each).view(np.int64), *(np.repeat(batch.column(i).to_numpy(), n) for i in range(3))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["token", "sid", "label", "need"])

    return texts.join(sets, "key").select("sid", "label", "need", "text").mapInArrow(send, "token long, sid long, label long, need long")


def rare_tokens(left: DataFrame, rows: DataFrame, percent: int, width: int, scratch: list[str]) -> DataFrame:
    """From what still shares a segment with another component to (token, sid, label, place, met, main): of each set its rarest
    tokens, so many that it shares one with every set of another component that it may be linked with (prefix filter).

    A set and its partner have at least `need` tokens in common, each held by both components. Of these the rarest is
    preceded by need - 1 commoner ones in both sets. A family's own tokens are its commonest: a set that is not linked
    with the family's hub has more others than it keeps, so it meets those alone that share its own changes. Tokens of
    one component link nothing and count as the rarest. `place` counts a set's tokens from the commonest: what two sets
    need in common must not exceed their token's place in either. `main` marks the component that most of a token's sets have.
    """
    n = f"greatest(min(least), (any_value(n) * {percent} + 99) div 100) + any_value(n)"
    sets = left.withColumn("least", F.min("n").over(Window.partitionBy("segment"))).groupBy("sid")
    sets = sets.agg(*(F.any_value(c).alias(c) for c in ("key", "label", "met")), F.expr(f"({percent} * ({n}) + {99 + percent}) div {100 + percent}").alias("need"))
    sets = materialize(sets, "rest", scratch)
    tokens = materialize(tokens_of(sets.select("key", "sid", "label", "need"), rows, width), "tokens", scratch)
    common = tokens.groupBy("token").agg(F.count("*").alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    place = F.row_number().over(Window.partitionBy("sid").orderBy(F.desc("c"), F.desc("token")))
    kept = tokens.join(common.select("token", "c"), "token").withColumn("place", place).where("place >= need")
    kept = materialize(kept.select("token", "sid", "label", "place"), "kept", scratch)
    main = kept.groupBy("token", "label").agg(F.count("*").alias("c")).groupBy("token").agg(F.count("*").alias("labels"), F.max(F.struct("c", "label"))["label"].alias("main"))
    kept = kept.join(main.where("labels > 1").select("token", "main"), "token").join(sets.select("sid", "met"), "sid")
    return kept.select("token", "sid", "label", "place", "met", (F.col("label") == F.col("main")).alias("main"))


def similar_documents(docs: DataFrame, percent: int = 75, width: int = 5, hot: tuple[int, ...] = (6, 24, 96), rounds: int = 2, exact: bool = False, shares: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of docs with n_shingles, component_id and component_label: the smallest id reachable by links of Jaccard >= percent, and the component's own name, which null or repeated ids don't blur.

    Equal sets are one node. Sets that share a segment key of their size band are candidates. A set leaves out as many
    keys as it has spare segments: first those that more sets hold than the highest of the limits `hot`, and so on.
    Candidates are compared in rounds. In the first, each set meets its key's hub. Each further round takes the keys
    that still hold several components and lets all others meet the hub of what the first hub's component lacks. A
    hub has met all of its key then and leaves it. After `rounds` of them, or one without a link, what still shares a
    key with another component meets those of it that share one of its rarest tokens (`rare_tokens`). So a family of n
    near copies needs about n comparisons, and every link is still either checked or implied.
    Sets of 512 shingles and more are screened by samples with six standard deviations of slack (a link is lost at
    below 1 in 10^8); exact=True checks all of these candidates on their texts instead.
    The keys are dealt to `shares` shuffles, one after the other: each reads all texts, and the largest shuffle's space
    on disk is divided by their number.
    Null and empty texts link with nothing. Rows with a null id link as others do but give no component its id; a
    component of such rows alone has a null id. Columns of docs with the added names are replaced.
    """
    bands = Bands(percent)
    own = [c for c in docs.columns if c not in ("n_shingles", "component_id", "component_label", "_key")]
    keyed = docs.select(*own, row_key(doc_id, text).alias("_key"))
    rows = docs.select(row_key(doc_id, text).alias("key"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    old: list[str] = []
    described = materialize(describe(rows, width), "sets", old)
    sets = described.where("sid is not null").groupBy("sid").agg(F.min_by(F.struct("n", "key", "level", "sketch"), "key").alias("s")).select("sid", "s.n", "s.key", "s.level", *(F.col("s.sketch")[i].alias(c) for i, c in enumerate(_SKETCH)))
    sets = materialize(sets, "distinct", old)

    held = Window.partitionBy("key")
    sent: list[str] = []
    live = None
    for share in range(shares):
        seg = sent_segments(rows.select("text"), bands, width, share, shares)
        seg = seg.repartition("key").groupBy("key", "sid").agg(F.max("tag").alias("tag"))
        seg = materialize(seg.withColumn("c", F.count("*").over(held)).where("c > 1"), "live", sent)
        live = seg if live is None else live.unionByName(seg)
        discard(docs.sparkSession, [])  # the segments' shuffle, the largest of all
    # Each set leaves out its last keys in one order of all keys. Of a pair, the set whose first key left out comes
    # earlier has a segment alike before it, as more are alike than it leaves out; the other keeps that too.
    grade = sum(((F.col("c") > h).cast("int") for h in hot), F.lit(0))
    place = F.row_number().over(Window.partitionBy("sid", "tag").orderBy(F.desc("grade"), F.desc("key")))
    # What a family's base holds, its copies hold too, while a copy's own changes are nobody else's: the set whose
    # keys are held most often, the hub, is like most of the others.
    used = live.repartition("sid").withColumn("grade", grade).withColumns({"place": place, "weight": F.sum("c").over(Window.partitionBy("sid"))})
    used = used.where(F.col("place") > F.col("tag") % _TAG - 1).select("key", "sid", "weight")
    at = F.struct("weight", "sid")
    used = used.withColumns({"c": F.count("*").over(held), "hub": F.max(at).over(held)["sid"]}).where("c > 1")
    here = materialize(used.select("key", "sid", "weight", "hub", F.col("sid").alias("name"), F.col("hub").alias("hub_name")), "used", old)
    discard(docs.sparkSession, sent)

    links, apart, spent = None, None, []
    for _ in range(rounds):
        made: list[str] = []
        pairs = here.where("name <> hub_name").select(F.least("sid", "hub").alias("a"), F.greatest("sid", "hub").alias("b")).distinct()
        if links is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs", old)
        tried = pairs if links is None else tried.unionByName(pairs)
        near = materialize(screened(pairs, sets, percent, exact), "screened", old)
        new = materialize(verified(near, rows, percent, width), "links", old)
        links = new if links is None else links.unionByName(new)
        unlike = near.select("a", "b").join(new, ["a", "b"], "left_anti")
        apart = unlike if apart is None else apart.unionByName(unlike)
        label = materialize(components(links).select(F.col("node").alias("sid"), "label"), "labels", made)
        # A hub has met all of its key but its own component. Keys of one component alone have done their work, now and
        # for all later components, which only grow. Of the others, the hub of what is not of the key's first hub's
        # component meets all that are of other components than its own.
        known = here.where("sid <> hub").select("key", "sid", "weight").join(label, "sid", "left").withColumn("name", F.coalesce("label", "sid"))
        known = known.withColumns({"lo": F.min("name").over(held), "hi": F.max("name").over(held), "first": F.max_by("name", at).over(held)}).where("lo <> hi")
        known = known.withColumn("far", F.max(F.when(F.col("name") != F.col("first"), F.struct("weight", "sid", "name"))).over(held))
        here = known.select("key", "sid", "weight", "name", "first", F.col("far.sid").alias("hub"), F.col("far.name").alias("hub_name"))
        here = materialize(here, "varied", made)
        discard(docs.sparkSession, spent)  # what the round before left and this one has read
        spent = made
        if new.isEmpty():
            break

    # What still shares a key with another component may be linked with it. What a set met in vain in a round goes with
    # it, so that no such pair is brought up again.
    left = here.select(F.col("key").alias("segment"), "sid", F.col("name").alias("label")).join(sets.select("sid", "n", "key"), "sid")
    left = left.join(partners(apart), "sid", "left").withColumn("met", F.coalesce("met", F.array().cast("array<long>")))
    left = materialize(left, "left", old)
    # Of two others than a token's main component, one order is enough.
    rare = materialize(rare_tokens(left, rows, percent, width, old).join(sets, "sid"), "rare", old)
    enough = f"least(a_place, b_place) * {100 + percent} >= {percent} * (a_n + b_n)"
    met = f"a_token = b_token and a_label <> b_label and {enough} and (b_main or a_sid < b_sid) and not array_contains(a_met, b_sid) and not array_contains(b_met, a_sid)"
    more = _named(rare.where("not main"), "a").join(_named(rare, "b"), F.expr(f"{met} and {_may_link(percent, exact)}"))
    low = F.col("a_sid") < F.col("b_sid")
    pick = lambda c: (F.when(low, F.col(f"a_{c}")).otherwise(F.col(f"b_{c}")), F.when(low, F.col(f"b_{c}")).otherwise(F.col(f"a_{c}")))
    (a, b), (ka, kb) = pick("sid"), pick("key")
    more = more.select(a.alias("a"), b.alias("b"), ka.alias("ka"), kb.alias("kb")).distinct()
    links = links.unionByName(verified(materialize(more, "screened", old), rows, percent, width))
    label = materialize(components(links).select(F.col("node").alias("sid"), "label"), "components")
    described = materialize(described.select("key", "doc_id", "n", "sid"), "described")
    discard(docs.sparkSession, [*old, *spent])

    named = described.join(label, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    # Written first, so that the join's other side alone is dealt by label and a large component's rows can be split.
    lowest = materialize(named.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id")), "lowest")
    named = named.join(lowest, "label", "left").withColumn("component_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    named = named.groupBy(F.col("key").alias("_key")).agg(F.min("n").alias("n_shingles"), F.min("component_id").alias("component_id"), F.min(F.coalesce("label", "key")).alias("component_label"))
    return keyed.join(named, "_key").select(*own, "n_shingles", "component_id", "component_label")
