"""The ten operators against brute force on small fixtures with nulls, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemill.llm import chat, common, ctw, jaccard, mixing, packing, pages, quality, queries, substrings, urls, vectors

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATH = queries.tokenizer_path()


def corpus():
    """Texts with copies, near copies, shared passages, repeats, blanks of all kinds, and one long text."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeéñ") for _ in range(r.randint(2, 7))) for _ in range(400)]
    make = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage = make(70)
    texts = [make(r.randint(1, 200)) for _ in range(40)]
    for i in range(12):
        words = texts[i].split(" ")
        for _ in range(max(1, len(words) // 60)):
            words[r.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [f"{make(30)}\n{passage}\t{make(20)}" for _ in range(6)] + [passage, passage.upper(), texts[0], texts[0], make(30) + " " + passage.upper()]
    texts += [None, "", " \t\n\x0b\x0c\r ", "one", "One", "two words", "a b c d", "A  b\nc d", "x " * 300, "\x1c\x85 \xa0q r s t u", make(6000), "l1\nl1\n\n l1\nzz zz zz zz\n" * 3]
    return [(i * 3, t, f"s{i % 3}" if i % 7 else None) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    c = corpus()
    c += [c[5], (6, "another text under a known id " * 12, "s1"), (None, c[3][1], "s0"), (None, None, None)]
    # Columns that clash with what the operators add.
    return spark.createDataFrame(c, "doc_id long, text string, source string").withColumns({"key": F.lit("k"), "n_words": F.lit("x"), "size": F.lit("y"), "n": F.lit(1)}).repartition(3), c


def test_packing(docs):
    df, c = docs
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    want = Counter()
    for d, t, _ in c:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        start = piece = 0
        while start < len(ids):
            n = (len(ids) - start) % 1024 or 1024
            want[(d, piece, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes()))] += 1
            start, piece = start + n, piece + 1
    out = packing.best_fit(packing.token_pieces(df, PATH))
    got = out.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for v in by.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= 1024
    assert sorted(out.collect(), key=str) == sorted(got, key=str)  # the same again
    assert packing.best_fit(packing.token_pieces(df.limit(0), PATH)).count() == 0


def test_best_fit_keeps_few_bins_open_and_wastes_little():
    r = random.Random(1)
    sizes = [r.randint(1, 1024) for _ in range(20000)]
    fit, used = packing.BestFit(1024, 200), Counter()
    for s in sizes:
        b, at = fit.place(s)
        assert at == used[b] and (used := used + Counter({b: s}))[b] <= 1024
        assert fit.open <= 200
        if len(used) > 3000:
            break
    fit = packing.BestFit(1024, 4096)
    for s in sizes:
        fit.place(s)
    assert fit.bins <= 1.03 * math.ceil(sum(sizes) / 1024)


def test_chunks_give_the_tokenizers_ids():
    odd = ["a\n\nb", " \t x", "foo\u00a0bar", "x\u2028y", "it's we'll 'S", "éa1b2", "Ñ.ж", "\n", "  ", "a  b", "…\n", "\x1cz", "\x85q", "<|endoftext|> a", "日本 語", "a\u0301b c", "A.b,c;d (e)", "x" * 5000]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    for text, raw in zip(odd, packing.token_bytes(odd, PATH), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_runs_of_letters_go_to_the_model_alone():
    """A new word skips the tokenizer's pattern and still gets its ids, also where known chunks are forgotten."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True

    class Counted:
        model, asked = tok.model, []

        def encode(self, chunk, **kw):
            self.asked.append(chunk)
            return tok.encode(chunk, **kw)

    r = random.Random(4)
    texts = ["the Ünïcode straße ªº µ ȠɏA a  b", *(" ".join("".join(r.choice("abeinorstéêüßÀÖØöøɏµ") for _ in range(r.randint(1, 9))) for _ in range(60)) for _ in range(5))]
    texts += ["".join(r.choice("ab é×÷ɐʰ日ж\u0301.'\n\u00ad\u00a0 ") for _ in range(80)) for _ in range(40)]
    counted = Counted()
    for most in (7, 100_000):
        ids = packing.ChunkIds(counted, most)
        for t in texts:
            made = b"".join(map(ids.__getitem__, packing._CHUNK.findall(t)))
            assert np.frombuffer(made, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t
            assert len(ids) <= most and len(ids.older) <= most
    letters = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏµªº]+")
    assert counted.asked and not [c for c in counted.asked if letters.fullmatch(c)]


def test_substrings(docs):
    df, c = docs
    first: dict = {}
    for d, t, _ in c:
        w = WORD.findall(t or "")
        if d is not None:
            for i in range(len(w) - 49):
                k = tuple(w[i : i + 50])
                first[k] = min(first.get(k, d), d)
    want, gone_words = Counter(), 0
    for d, t, _ in c:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if d is not None and first[tuple(w[i : i + 50])] < d:
                gone[i : i + 50] = [True] * 50
        gone_words += sum(gone)
        want[(d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))] += 1
    out = substrings.remove_repeats(df)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out.collect()) == want and gone_words > 500
    assert "source" in out.columns and out.select("n_words").dtypes[0][1] == "bigint"
    assert substrings.remove_repeats(df.limit(0)).count() == 0


def small_windows(texts, width):
    got = {}
    for d, t in enumerate(texts):
        w = t.split()
        for i in range(len(w) - width + 1):
            got.setdefault(tuple(w[i : i + width]), d)
    return got


def test_substrings_where_windows_overlap_at_random(spark):
    r = random.Random(3)
    texts = [" ".join(r.choice("ab") for _ in range(r.randint(0, 60))) for _ in range(60)]
    first = small_windows(texts, 12)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for x in substrings.remove_repeats(df, width=12, anchor=4).collect():
        w = texts[x.doc_id].split()
        gone = [False] * len(w)
        for i in range(len(w) - 11):
            if first[tuple(w[i : i + 12])] < x.doc_id:
                gone[i : i + 12] = [True] * 12
        assert x.kept == " ".join(a for a, g in zip(w, gone, strict=True) if not g)


def brute_components(sets, percent=75):
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def shingle_set(t):
    w = WORD.findall((t or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("shares", [1, 3])
def test_jaccard(spark, shares):
    c = [(d, t) for d, t, _ in corpus()]
    df = spark.createDataFrame(c, "doc_id long, text string").withColumn("n_shingles", F.lit("clash")).repartition(3)
    sets = {d: shingle_set(t) for d, t in c}
    want = brute_components(sets)
    got = rows(jaccard.similar_documents(df, shares=shares).select("doc_id", "n_shingles", "component_id"), "doc_id")
    assert got == [(d, len(sets[d]), want[d]) for d in sorted(sets)]
    assert len(set(want.values())) < len(want) - 8


def test_jaccard_of_families_and_shared_passages(spark):
    """Families larger than a hot key, whose members differ at random, and unlike texts around one passage."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    texts = []
    for n in (60, 130, 400):
        base = [word() for _ in range(n)]
        for _ in range(40):
            w = list(base)
            for _ in range(r.randint(0, max(1, n // 50))):
                w[r.randrange(n)] = word()
            texts.append(" ".join(w))
    passage = [word() for _ in range(60)]
    texts += [" ".join([word() for _ in range(r.randint(10, 60))] + passage) for _ in range(50)]
    texts += [" ".join(word() for _ in range(k)) for k in range(1, 30)]
    r.shuffle(texts)
    want = brute_components({i: shingle_set(t) for i, t in enumerate(texts)})
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in jaccard.similar_documents(df, hot=(3, 8)).collect()}
    assert got == want


def test_jaccard_of_large_sets_at_the_threshold(spark):
    """Sets beyond 512 shingles are screened by samples: the default finds what exact=True and brute force do."""
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    texts = []
    for n in (520, 700, 1100, 2600):
        for k in range(8):
            base = [word() for _ in range(n)]
            same = round((n - 4) * (0.86 if k % 2 else 0.855)) + 4  # Jaccard a little above or below 0.75
            texts += [" ".join(base), " ".join(base[:same] + [word() for _ in range(n - same)])]
    want = brute_components({i: shingle_set(t) for i, t in enumerate(texts)})
    assert 8 <= len(texts) - len(set(want.values())) <= 24
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for exact in (False, True):
        assert {x.doc_id: x.component_id for x in jaccard.similar_documents(df, exact=exact).collect()} == want


def test_jaccard_follows_chains_that_have_no_hub(spark):
    """Each text is like its neighbours only, all share one passage, and hubs alone don't find the links."""
    r = random.Random(22)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    passage, own = [word() for _ in range(40)], [word() for _ in range(160)]
    texts = []
    for i in range(40):
        own = own[8:] + [word() for _ in range(8)]
        texts.append(" ".join(passage + own))
    r.shuffle(texts)
    want = brute_components({i: shingle_set(t) for i, t in enumerate(texts)})
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rounds in (1, 3):
        assert {x.doc_id: x.component_id for x in jaccard.similar_documents(df, hot=(3, 8), rounds=rounds).collect()} == want


def test_jaccard_brings_up_no_pair_again_that_was_met_in_vain(spark, monkeypatch):
    """Pairs and families a little below 0.75 share most of their keys: each of these brought up what the rounds had met."""
    r = random.Random(23)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    texts = []
    for copies in [1] * 6 + [7, 7]:
        base = [word() for _ in range(200)]
        texts.append(" ".join(base))
        for _ in range(copies):
            at = r.randrange(10, 150)
            texts.append(" ".join(base[:at] + [word() for _ in range(25)] + base[at + 25 :]))  # Jaccard 0.742
    base = [word() for _ in range(200)]
    texts += [" ".join(base), " ".join(base[:-20] + [word() for _ in range(20)])]
    made, real = {}, jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, hint, scratch=None: made.setdefault(hint, []).append(real(df, hint, scratch)) or made[hint][-1])
    monkeypatch.setattr(jaccard, "discard", lambda *a, **b: None)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in jaccard.similar_documents(df, hot=(3, 8)).collect()}
    assert got == brute_components({i: shingle_set(t) for i, t in enumerate(texts)}) and len(set(got.values())) == len(texts) - 1
    *rounds, last = [{(x.a, x.b) for x in s.select("a", "b").collect()} for s in made["screened"]]
    before = set().union(*rounds)
    assert len(before) >= 8 and not before & last
    (left,) = made["left"]
    by, met = defaultdict(list), {}
    for x in left.collect():
        by[x.segment].append((x.sid, x.label))
        met[x.sid] = x.met
    assert max(map(len, met.values())) ** 2 <= 2 * len(before)
    again = 0
    for held in by.values():
        assert len({label for _, label in held}) > 1
        again += sum((min(a, b), max(a, b)) in before and b not in met[a] and a not in met[b] for a, _ in held for b, _ in held)
    assert again == 0
    assert not met.keys() & {int(jaccard._name(x)[0]) for x in jaccard.shingles([t.encode() for t in texts[:12]])}  # each met its only partner


def test_jaccard_compares_no_outsider_with_a_whole_family(spark, monkeypatch):
    """Copies of one base beyond the threshold share keys with every copy within it, but hardly any can be linked with it."""
    r = random.Random(24)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(404)]

    def copy(w, changes):
        w, at = list(w), r.randrange(5)
        for i in r.sample(range(at, len(w) - 5, 6), changes):
            w[i] = word()
        return w

    outsiders = [copy(base, 13) for _ in range(25)]  # Jaccard 0.720 to the base
    texts = [base, *(copy(base, r.randint(2, 6)) for _ in range(40)), *outsiders, *(copy(w, 5) for w in outsiders[:3])]
    texts += [[word() for _ in range(330)] + base[:90] for _ in range(5)]
    texts = [" ".join(w) for w in texts]
    r.shuffle(texts)
    made, real = {}, jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, hint, scratch=None: made.setdefault(hint, []).append(real(df, hint, scratch)) or made[hint][-1])
    monkeypatch.setattr(jaccard, "discard", lambda *a, **b: None)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in jaccard.similar_documents(df, hot=(3, 8)).collect()}
    assert got == brute_components({i: shingle_set(t) for i, t in enumerate(texts)}) and len(set(got.values())) > 25
    assert made["left"][0].select("sid").distinct().count() > 50
    assert made["screened"][-1].count() < 25


def test_rare_tokens_lose_no_pair(spark):
    """Every pair at the threshold or above shares one that is in place, whatever sizes and families the sets are of."""
    r = random.Random(25)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    texts = []
    for n in (6, 12, 40, 150):
        base = [word() for _ in range(n)]
        for _ in range(30):
            w = base[: r.randint(n * 3 // 5, n)] + [word() for _ in range(r.randint(0, n // 6))]
            if r.random() < 0.4:
                w[r.randrange(len(w))] = word()
            texts.append(" ".join(w))
    texts = sorted(set(texts))
    sets = {int(jaccard._name(x)[0]): set(x.tolist()) for x in jaccard.shingles([t.encode() for t in texts])}
    keys = {int(jaccard._name(x)[0]): k for k, x in enumerate(jaccard.shingles([t.encode() for t in texts]))}
    rows = spark.createDataFrame([(k, t.encode()) for k, t in enumerate(texts)] * 2, "key long, text binary")
    left = spark.createDataFrame([(0, s, s, len(x), keys[s], [0]) for s, x in sets.items()], "segment long, sid long, label long, n long, key long, met array<long>")
    at = {}
    for x in jaccard.rare_tokens(left, rows, 75, 5, []).collect():
        assert at.setdefault((x.token, x.sid), x.place) == x.place
    by = defaultdict(dict)
    for (token, s), place in at.items():
        by[s][token] = place
    alike = 0
    for a, b in combinations(sets, 2):
        both, n = len(sets[a] & sets[b]), len(sets[a]) + len(sets[b])
        if 100 * both >= 75 * (n - both):
            alike += 1
            assert any(175 * min(by[a][k], by[b][k]) >= 75 * n for k in by[a].keys() & by[b].keys())
    assert alike > 100 and len(at) < 0.6 * sum(map(len, sets.values()))


def test_a_copy_keeps_a_key_that_its_large_family_holds():
    """Where all that a copy near 0.75 shares with its base is too common, it must not be able to leave all of it out."""
    r = np.random.default_rng(11)
    bands = jaccard.Bands(75)
    for a in (12, 40, 41, 100, 192, 193, 500, 1300):
        for share in (0.0, 0.5, 1.0):
            gone = round(a * share / 7)
            added = a // 3
            while 100 * (a - gone) < 75 * (a + added):
                added -= 1
            n, both = a - gone + added, (a - gone) / (a + added)
            t = gone + added
            band = max(t - 1, 0).bit_length()
            assert both >= 0.75 and t <= 25 * (a + n) // 175
            shared = set(bands.of(a)) & set(bands.of(n))
            assert (25 * (a + n) // 175 - 1).bit_length() in shared and band <= max(shared)
            for band in [(25 * (a + n) // 175 - 1).bit_length()]:
                for _ in range(100):
                    base, new = r.integers(0, 1 << 63, a).astype(np.uint64), r.integers(0, 1 << 63, added).astype(np.uint64)
                    k, left = jaccard.segments(base, band, bands)
                    copy, most = jaccard.segments(np.concatenate((base[gone:], new)), band, bands)
                    assert len(np.intersect1d(k, copy)) > max(most, left, 0)


def test_jaccard_takes_repeated_rows_and_null_ids(docs, spark):
    df, c = docs
    out = jaccard.similar_documents(df).select("doc_id", "text", "component_id").collect()
    assert len(out) == len(c)
    assert {r.component_id for r in out if r.doc_id is None and r.text == c[3][1]} == {9}
    assert jaccard.similar_documents(df.limit(0)).count() == 0


def test_one_row_of_a_component_stays(spark):
    import corpus_pipeline

    a, b, c = (" ".join(f"{k}{i}" for i in range(80)) for k in "abc")
    near = a + " more"
    data = [(1, a), (1, a), (1, near), (None, b), (None, b), (None, b + " x"), (1, c)]
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((x.doc_id or 0, x.text[0]) for x in corpus_pipeline.near_duplicates(spark, df, "").collect())
    assert got == [(0, "b"), (1, "a"), (1, "c")]


def fill(sizes, weights):
    total, target, open_ = sum(sizes.values()), {}, set(sizes)
    while open_:
        left, w = total - sum(target.values()), sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / w > 3 * sizes[s]]
        if not over:
            return target | {s: left * weights[s] / w for s in open_}
        for s in over:
            target[s] = 3 * sizes[s]
            open_.discard(s)
    return target


def test_mixing(docs):
    df, c = docs
    out = mixing.mix_sources(df, quality=mixing.letter_share(F.col("text")))
    got = out.collect()
    assert len(got) == len(c)
    size = Counter()
    for _, t, s in c:
        size[s] += len(WORD.findall(t or ""))
    names = sorted(s for s in size if s is not None) + [None]
    target = fill(size, {s: i % 3 + 1 for i, s in enumerate(names)})
    taken, most = Counter(), Counter()
    for r in got:
        assert r["size"] == len(WORD.findall(r.text or "")) and r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r["size"])
    for s in names:
        assert abs(taken[s] - target[s]) <= most[s]
    assert Counter(map(tuple, out.select("doc_id", "taken").collect())) == Counter((r.doc_id, r.taken) for r in got)
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_mixing_of_more_sources_than_are_sent(docs):
    """Tables of one row a source that are too many to be broadcast are joined by shuffles, with the same result."""
    df, _ = docs
    few, many = (mixing.mix_sources(df, quality=mixing.letter_share(F.col("text")), most_sent=n) for n in (10_000, 0))
    assert "BroadcastExchange" not in many._jdf.queryExecution().sparkPlan().toString()
    take = lambda x: Counter(map(tuple, x.select("doc_id", "source", "size", "source_size", "target", "taken").collect()))
    assert take(many) == take(few)


def test_mixing_prefers_quality(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"), F.lit("w w w w w").alias("text"), F.when(F.col("id") % 4 < 2, 4.0).otherwise(1.0).alias("q"))
    x = mixing.mix_sources(df, quality=F.col("q"), weights=(1, 3)).where("source = 'a'").groupBy("q").agg(F.sum("taken").alias("t")).collect()
    t = {r.q: r.t for r in x}
    assert abs(sum(t.values()) - 5000) <= 5 and t[4.0] > 1.8 * t[1.0]


def test_quality(docs):
    df, c = docs
    got = quality.judge_quality(df).collect()
    assert len(got) == len(c)
    for r in got:
        t = r.text or ""
        w = WORD.findall(t)
        n = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = [False] * len(w)
        for i in range(len(w) - 2):
            if n[tuple(w[i : i + 3])] > 1:
                again[i : i + 3] = [True] * 3
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), sum(again))
        assert r.base_failed == (len(w) < 50 or 100 * sum(again) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert quality.judge_quality(df.limit(0)).count() == 0


def test_quality_replaces_columns_of_its_own_names(docs):
    df, c = docs
    other = df.withColumns({"cleaned": F.lit("x"), "kept": F.lit(3), "n_template": F.lit("y"), "base_failed": F.lit(None), "_key": F.lit(0), "host": F.lit("h"), "line": F.lit("l"), "whole": F.lit(1)})
    got = quality.judge_quality(other)
    assert len(got.columns) == len(set(got.columns)) and {"host", "line", "whole"} <= set(got.columns) and "_key" not in got.columns
    take = lambda x: Counter(map(tuple, x.select("doc_id", "n_words", "n_template", "kept", "cleaned").collect()))
    assert take(got) == take(quality.judge_quality(df)) and sum(take(got).values()) == len(c)


def test_templates_deplete_but_copies_do_not(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    line = lambda n: " ".join(word() for _ in range(n))
    menu = [line(12) for _ in range(10)]
    thin = ["\n".join(x for m in menu[k % 4 :] for x in (m, line(1))) + "\n" + line(4) for k in range(30)]
    good = ["\n".join([line(30), r.choice(menu), line(30)]) for _ in range(30)]
    copied = "\n".join(line(20) for _ in range(5))
    texts = [(t, "thin") for t in thin] + [(t, "good") for t in good] + [(copied, "copy")] * 40
    df = spark.createDataFrame([(i, t, "h", k) for i, (t, k) in enumerate(texts)], "doc_id long, text string, source string, kind string")
    got = {x.kind: x.kept for x in quality.judge_quality(df).groupBy("kind").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert got == {"thin": 0.0, "good": 1.0, "copy": 1.0}


def test_every_line_of_a_block_is_a_template(spark):
    r = random.Random(12)
    line = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    footer = [line(12) for _ in range(10)]
    df = spark.createDataFrame([(i, "\n".join([line(20), *footer]), "h") for i in range(30)], "doc_id long, text string, source string")
    got = quality.judge_quality(df).collect()
    assert {(x.n_template, x.base_failed, x.kept) for x in got} == {(120, False, False)}
    assert {x.doc_id: x.cleaned for x in got} == {x.doc_id: x.text.split("\n")[0] for x in got}


def test_a_block_rejects_and_repeated_rows_change_nothing(spark):
    r = random.Random(14)
    line = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    block = [line(12) for _ in range(8)]
    data = [(i, "\n".join([line(12), *block]), "h") for i in range(60)] + [(100, "\n".join([line(42), block[3]]), "h")]
    once = spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("kept", F.lit("clash"))
    again = once.unionByName(once.where("doc_id in (5, 100)")).unionByName(once.where("doc_id in (5, 100)"))
    cols = ("doc_id", "n_words", "n_template", "base_failed", "kept")
    one, more = ({tuple(x) for x in quality.judge_quality(x).select(*cols).collect()} for x in (once, again))
    assert one == more == {(i, 108, 96, False, False) for i in range(60)} | {(100, 54, 12, False, True)}


def test_pipeline_passes_texts_on_without_templates(spark):
    import corpus_pipeline

    r = random.Random(13)
    line = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    own = [(line(40), line(40)) for _ in range(20)]
    df = spark.createDataFrame([(i, f"{a}\n\n Menu  {i} HOME\n{b}\nfooter {i}", "en", "h", 9) for i, (a, b) in enumerate(own)] + [(99, "x y " + line(60), "en", "h", 7)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {x.doc_id: x for x in corpus_pipeline.quality_rules(spark, df.unionByName(df.where("doc_id = 0")), "").collect()}
    assert len(got) == 21 and got[99].n_chars == 7
    for i, (a, b) in enumerate(own):
        assert got[i].text == f"{a}\n\n{b}" and got[i].n_chars == len(got[i].text)


def test_vectors(spark):
    r = np.random.default_rng(4)
    data, label = [], []
    for lab, n in ((0, 300), (1, 700), (2, 30)):
        centers = r.standard_normal((n // 6, 24))
        for _ in range(n):
            v = centers[r.integers(len(centers))] + r.standard_normal(24) * r.choice([0.0, 0.15, 0.3])
            data.append([float(np.float32(x)) for x in v])
            label.append(lab)
    extra = [(None, 1), ([0.0] * 24, 1), ([float("nan")] * 24, 1), (data[0], None), ([None] * 24, 0), (data[0][:3], 0), ([float("inf")] + data[0][1:], 0)]
    rows_ = [(i, v, n) for i, (v, n) in enumerate(zip(data, label, strict=True))] + [(2000 + i, v, n) for i, (v, n) in enumerate(extra)]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<float>, label int").withColumns({"kept": F.lit("x"), "point": F.lit(1)})
    m = np.array(data) / np.linalg.norm(data, axis=1, keepdims=True)
    near = (m @ m.T >= 0.93) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(near, False)
    for settings in ({}, {"leaf": 100, "block": 64, "trees": 8}):
        got = {x.vec_id: x for x in vectors.near_vectors(df, **settings).collect()}
        assert len(got) == len(rows_)
        found = sum(got[i].n_links for i in range(len(data)))
        assert all(got[i].n_links <= near[i].sum() for i in range(len(data))) and found >= 0.9 * near.sum()
        if not settings:
            assert found == near.sum()
            sets = brute_pairs(near)
            assert all(got[i].component_id == sets[i] for i in range(len(data)))
        assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(2000, 2000 + len(extra)))
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_the_sample_bounds_a_tree():
    r = np.random.default_rng(5)
    sample = r.standard_normal((2000, 16))

    def nodes(t):
        return 0 if t == 0 else 1 + nodes(t.left) + nodes(t.right)

    few, many = (vectors.grow(sample, rows, 64, 0.2, np.random.default_rng(1)) for rows in (10**6, 10**12))
    assert nodes(few) == nodes(many) < 2000
    assert vectors.grow(np.ones((500, 16)), 10**6, 64, 0.2, np.random.default_rng(1)) == 0
    out = []
    vectors.leaves_of(many, sample, np.arange(len(sample)), np.uint64(1), out)
    assert sum(len(rows) for rows, _ in out) < 6 * len(sample)


def test_forest_finds_links_and_components(spark):
    """Real trees: labels far above the leaf size, recall of links and of components against brute force."""
    r = np.random.default_rng(6)
    centers = r.standard_normal((300, 32))
    data = [[float(x) for x in centers[r.integers(300)] + r.standard_normal(32) * r.choice([0.05, 0.2])] for _ in range(1500)]
    m = np.array(data) / np.linalg.norm(data, axis=1, keepdims=True)
    near = m @ m.T >= 0.93
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(data)], "vec_id long, embedding array<double>, label int")
    got = {x.vec_id: x for x in vectors.near_vectors(df, leaf=150, block=64).collect()}
    assert 0.9 * near.sum() <= sum(x.n_links for x in got.values()) <= near.sum() and near.sum() > 1000
    want = brute_pairs(near)
    assert np.mean([got[i].component_id == want[i] for i in got]) >= 0.9


def brute_pairs(near):
    label = list(range(len(near)))
    changed = True
    while changed:
        changed = False
        for i in range(len(near)):
            low = min([label[i], *(label[j] for j in np.flatnonzero(near[i]))])
            if low < label[i]:
                label[i], changed = low, True
    return label


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b")).unionByName(spark.createDataFrame([(100, 101), (101, 100), (7, 7)], "a long, b long"))
    got = {r.node: r.label for r in common.components(edges).collect()}
    assert got == {i: 0 for i in range(60)} | {100: 100, 101: 100}


HTML = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body><header><p>site</p></header><nav><ul><li>menu</ul></nav>
<div class="cookie-notice">we use</div><div id="sidebar">side</div><main><article><h1>Title &amp; more</h1><p>one<b> bold</b>&nbsp;x<p>two<br>lines &lt;3 &#8364;
<ul><li>a<li>b</ul><form><p>sign up</p></form><div class="ad">buy</div><blockquote>q</blockquote><section class="comments"><p>first!</p></section></article></main><footer>&copy; f</footer></body></html>"""


def test_html(spark):
    same = "<div><p>the same box everywhere</p></div>"
    site = [f"<body>{same}<p>page {'abcdefghijklmn'[i]} own</p></body>" for i in range(8)]
    pages_ = [(0, "http://A.com/x", HTML), (1, None, None), (2, "u", ""), (3, "http://b.com", "<article><p>cut <b>here<p>an"), (4, "http://b.com", "<div>" * 3000 + "deep"), (5, "x", "a <i>b</i>\n\tc < d")]
    pages_ += [(10 + i, "http://c.com/" + str(i), h) for i, h in enumerate(site)]
    df = spark.createDataFrame(pages_, "page_id long, url string, html string").withColumns({"text": F.lit(1), "host": F.lit("z")})
    got = {r.page_id: r.text for r in pages.extract_text(df).collect()}
    assert got[0] == "Title & more\none bold x\ntwo lines <3 €\na\nb\nq"
    assert (got[1], got[2], got[3], got[4], got[5]) == ("", "", "cut here\nan", "deep", "a b c < d")
    assert got[10] == "page a own" and got[17] == "page h own"
    assert pages.extract_text(df.limit(0)).count() == 0


def test_copies_of_a_page_make_no_template(spark):
    page = lambda k: f"<html><body><h1>T{k}</h1><div><p>text of page {k}</p></div></body></html>"
    data = [(i, "http://h.org/a", page("a")) for i in range(4)] + [(0, "http://h.org/a", page("a"))] + [(9, "http://h.org/b", page("b"))]
    got = [(r.page_id, r.text) for r in pages.extract_text(spark.createDataFrame(data, "page_id long, url string, html string")).collect()]
    assert sorted(got) == sorted([(i, "Ta\ntext of page a") for i in (0, 0, 1, 2, 3)] + [(9, "Tb\ntext of page b")])


def test_repeated_pages_count_once_and_all_return(spark):
    """Rows that repeat whole, and rows of one id with different pages, each return once and change no count."""
    page = lambda k: f"<body><div><p>the menu of all</p></div><p>own {'abcdefghij'[k]}</p></body>"
    data = [(k, "http://h.org/", page(k)) for k in range(8)]
    more = data + data[:3] * 4 + [(0, "http://h.org/", page(9)), (None, None, None), (None, None, None)]
    read = lambda x: Counter((r.page_id, r.text) for r in pages.extract_text(spark.createDataFrame(x, "page_id long, url string, html string")).collect())
    want = Counter((k, f"own {'abcdefghij'[k]}") for k, _, _ in data + data[:3] * 4)
    want.update([(0, "own j"), (None, ""), (None, "")])
    assert read(more) == want and read(data) == Counter((k, f"own {'abcdefghij'[k]}") for k in range(8))


@pytest.mark.parametrize("values,marked", [
    ("market-share", False), ("ad-hoc", False), ("ad", True), ("ad-slot", True), ("cookie-notice", True), ("share-buttons", True), ("site_footer", True), ("article-header", False), ("shared", False), ("story comments", True), ("ad2", True), ("related", True), ("notice-of-works", False),
])
def test_marks_are_whole_values(values, marked):
    e = pages.Element("div", values)
    assert (e.marked or e.head) == marked


def test_random_sites_give_their_own_text(spark):
    """Sites without article elements: boxes that recur on a host go, what only one page has stays."""
    r = random.Random(17)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    data, want = [], {}
    for site in range(4):
        boxes = [f"<div><ul><li>{word()} {word()}</li><li>{word()}</li></ul></div>" for _ in range(3)] + [f"<p>{word()} {word()} {word()}</p>"]
        for k in range(12):
            own = [" ".join(word() for _ in range(r.randint(3, 9))) for _ in range(r.randint(1, 5))]
            parts = [f"<p>{t}</p>" if r.random() < 0.5 else f"<div><section><p>{t}</p></section></div>" for t in own]
            for box in boxes:
                parts.insert(r.randint(0, len(parts)), box)
            data.append((site * 100 + k, f"http://s{site}.org/{k}", "<body>" + "".join(parts) + "</body>"))
            want[site * 100 + k] = "\n".join(own)
    got = pages.extract_text(spark.createDataFrame(data, "page_id long, url string, html string")).collect()
    assert {x.page_id: x.text for x in got} == want


def test_passages_that_articles_share_stay(spark):
    shared = "<p>a passage that all articles of the host quote</p>"
    df = spark.createDataFrame([(i, "http://h.org/", f"<nav>n</nav><article><h1>t{i}</h1>{shared}<p>own {i}</p></article>") for i in range(20)], "page_id long, url string, html string")
    assert all(r.text == f"t{r.page_id}\na passage that all articles of the host quote\nown {r.page_id}" for r in pages.extract_text(df).collect())


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    ("https://m.Example.COM/en/7x?q", "m.example.com", "/en/7x", "example.com/en/7", "allow"), ("http://x.com/en/8#t", "x.com", "/en/8", "com/en/", "block"), ("http://example.com", "example.com", "", None, None),
    ("ftp://a.net/de/", "a.net", "/de/", "net/de/", "allow"), ("http://b.example.net/de/81", "b.example.net", "/de/81", "example.net/de/8", "block"), ("http://notexample.com/en/7", "notexample.com", "/en/7", "com/en/", "block"),
    ("no scheme/en/", "", "", None, None), (None, "", "", None, None), ("http://org/es/", "org", "/es/", "org/es/", "block"), ("a://b?c://d/e", "b", "", None, None), ("http://x.com/EN/", "x.com", "/EN/", None, None),
])
def test_url_rules(spark, url, host, path, rule, verdict):
    h, p = urls.host_of(F.lit(url).cast("string")), urls.path_of(F.lit(url).cast("string"))
    r, v = urls.rule_of(h, p)
    assert tuple(spark.range(1).select(h, p, r, v).first()) == (host, path, rule, verdict)


def test_url_models_tell_kinds_apart(spark):
    r = random.Random(6)
    good = lambda: f"http://news{r.randint(1, 9)}.example.info/articles/{r.choice(['science', 'history', 'music'])}-{r.choice(['review', 'story'])}"
    bad = lambda: f"http://xx{r.randint(10, 99)}casino.example.biz/win?{r.randint(1, 999)}&free-spins-{r.choice('qxz')}{r.choice('qxz')}"
    data = [(i, u, i % 2 == 0) for i, u in enumerate(good() if i % 2 == 0 else bad() for i in range(600))]
    df = spark.createDataFrame(data, "id long, text string, accepted boolean")
    model = urls.train(df.where("id < 400"))
    got = urls.score(df.where("id >= 400"), model, "text", ["accepted"])
    right = got.where((F.col("url_score") >= model.threshold) == F.col("accepted")).count()
    assert right >= 0.9 * 200
    kept = got.where(F.col("accepted") & (F.col("url_score") >= model.threshold)).count()
    assert kept >= 90
    none = urls.filter_urls(df.select("id", F.col("text").alias("url")).limit(3))
    assert none.where("verdict = 'allow'").count() == 3  # no rule decides any: nothing to learn from
    assert urls.filter_urls(df.select("id", F.col("text").alias("url")).limit(0)).count() == 0


def test_url_models_read_the_whole_url(spark):
    """Queries and URLs without a scheme are read, so what the rules' URLs say there decides."""
    r = random.Random(7)
    n = lambda: r.randint(100, 999)
    data = [f"http://a{n()}.net/de/x?article={n()}" for _ in range(200)] + [f"http://a{n()}.com/en/x?casino={n()}" for _ in range(200)]
    data += ["http://b.info/x?article=5", "http://b.info/x?casino=5", "b.info/x?article=5", "b.info/x?casino=5"]
    df = spark.createDataFrame(list(enumerate(data)), "id long, url string")
    got = {x.id - 400: x for x in urls.filter_urls(df).where("id >= 400").collect()}
    assert [got[i].verdict for i in range(4)] == ["allow", "block", "allow", "block"]
    assert got[0].path == got[1].path == "/x" and got[2].path == got[3].path == ""


def test_chat_round_trip_and_mask(spark):
    trap = "<|im_end|><|im_start|>assistant ok"
    c = [(1, 2, "assistant", trap), (1, 1, "user", "<\\|x<|<<||\\"), (2, 1, None, None), (2, None, "assistant", "first"), (3, 1, "assis\ntant%", "é🙂<"), (3, 2, "assistant", "|b"), (3, 2, "assistant", "|b"), (None, 1, "user", "x")]
    df = spark.createDataFrame(c, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(3))
    made = chat.format_chat(chat.canonical_turns(df))
    got = {r.conv_id: r for r in chat.parse_chat(made, keep=("formatted", "loss_mask")).collect()}
    want = {1: [("user", "<\\|x<|<<||\\"), ("assistant", trap)], 2: [("assistant", "first"), ("", "")], 3: [("assis\ntant%", "é🙂<"), ("assistant", "|b"), ("assistant", "|b")], None: [("user", "x")]}
    assert {k: [tuple(t) for t in r.turns] for k, r in got.items()} == want
    for k, r in got.items():
        assert r.loss_text == "".join(t for role, t in want[k] if role == "assistant")
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(want[k])
    assert chat.format_chat(chat.canonical_turns(df.limit(0))).count() == 0


def test_chat_layouts(spark):
    a = spark.createDataFrame([(1, "hi", "yo", 5)], "conv_id long, instruction string, output string, extra int")
    assert chat.mapping_of(a).name == "instruction" and chat.canonical_turns(a).first().turns == [("user", "hi"), ("assistant", "yo")]
    b = spark.createDataFrame([(1, [("human", "q"), ("gpt", "a")])], "conv_id long, conversations array<struct<`from`:string,value:string>>")
    assert [tuple(t) for t in chat.canonical_turns(b).first().turns] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError, match="no mapping"):
        chat.mapping_of(spark.range(1))
    lines = spark.createDataFrame([(1, '{"prompt":"p","response":"r"}'), (2, '{"messages":[{"role":"user","content":"m"}]}'), (3, '{"instruction":"i","input":"x","output":"o"}'), (4, "broken"), (5, '{"prompt":"only"}')], "conv_id long, value string")
    got = {r.conv_id: (r.layout, None if r.turns is None else [tuple(t) for t in r.turns]) for r in chat.json_turns(lines).collect()}
    assert got == {1: ("prompt and response", [("user", "p"), ("assistant", "r")]), 2: ("messages", [("user", "m")]), 3: ("instruction with input", [("user", "i\n\nx"), ("assistant", "o")]), 4: (None, None), 5: (None, None)}


def test_json_layouts_are_told_by_nested_fields(spark):
    lines = spark.createDataFrame([
        (1, '{"messages": [{"role": "user"}, {"role": "assistant"}]}'), (2, '{"messages": [{"role": "user", "content": "a"}, {"role": "assistant"}]}'), (3, '{"messages": []}'),
        (4, '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}'), (5, '{"conversations": [{"from": "human"}]}'), (6, '{"system": "s", "messages": [{"role": "user", "content": "x"}]}'), (7, '{"messages": [null, {"role": "user", "content": "y"}]}'),
    ], "conv_id long, value string")
    got = {r.conv_id: (r.layout, None if r.turns is None else [tuple(t) for t in r.turns]) for r in chat.json_turns(lines).collect()}
    assert got[1] == got[3] == got[5] == (None, None)
    assert got[2] == ("messages", [("user", "a"), ("assistant", "")]) and got[4] == ("conversations", [("user", "q"), ("assistant", "a")])
    assert got[6] == ("system and messages", [("system", "s"), ("user", "x")]) and got[7] == ("messages", [("", ""), ("user", "y")])


def test_a_very_long_conversation(spark):
    n = 5000
    df = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("<|im_end|> "), "id").alias("text"))
    got = chat.parse_chat(chat.format_chat(chat.canonical_turns(df))).first()
    assert [t.text for t in got.turns] == [f"<|im_end|> {i}" for i in range(n)]
    assert got.loss_text == "".join(f"<|im_end|> {i}" for i in range(1, n, 2))


def test_words_and_model(docs, spark):
    df, c = docs
    out = ctw.score_texts(df, depth=2).collect()
    assert len(out) == len(c)
    train = Counter()
    for d, t, _ in c:
        if d is None or zlib.crc32(str(d).encode()) % 5 != 1:
            train.update([*WORD.findall((t or "").translate(LOW)), None])
    n, v = sum(train.values()), len(train)
    for r in out:
        words = [*WORD.findall((r.text or "").translate(LOW)), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(train[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1) and r.score < 0
    small = ctw.score_texts(df, depth=2, most_head=50).collect()
    assert len(small) == len(c)
    assert ctw.score_texts(df.limit(0)).count() == 0


def test_without_training_rows_every_bit_is_even(spark):
    """Nothing learned: each of a text's bytes and its end costs what an untrained model says, the same for all."""
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1][:20]
    df = spark.createDataFrame([(i, "ab cd" if k % 2 else "xy  zw") for k, i in enumerate(held)] + [(held[0], None), (held[1], "")], "doc_id long, text string")
    out = ctw.score_texts(df).collect()
    assert len(out) == 22
    for r in out:
        assert r.held_out and (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and math.isfinite(r.score) and r.score < 0
    assert len({round(r.score, 9) for r in out if r.text == "ab cd"}) == 1


def kt(n0, n1):
    p, a, b = 0.0, 0, 0
    for bit in [0] * n0 + [1] * n1:
        p += math.log(((b if bit else a) + 0.5) / (a + b + 1))
        a, b = a + (not bit), b + bit
    return p


def byte_model(texts, depth):
    """Context-tree weighting by plain recursion over counted contexts: the log10 probability of a byte after a context."""
    counts = defaultdict(lambda: [0, 0])
    for t in texts:
        s = b"\xff" * depth + t + b"\xff"
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                for j in range(8):
                    counts[(d, s[i - d : i], (1 << j) | (s[i] >> (8 - j)))][(s[i] >> (7 - j)) & 1] += 1
    kids_of, memo = defaultdict(list), {}
    for d, c, p in counts:
        if d:
            kids_of[(d - 1, c[1:], p)].append((d, c, p))

    def pw(key):
        if key not in memo:
            own = kt(*counts[key])
            if key[0] == depth:
                memo[key] = own, own, own
            else:
                kids = sum(pw(k)[0] for k in kids_of[key])
                memo[key] = np.logaddexp(own, kids) - math.log(2), own, kids
        return memo[key]

    def probability(ctx, byte):
        total = 0.0
        for j in range(8):
            prefix, bit, path = (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1, []
            for d in range(depth + 1):
                if (key := (d, ctx[depth - d :], prefix)) in counts:
                    path.append(key)
            p = 0.5
            for i, key in enumerate(reversed(path)):
                n0, n1 = counts[key]
                one = (n1 + 0.5) / (n0 + n1 + 1)
                _, own, kids = pw(key)
                p = one if i == 0 else (math.exp(own - kids) * one + p) / (math.exp(own - kids) + 1)
            total += math.log10(p if bit else 1 - p)
        return total

    def score(text):
        s = b"\xff" * depth + text + b"\xff"
        return sum(probability(s[i - depth : i], s[i]) for i in range(depth, len(s)))

    score.byte = probability
    return score


@pytest.mark.parametrize("depth,top,most_head", [(2, 3, 50), (3, 1, 0), (5, 3, 1000), (5, 2, 1_000_000), (4, 0, 10)])
def test_scores_equal_the_recursion(spark, depth, top, most_head):
    """Held-out texts bring contexts that no training text has; what is broadcast or a task's changes nothing."""
    r = random.Random(depth)
    texts = ["abracadabra", "abba", "cab", None, "", "é🙂", "zz top abra"] + ["".join(r.choice("ab cé") for _ in range(r.randint(0, 40))) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(3, None), (0, "abracadabra")], "doc_id long, text string")
    got = ctw.score_texts(df, F.col("doc_id") % 3 == 1, depth=depth, most_head=most_head, top=top).collect()
    train = [(r.text or "").encode() for r in got if r.doc_id % 3 != 1]
    score = byte_model(train, depth)
    for x in got:
        assert x.score == pytest.approx(score((x.text or "").encode()), rel=1e-6)
        assert x.bits_per_byte == pytest.approx(-x.score / math.log10(2) / (len((x.text or "").encode()) + 1))
    ctx = b"abracab"[-depth:]
    assert sum(10 ** score.byte(ctx, b) for b in range(256)) == pytest.approx(1.0)


def test_model_nears_the_entropy_of_held_out_text(spark):
    """Ten parts of two letters each, two to five a word: 1.70 bits a byte at best."""
    r = random.Random(8)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    text = lambda: " ".join("".join(r.choice(parts) for _ in range(r.randint(2, 5))) for _ in range(60))
    df = spark.createDataFrame([(i, text()) for i in range(300)], "doc_id long, text string")
    x = ctw.score_texts(df, depth=3).where("held_out").agg(F.avg("bits_per_byte").alias("bits"), F.count("*").alias("n")).first()
    assert x.n > 30 and 1.65 < x.bits < 1.85


def test_hashes():
    words = "a bb ccc a bb ccc dd".split()
    text = " \t".join(words).encode()
    h = common.word_hashes(text)
    assert h[0] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 4
    s = common.Sequence(h)
    assert s.windows(3)[0] == s.windows(3)[3] and len(set(s.windows(3).tolist())) == 4 and len(s.windows(8)) == 0
    assert s.runs(np.array([0]), np.array([3]))[0] == s.runs(np.array([3]), np.array([6]))[0]
    assert hashlib  # digests are the queries' own
