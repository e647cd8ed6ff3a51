"""Fill-in-middle, source divergence and fingerprints against brute force, round trips and exact sets."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import LOW, WORD, corpus

from tidemill.llm import divergence, fingerprints, infill

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]")
TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(9)
    texts = [t for _, t, _ in corpus()] + ["<P>a", "b<S>", "x <M> y", "<P", "S>", "a" * 3000, "é" * 700 + "Zz" * 900, "<" * 50, "𝄞x𝄞", "ab\x00\x01cd", "Straße ÀB àb DNA dna" * 40]
    c = [(i * 3, t, ("en", "de", "", None)[i % 4], f"s{r.randrange(5)}" if i % 7 else None) for i, t in enumerate(texts)]
    c += [c[5], (6, "another text under a known id " * 12, "en", "s1"), (None, texts[3], "de", "s0"), (None, None, None, None), (9001, "rare words only here", "fr", "alone"), (9002, "12 34", "xx", "s1"), (9003, "", "xx", "s2")]
    df = spark.createDataFrame(c, "doc_id long, text string, lang string, source string")
    # Columns that clash with what the operators add.
    return df.withColumns({k: F.lit("x") for k in ("n", "form", "frames", "next", "rank", "term", "count", "fingerprint", "n_chars")}).repartition(5), c


def draw(name, n, text, seed=1):
    h = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    plain = not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90
    return "plain" if plain else "spm" if h4 % 100 < 20 else "psm", *sorted((h1 % (n + 1), h2 % (n + 1)))


@pytest.mark.parametrize("frame_bytes", [5, 64, 1 << 16])
def test_fill_in_middle(docs, frame_bytes):
    df, c = docs
    want = Counter()
    for d, t, *_ in c:
        t = t or ""
        u = UNITS.findall(t)
        form, a, b = draw("" if d is None else d, len(u), t)
        p, m, s = ("".join(x) for x in (u[:a], u[a:b], u[b:]))
        out = {"plain": t, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        sizes = (None, None) if form == "plain" else (len(p), len(m))
        want[(d, len(u), form, *sizes, out, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())] += 1
    made = infill.fill_in_middle(infill.frame_texts(df, frame_bytes))
    got = infill.read_frames(made).collect()
    cols = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "text", "output_sha256", "restored_sha256")
    assert Counter(tuple(r[k] for k in cols) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert "source" in made.columns and "frames" not in made.columns
    assert infill.fill_in_middle(infill.frame_texts(df.limit(0))).count() == 0
    assert {r.form for r in infill.fill_in_middle(infill.frame_texts(df), rate=0).collect()} == {"plain"}


def test_frames_seek_without_reading_the_rest():
    text = ("word, " * 400 + "é" * 90 + "Q" * 300).encode()
    frames = infill.frames_of(text, 100)
    units = UNITS.findall(text.decode())
    assert frames[-1].units == len(units) and frames[-1].chars == len(text.decode())
    assert b"".join(infill.contents(f.data for f in frames)) == text
    for unit in range(0, len(units) + 1, 7):
        cut = infill.cut_before(frames, unit)
        part = [f if i == cut.frame else f._replace(data=b"") for i, f in enumerate(frames)]  # only one frame is needed
        assert infill.cut_before(part, unit) == cut and cut.chars == len("".join(units[:unit]))
        head = b"".join(infill.contents(infill.between(frames, infill.Cut(0, 0, 0), cut)))
        assert head.decode() == "".join(units[:unit])


def test_restoring_finds_marks_across_frames():
    text = b"<S>suffix<P><<P>pre<<M>mid"
    for n in range(1, 9):
        frames = [infill._pack.compress(text[i : i + n]) for i in range(0, len(text), n)]
        assert b"".join(infill.restored(frames, "psm")) != b"" and b"".join(infill.restored(frames, "plain")) == text
    for form in ("psm", "spm"):
        for p, m, s in (("a<", "<P", "S>b"), ("", "", ""), ("é<S", ">", "<M")):
            parts = [[infill._pack.compress(x.encode())] if x else [] for x in (p, m, s)]
            whole = b"".join(infill.contents(infill.arrange(form, *parts)))
            for n in (1, 2, 3, 100):
                cut = [infill._pack.compress(whole[i : i + n]) for i in range(0, len(whole), n)]
                assert b"".join(infill.restored(cut, form)).decode() == p + m + s


def audit(c, min_docs=3, top=200):
    """The contract, term by term."""
    rows = [(lang or "", source or "", TERMS.findall((t or "").translate(LOW))) for _, t, lang, source in c]
    held, out = defaultdict(Counter), []
    for lang, _, terms in rows:
        held[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in x.items() if n >= min_docs) for lang, x in held.items()}
    count: dict = defaultdict(Counter)
    for lang, source, terms in rows:
        keep = set(kept[lang])
        for key in ((lang, source), (lang,)):
            count[key].update(t for t in terms if t in keep)
    parts = {k: {t: 1 + 10**9 * (x[t] + 1) // (sum(x.values()) + len(kept[k[0]])) for t in kept[k[0]]} for k, x in count.items()}
    groups = [k for k in count if len(k) == 2]
    f = lambda p, q: (p - q) * (p - q) // q
    for lang, source in groups:
        p = parts[lang, source]
        pairs = [(b, sum(f(p[t], parts[lang, b][t]) for t in p)) for a, b in groups if a == lang and b != source]
        terms = [(t, f(p[t], parts[lang,][t])) for t, n in count[lang, source].items() if n and p[t] > parts[lang,][t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, v, i + 1) for i, (item, v) in enumerate(items)]
    return sorted(out)


def test_source_divergence(docs):
    df, c = docs
    out = divergence.source_divergence(df)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    want = audit(c)
    assert sorted(tuple(r) for r in out.collect()) == want
    assert ("xx", "s1", "pair", "s2", 0, 1) in want and not any(r[0] == "fr" for r in want)
    assert sorted(tuple(r) for r in divergence.source_divergence(df, min_docs=1, top=3).collect()) == audit(c, 1, 3)
    assert divergence.source_divergence(df.limit(0)).count() == 0


def test_pair_sums_in_blocks_of_sources(spark):
    r = random.Random(2)
    c = [(i, " ".join(r.choice("abcdefghijk") * r.randint(1, 3) for _ in range(r.randint(0, 30))), r.choice(("en", "de")), f"s{r.randrange(9)}") for i in range(150)]
    whole = {(lang, a, b): v for lang, a, part, b, v, _ in audit(c) if part == "pair"}
    terms = {lang: sorted({t for x in c if x[2] == lang for t in TERMS.findall(x[1])}) for lang in ("en", "de")}
    data = []
    for lang, kept in terms.items():
        kept = [t for t in kept if sum(t in TERMS.findall(x[1]) for x in c if x[2] == lang) >= 3]
        sources = sorted({x[3] for x in c if x[2] == lang})
        n = {s: Counter(t for x in c if x[2:] == (lang, s) for t in TERMS.findall(x[1]) if t in kept) for s in sources}
        p = lambda s, k: 1 + 10**9 * (k + 1) // (sum(n[s].values()) + len(kept))
        zeros = [p(s, 0) for s in sources]
        data += [(lang, len(sources), zeros, [(i, p(s, n[s][t])) for i, s in enumerate(sources) if n[s][t]]) for t in kept]
    df = spark.createDataFrame(data, "lang string, n_sources int, zeros array<long>, here array<struct<at: int, p: long>>").repartition(3)
    for block, most_held in ((256, 1 << 26), (4, 1 << 26), (2, 0)):
        got = {(x.lang, f"s{x.a}", f"s{x.b}"): x.value for x in divergence.pair_sums(df, block, most_held).collect()}
        assert got == whole and len(got) == 2 * 9 * 8


def test_terms_of_all_lengths_are_counted():
    r = random.Random(4)
    texts = [" ".join(r.choice("aébZ") * r.choice((1, 3, 4, 7, 8, 9, 15, 16, 17, 40)) for _ in range(r.randint(0, 80))) + r.choice(["", ".", "\x00", "_x"]) for _ in range(60)]
    groups = np.array([i // 20 for i in range(60)])
    got: Counter = Counter()
    for terms, g, n, d in divergence.count_terms([t.encode() for t in texts], groups):
        for t, *x in zip(terms, g.tolist(), n.tolist(), d.tolist(), strict=True):
            assert (t, x[0]) not in got
            got[t, x[0]] = (x[1], x[2])
    want: dict = defaultdict(lambda: (0, 0))
    for t, g in zip(texts, groups.tolist(), strict=True):
        for term, n in Counter(TERMS.findall(t.translate(LOW))).items():
            a, b = want[term.encode(), g]
            want[term.encode(), g] = (a + n, b + 1)
    assert dict(got) == dict(want)
    words = [np.array([r.getrandbits(64) % m for _ in range(500)], np.uint64) for m in (3, 1 << 40)]
    assert divergence.radix_order(words).tolist() == sorted(range(500), key=lambda i: (words[0][i], words[1][i], i))


def shingles(text, k=5):
    w = WORD.findall(text)
    return {hashlib.md5(" ".join(w[i : i + k]).encode()).hexdigest()[:16] for i in range(max(len(w) - k + 1, 1))} if w else set()


def near(a, b, k=128):
    a, b = (sorted(x)[:k] for x in (a, b))
    u = sorted({*a, *b})[:k]
    return len(set(u) & set(a) & set(b)) / len(u) if u else 1.0


def expected(c):
    """Rows of the contract, for ids that differ; rows without an id have no next."""
    known = sorted((x for x in c if x[0] is not None), key=lambda x: x[0])
    after = {x[0]: known[(i + 1) % len(known)][1] or "" for i, x in enumerate(known)}
    for d, t, *_ in c:
        t, nxt = t or "", after.get(d, "") if d is not None else ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        a, b, n = shingles(t), shingles(edited), shingles(nxt)
        yield d, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(sorted(a)[:128]), "".join(sorted(b)[:128]), near(a, b), near(a, n)


@pytest.mark.parametrize("rows_each", [1, 7, 500])
def test_fingerprints(spark, docs, rows_each):
    df, c = docs
    seen: set = set()
    c = [x for x in c if x[0] is None or not (x[0] in seen or seen.add(x[0]))]
    one = spark.createDataFrame(c, "doc_id long, text string, lang string, source string").withColumns({"next": F.lit("x"), "fingerprint": F.lit("y"), "n_chars": F.lit(1)}).repartition(5)
    out = fingerprints.fingerprint_documents(one, rows_each=rows_each)
    cols = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    got = Counter(tuple(r[k] for k in cols) for r in out.collect())
    assert got == Counter(expected(c))
    assert "next" in out.columns
    many = fingerprints.fingerprint_documents(df, rows_each=rows_each).collect()
    assert len(many) == df.count()
    same = {(r.text or "", r.fingerprint) for r in many}
    assert len(same) == len({t for t, _ in same})  # equal texts, equal fingerprints
    assert fingerprints.fingerprint_documents(df.limit(0)).count() == 0
    alone = fingerprints.fingerprint_documents(df.where("doc_id = 9001")).first()
    assert alone.near_next == 1.0


def test_plan_of_fingerprints_has_one_shuffle_and_no_python(docs):
    df, _ = docs
    plan = fingerprints.fingerprint_documents(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan


def test_sketches_merge_and_estimate(spark):
    r = random.Random(6)
    words = [f"w{i}" for i in range(4000)]
    base = [r.choice(words) for _ in range(6000)]
    other = base[:4500] + [r.choice(words) for _ in range(1500)]
    texts = [" ".join(base), " ".join(other), " ".join(base[:2000]), " ".join(r.choice(words) for _ in range(50)), ""]
    df = spark.createDataFrame([(a, b, texts[a], texts[b]) for a in range(5) for b in range(5)], "a int, b int, x string, y string")
    s, t = fingerprints.sketch(F.col("x"), 512), fingerprints.sketch(F.col("y"), 512)
    got = df.select("a", "b", fingerprints.resemblance(s, t, 512).alias("j"), fingerprints.containment(s, t, 512).alias("c"), fingerprints.distinct_count(s, 512).alias("n")).collect()
    for g in got:
        x, y = shingles(texts[g.a]), shingles(texts[g.b])
        assert abs(g.n - len(x)) <= 0.2 * len(x) and (len(x) >= 512 or g.n == len(x))
        assert abs(g.j - (len(x & y) / len(x | y) if x | y else 1.0)) < 0.09
        assert abs(g.c - (len(x & y) / len(x) if x else 1.0)) < 0.2
    parts = spark.createDataFrame([(k, " ".join(base[i : i + 304])) for k in ("p", None) for i in range(0, 6000, 300)] + [("q", "a b"), ("e", "")], "k string, t string")
    whole = fingerprints.sketch_groups(parts.select("k", fingerprints.sketch(F.col("t")).alias("sketch")), ["k"]).collect()
    got = {r.k: r.sketch for r in whole}
    assert got["p"] == sorted(shingles(texts[0]))[:128] == got[None]
    assert got["q"] == sorted(shingles("a b")) and got["e"] == []
    back = parts.select(fingerprints.sketch(F.col("t")).alias("s")).select("s", fingerprints.from_text(fingerprints.as_text(F.col("s"))).alias("u")).collect()
    assert all(r.s == r.u for r in back)
