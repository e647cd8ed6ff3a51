"""The URL models against plain dictionaries of contexts."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from tidemill.llm import urls

ORDER, STRENGTH = 3, 4.0
LABELLED = [(f"https://a.com/article/{k}", True) for k in range(8)] + [(f"http://b.org/?ad={k}x", False) for k in range(8)] + [("", True), ("https://a.com/article/1", True)]


def plain_score(rows, text):
    """Mean log ratio a character, every probability worked out from counts of whole contexts."""
    pairs, contexts = Counter(), Counter()
    for url, ok in rows:
        padded = "\x02" * ORDER + url + "\x03"
        for i in range(ORDER, len(padded)):
            for k in range(ORDER + 1):
                pairs[ok, padded[i - k : i], padded[i]] += 1
                contexts[ok, padded[i - k : i]] += 1
    padded, gain = "\x02" * ORDER + text + "\x03", 0.0
    for i in range(ORDER, len(padded)):
        p = {True: 1 / 256, False: 1 / 256}
        for k in range(ORDER + 1):
            for ok in p:
                p[ok] = (pairs[ok, padded[i - k : i], padded[i]] + STRENGTH * p[ok]) / (contexts[ok, padded[i - k : i]] + STRENGTH)
        gain += math.log(p[True]) - math.log(p[False])
    return gain / (len(padded) - ORDER)


def test_model_is_that_of_plain_counts(spark):
    model = urls.train(spark.createDataFrame(LABELLED, "text string, accepted boolean"), order=ORDER, bits=20)
    texts = ["https://a.com/article/99", "http://b.org/?ad=3x", "", "ftp://nowhere", "x" * 5000]
    assert np.allclose(model.score([t.encode() for t in texts]), [plain_score(LABELLED, t) for t in texts])


def test_left_out_scores_are_those_of_a_model_without_the_url(spark):
    model = urls.train(spark.createDataFrame(LABELLED, "text string, accepted boolean"), order=ORDER, bits=20)
    accepted = [k for k, (_, ok) in enumerate(LABELLED) if ok]
    got = model.score([LABELLED[k][0].encode() for k in accepted], left_out=0)
    assert np.allclose(got, [plain_score(LABELLED[:k] + LABELLED[k + 1 :], LABELLED[k][0]) for k in accepted])


def test_threshold_loses_no_more_than_its_share(spark):
    rows = LABELLED * 5
    model = urls.train(spark.createDataFrame(rows, "text string, accepted boolean").repartition(3), order=ORDER, bits=20, keep_accepted=0.9)
    kept = [model.score([t.encode()], left_out=0)[0] >= model.threshold for t, ok in rows if ok]
    assert sum(kept) >= 0.9 * len(kept)


def test_repeated_rows_nulls_and_clashing_names(spark):
    rows = [(1, "https://example.com/en/7", "x"), (1, "https://example.com/en/7", "x"), (2, None, "y"), (3, "", None), (4, "https://q.com/en/1", "z"), (5, "no scheme", "z")]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert (by_id[1].host, by_id[1].rule, by_id[1].verdict) == ("example.com", "example.com/en/7", "allow")
    assert (by_id[2].host, by_id[2].path, by_id[2].rule) == ("", "", None) and by_id[2].verdict == by_id[3].verdict
    assert (by_id[4].rule, by_id[4].verdict) == ("com/en/", "block")


@pytest.mark.parametrize("accepted", [True, False])
def test_one_class_says_nothing(spark, accepted):
    rows = [(t, accepted) for t, _ in LABELLED]
    assert urls.train(spark.createDataFrame(rows, "text string, accepted boolean")).threshold == -np.inf
    assert urls.train(spark.createDataFrame([], "text string, accepted boolean")).threshold == -np.inf


def test_shipped_model_is_that_of_plain_counts_of_its_sample(spark, monkeypatch):
    """The order and names of the query's own model; the sample drops URLs, never some rows of one."""
    monkeypatch.setitem(globals(), "ORDER", 5)
    rows = [(f"https://a.com/article/{k % 40}", True) for k in range(120)] + [(f"http://b.org/?ad={k}x", False) for k in range(90)]
    df = spark.createDataFrame(rows, "text string, accepted boolean")
    texts = ["https://a.com/article/99", "http://b.org/?ad=3x", "", "x" * 300]
    whole = urls.train(df)
    assert np.allclose(whole.score([t.encode() for t in texts]), [plain_score(rows, t) for t in texts])
    part = urls.train(df, most_urls=25)
    names = {r.text: r.h for r in df.select("text", urls._drawn("text").alias("h")).distinct().collect()}
    kept = [r for r in rows if names[r[0]] <= part.cuts[not r[1]]]
    assert len({t for t, ok in kept if ok}) == 25 == len({t for t, ok in kept if not ok})
    assert np.allclose(part.score([t.encode() for t in texts]), [plain_score(kept, t) for t in texts])
    ok = df.where("accepted").select("text").distinct().collect()
    got = {r.text: r.url_score for r in urls.score(df.where("accepted").distinct(), part, "text", ["text"], left_out=0).collect()}
    for r in ok:
        mine = list(kept)
        if (r.text, True) in mine:
            mine.remove((r.text, True))
        assert np.isclose(got[r.text], plain_score(mine, r.text))


def test_held_out_accuracy_does_not_need_every_url(spark):
    """Two kinds of URLs that no single word tells apart; held-out ones are judged by models of all and of a tenth."""
    import random

    r = random.Random(3)
    word = lambda kind: "".join(r.choice("aeiou") + r.choice("lmnrst" if kind else "bdgkpz") for _ in range(r.randint(2, 5)))
    rows = [(f"https://{word(k % 2)}.com/{word(k % 2)}/{r.randrange(999)}", k % 2 == 1) for k in range(3000)]
    for most in (10_000, 150):
        model = urls.train(spark.createDataFrame(rows[:2000], "text string, accepted boolean"), most_urls=most)
        got = model.score([t.encode() for t, _ in rows[2000:]]) >= 0
        assert np.mean(got == np.array([ok for _, ok in rows[2000:]])) > 0.97
