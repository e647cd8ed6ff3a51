import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows

from tidemill.operators import names as nm
from tidemill.operators import news as nw


@pytest.fixture
def held(spark):
    r = random.Random(3)
    letters = ["a", "b", "ê", "ệ", " ", ".", "\0", "😀"]
    word = lambda least, most: "".join(r.choice(letters) for _ in range(r.randint(least, most)))
    names = sorted({word(1, 4) for _ in range(20)} | {word(5, 30) for _ in range(40)} | {"ba na ba na ba na", "ba na ba na", "gone forever and ever"})
    texts = [" ".join(r.choice([*names[:-1], word(0, 40)]) for _ in range(r.randint(0, 6))) for _ in range(120)] + [None, "", "gone forever", " and ever", "ba na ba na ba na ba na", "x", "x"]
    ids = [*range(len(texts) - 1), len(texts) - 2]  # the last two rows have one id
    n = spark.createDataFrame(list(zip(ids, texts, strict=True)), "article_id long, _text string").repartition(3)
    a = spark.createDataFrame([(f"T{k % 7}", x, x) for k, x in enumerate(names)], "ticker string, alias string, folded string")
    return n, a, sorted((i, f"T{k % 7}", x) for i, t in zip(ids, texts, strict=True) for k, x in enumerate(names) if t and x in t)


@pytest.mark.parametrize(("most_sent", "hot", "most_names"), [(2, 1e9, 500_000), (5, 0.0, 25), (1, 0.1, 500_000)])
def test_odd_names_are_found_once_in_each_row_that_holds_them(spark, held, most_sent, hot, most_names):
    n, a, want = held
    got = sorted(rows(nw.alias_matches(n, a, most_sent=most_sent, hot=hot, most_names=most_names)))
    assert got == want and len(want) > 300


def test_no_article_or_key_of_one_is_written_or_shuffled(spark, held, monkeypatch):
    n, a, want = held
    kept, real = [], nw.materialize
    monkeypatch.setattr(nw, "materialize", lambda df, name: (x := real(df, name), kept.append(x))[0])
    got = nw.alias_matches(n.coalesce(1), a, most_sent=2, hot=1.0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "RoundRobin" in plan and "Join" not in plan  # the frame's own repartition
    assert all("article_id" not in x.columns and "_g" not in x.columns for x in kept)
    assert sorted(rows(got)) == want


def test_a_name_is_keyed_by_its_rarest_window_and_large_parts_are_cut(monkeypatch):
    monkeypatch.setattr(nm, "_CHUNK", 50)
    texts = pa.array(["công ty số1 mở rộng sản xuất", "công ty số2 mở rộng", None, "công ty số3"] * 30)
    names = nm.Names(pa.array([f"công ty số{i} mở rộng" for i in range(40)]))
    held = nm.Counter(names)(iter([texts.slice(0, 50), texts.slice(50)]))
    at, least = names.rarest(held)
    assert np.flatnonzero(least).tolist() == [1, 2] and least[[1, 2]].tolist() == [30, 30]
    found = [(r.tolist(), n.tolist()) for r, n in nm.Finder(names, at[[1, 2]])(iter([texts.slice(2, 5), texts.slice(0, 0)]))]
    assert found == [([2, 3], [1, 2]), ([], [])]
