import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.operators import labels, quality
from tidemill.operators import news as nw


def frame(spark):
    r = random.Random(3)
    data = [(i, r.choice("aaaaaab"), r.choice("xyz")) for i in range(3000)] + [(5000 + i, None, "x") for i in range(17)] + [(6000, "c", "x"), (6001, "d", None), (6001, "d", None)]
    return spark.createDataFrame(data, "id long, s string, t string").repartition(6)


def ranked(x, *by):
    return x.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy(labels.seeded_order("id"), "id"))).withColumn("n", F.count("*").over(Window.partitionBy(*by)))


def test_samples_and_splits_are_those_of_the_window(spark):
    x = frame(spark)
    assert sorted(rows(labels.balanced_sample(x, 300, by="s", key="id")), key=str) == sorted(rows(ranked(x, "s").where("k <= 100").select("id", "s", "t")), key=str)
    place = (F.col("k") - 1) / F.col("n")
    want = ranked(x, "s", "t").withColumn("split", F.when(place < 0.7, "train").when(place < 0.7 + 0.15, "validation").otherwise("test")).select("id", "s", "t", "split")
    got = labels.stratified_split(x, ["s", "t"], "id")
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)
    for n in (1, 2, 3, 7, 20, 40, 100):
        y = x.where(F.col("id") < n)
        want = ranked(y.withColumn("u", F.lit(1)), "u").withColumn("split", F.when(place < 0.7, "train").when(place < 0.7 + 0.15, "validation").otherwise("test")).select("id", "split")
        assert sorted(rows(labels.stratified_split(y.withColumn("u", F.lit(1)), ["u"], "id").select("id", "split"))) == sorted(rows(want))
    assert labels.stratified_split(x.limit(0), ["s"], "id").count() == 0


def test_oversampling_fills_each_label_and_keeps_unknown_ones(spark):
    x = frame(spark)
    got = {r.s: (r.n, r.d) for r in labels.oversample(x, "s", 50, "id").groupBy("s").agg(F.count("*").alias("n"), F.count_distinct("id").alias("d")).collect()}
    counts = {r.s: r.n for r in x.groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert {s: n for s, (n, _) in got.items()} == {s: max(n, 50) for s, n in counts.items()} and got[None] == (50, 17)
    assert labels.add_external(x.limit(0), x, "s", 10, "id").count() == 10 + 10 + 10 + 1 + 2


def test_no_window_sorts_a_whole_stratum(spark):
    plan = labels.stratified_split(frame(spark), ["s"], "id")._jdf.queryExecution().executedPlan().toString()
    specs = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
    assert specs and all("_slot" in line.split("windowspecdefinition(")[1].split("_order")[0] for line in specs)


def test_layers_by_digests(spark):
    r = random.Random(4)
    a = spark.createDataFrame([(f"k{i}", i % 7) for i in range(4000)] + [("k1", 1), (None, 3)], "k string, d int")
    for b in (a, a.where("k <> 'k17'"), a.withColumn("k", F.when(F.col("k") == "k5", "z").otherwise(F.col("k"))), a.limit(0), a.where(F.rand(1) < 0.9)):
        b = b.repartition(r.randint(1, 5))
        for key in (["k", "d"], ["k"]):
            assert rows(quality.layer_differences(a, b, key), "side") == rows(quality.key_differences(a, b, key), "side")
    assert quality.differing_ranges(a, a.repartition(3), ["k"]) == []
    assert len(quality.differing_ranges(a, a.where("coalesce(k <> 'k17', true)"), ["k"])) == 1


@pytest.mark.parametrize(("most_sent", "hot"), [(20_000, 0.01), (0, 1.0), (3, 0.0), (5, 0.2)])
def test_aliases_by_automaton_and_by_rare_words(spark, most_sent, hot):
    r = random.Random(5)
    words = ["công", "ty", "ngân", "hàng", "việt", "nam", "hòa", "phát", "vietcombank", "abcdefghij", "x1", "thép", "sữa", "dầu"]
    names = [" ".join(r.choice(words) for _ in range(r.randint(2, 4))) for _ in range(60)] + ["vietcombank", "abcdefghijk", "(hòa) phát.", "... ---- x1", "-- !! ???", "hàng việt n"]
    names = sorted({n for n in names if len(n) >= 8})
    texts = [" ".join(r.choice([*words, "aphát", "vietcombanks", "namx", "zngân"]) for _ in range(r.randint(0, 30))) for _ in range(150)] + ["", None, "x(hòa) phát.y", "a ... ---- x12", "b-- !! ???", "hàng việt nam"]
    n = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "article_id long, _text string").repartition(4)
    a = spark.createDataFrame([(f"T{i % 9}", name, name) for i, name in enumerate(names)], "ticker string, alias string, folded string")
    want = sorted((i, f"T{k % 9}", name) for i, t in enumerate(texts) for k, name in enumerate(names) if t and name in t)
    got = nw.alias_matches(n, a, most_sent=most_sent, hot=hot) if most_sent else nw.alias_matches(n, a, most_sent=1, hot=hot)
    assert sorted(rows(got)) == want and len(want) > 50
    assert nw.alias_matches(n, a.limit(0)).count() == 0 and nw.alias_matches(n.limit(0), a, most_sent=3).count() == 0


def test_names_that_begin_alike_meet_their_own_articles_alone(spark):
    names = [f"công ty số{i} mở rộng" for i in range(5000)]
    n = spark.createDataFrame([(i, f"hôm nay công ty số{i * 25} mở rộng sản xuất") for i in range(200)], "article_id long, _text string")
    a = spark.createDataFrame([(f"T{i}", x, x) for i, x in enumerate(names)], "ticker string, alias string, folded string")
    got = nw.alias_matches(n, a, most_sent=100)
    assert sorted(r.ticker for r in got.collect()) == sorted(f"T{i * 25}" for i in range(200))


def test_word_model_is_naive_bayes(spark):
    import math
    from collections import Counter

    r = random.Random(6)
    data = [(i, " ".join(r.choice("abc" if lab == "positive" else "cde" if lab == "negative" else "xyz") for _ in range(r.randint(0, 9))), lab) for i in range(60) for lab in [r.choice(("positive", "negative", "neutral"))]]
    df = spark.createDataFrame([*data, (99, "q q q", None), (98, None, "neutral")], "id int, text string, label string")
    w = nw.word_weights(df)
    got = {x.id: x for x in nw.infer_by_words(df.unionByName(spark.createDataFrame([(100, "unseen", "")], "id int, text string, label string")), w, "m", key="id").collect()}
    train = [*((t, lab) for _, t, lab in data), ("", "neutral")]
    n: dict = {}
    for t, lab in train:
        n.setdefault(lab, Counter()).update(t.split())
    v = len({t for c in n.values() for t in c})
    texts = Counter(lab for _, lab in train)
    for i, t in [*((i, t) for i, t, _ in data), (99, "q q q"), (98, ""), (100, "unseen")]:
        s = {lab: math.log(texts[lab] / len(train)) + sum(math.log((n[lab][x] + 1) / (sum(n[lab].values()) + v)) for x in t.split() if any(x in c for c in n.values())) for lab in texts}
        top = max(s.values())
        p = {lab: math.exp(x - top) / sum(math.exp(y - top) for y in s.values()) for lab, x in s.items()}
        assert abs(got[i].sentiment_score - (p["positive"] - p["negative"])) < 1e-9 and abs(got[i].confidence_score - max(p.values())) < 1e-9
    right = sum(got[i].sentiment_label == lab for i, t, lab in data if t)
    assert right > 0.8 * sum(1 for _, t, _ in data if t)


@pytest.mark.parametrize("most_keys", [4_000_000, 0])
def test_names_of_frequent_words_keep_few_rows_by_their_pairs(spark, monkeypatch, most_keys):
    r = random.Random(7)
    words = [f"w{chr(97 + i)}ort" for i in range(24)]
    names = sorted({" ".join(r.choice(words) for _ in range(3)) for _ in range(60)})
    texts = [" ".join(r.choice(words) for _ in range(40)) for _ in range(200)] + ["x" + n + "y" for n in names[:20]]
    n = spark.createDataFrame(list(enumerate(texts)), "article_id long, _text string")
    a = spark.createDataFrame([("T", x, x) for x in names], "ticker string, alias string, folded string")
    kept, real = [], nw.materialize
    monkeypatch.setattr(nw, "materialize", lambda df, name: (x := real(df, name), kept.append(x.count()))[0])
    more = {"most_keys": most_keys} if "most_keys" in nw.alias_matches.__code__.co_varnames else {}
    got = sorted((x.article_id, x.alias) for x in nw.alias_matches(n, a, most_sent=3, hot=1.0, **more).collect())
    assert got == sorted((i, x) for i, t in enumerate(texts) for x in names if x in t) and len(got) > 20
    assert max(kept) < 2500  # by single words each of 200 articles would keep some 20
