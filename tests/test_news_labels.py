import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemill.operators import labels, marts
from tidemill.operators import news as nw
from tidemill.plans.text import length_scorer

D = dt.date


def test_aliases_and_links(spark):
    p = spark.createDataFrame([("VCB", "Ngân hàng TMCP Ngoại thương Việt Nam", "Vietcombank"), ("FPT", "Công ty cổ phần FPT", "none"), ("HPG", "Tập đoàn Hòa Phát", "Hoa Phat Group")], "ticker string, company_name string, company_name_en string")
    a = nw.alias_dictionary(p)
    have = {(r.ticker, r.alias) for r in a.collect()}
    assert ("VCB", "Vietcombank") in have and ("VCB", "Ngoại thương Việt Nam") in have and ("FPT", "FPT") in have and ("HPG", "Hòa Phát") in have and ("FPT", "none") not in have
    n = spark.createDataFrame([("1", "VCB lãi lớn", "", "nội dung", ["x"]), ("2", "Tin khác", "", "Cổ phiếu FPT tăng; VIETCOMBANKS nói", []), ("3", "Không có gì", None, None, None), ("4", "t", "", "b", ["hpg "])], "article_id string, title string, description string, content string, tags array<string>")
    got = rows(nw.link_entities(n, a), "article_id", "ticker")
    assert got == [("1", "VCB", "VCB", "ticker_title_regex", 3), ("2", "FPT", "FPT", "ticker_context_regex", 2), ("2", "VCB", "Vietcombank", "company_alias_regex", 2), ("4", "HPG", "HPG", "tag_exact", 3)]


@pytest.mark.parametrize("text,score,label", [("Lợi nhuận tăng mạnh", 1.0, "positive"), ("Thua lỗ, giảm", -1.0, "negative"), ("", 0.0, "neutral"), (None, 0.0, "neutral"), ("tăng rồi giảm", 0.0, "neutral")])
def test_lexicon(spark, text, score, label):
    t = F.lit(text).cast("string")
    got = spark.range(1).select(nw.lexicon_score(t), nw.score_label(nw.lexicon_score(t))).first()
    assert (got[0], got[1]) == (score, label)


def test_fallback_counts_occurrences(spark):
    got = spark.range(1).select(nw.keyword_fallback(F.lit("giảm giảm tăng"))).first()[0]
    assert tuple(got) == ("negative", -0.5, 0.3)
    assert spark.range(1).select(nw.keyword_fallback(F.lit("x"))).first()[0].sentiment_label == "neutral"


def test_windows_and_inference(spark):
    long = " ".join(["wordword"] * 500)
    n = spark.createDataFrame([("a", long), ("b", "it is"), ("c", None)], "article_id string, text string")
    w = rows(nw.text_windows(n).select("article_id", "window", "window_words"), "article_id", "window")
    assert w == [("a", 0, 254), ("a", 1, 254), ("a", 2, 52), ("b", 0, 2), ("c", 0, 0)]
    got = rows(nw.infer(n, length_scorer, "v").select("article_id", "sentiment_label", F.round("sentiment_score", 2)), "article_id")
    assert got == [("a", "positive", 1.0), ("b", "negative", -0.5), ("c", "negative", -0.5)]


def test_daily_sentiment_and_gate(spark):
    d = spark.createDataFrame([("1", "A", D(2024, 1, 1), "s", "one", 2, "positive", 1.0, "v"), ("2", "A", D(2024, 1, 1), "t", "two", 3, "negative", -0.5, "v"), ("2", "A", D(2024, 1, 1), "t", "two", 3, "negative", -0.5, "v"), ("3", "A", None, "t", "x", 3, "neutral", 0.0, "v")], "article_id string, ticker string, published_at date, source string, title string, match_score int, sentiment_label string, sentiment_score double, model_version string")
    assert rows(nw.sentiment_daily(d)) == [("A", D(2024, 1, 1), 2, 2, 1, 1, 0, 0.25, "two", 20240101)]
    nw.publishable(d)
    for wrong in (d.limit(0), d.withColumn("model_version", F.lit("fallback"))):
        with pytest.raises(ValueError, match="not published"):
            nw.publishable(wrong)


def test_url_registry_life(spark):
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    S = "url string, source string, category string, status string, at timestamp"
    state = spark.createDataFrame([], "url string, source string, category string, status string, attempt_count long, first_seen_at timestamp, last_seen_at timestamp, last_attempt_at timestamp")
    one = nw.update_registry(state, spark.createDataFrame([("a", "s", "c", "discovered", t(1)), ("b", "s", "c", "discovered", t(1)), ("b", "s", "c", "failed", t(2)), ("d", "s", "c", "skipped", t(2))], S))
    two = nw.update_registry(one, spark.createDataFrame([("b", "s", "c", "failed", t(3)), ("a", "s", "c", "success", t(3))], S))
    assert rows(two.select("url", "status", "attempt_count"), "url") == [("a", "success", 1), ("b", "failed", 2), ("d", "skipped", 1)]
    due = lambda now, **k: [r[0] for r in rows(nw.to_crawl(two, F.lit(now), **k).select("url"), "url")]
    assert due(t(3, 29)) == [] and due(t(3, 30)) == ["b"] and due(t(4), most=2) == [] and due(t(4), again_skipped=True) == ["b", "d"]
    seeds = spark.createDataFrame([("a", "s"), ("z", "s")], "url string, source string")
    assert nw.seeded(two, seeds).count() == 4


def test_pages(spark):
    html = '<html><nav><p>menu</p></nav><h1> A &amp; B </h1><h2>lead</h2><p>one <b>bold</b></p><script>var p="<p>x</p>"</script><p>two</p><a class="tag" href="/t?x">tag1</a><a href="/video/1">v</a></html>'
    p = spark.createDataFrame([(1, "http://e/a", html), (2, "http://e/longform/b", html), (3, "http://e/c", None)], "page_id long, url string, html string")
    assert rows(nw.parse_pages(p)) == [(1, "http://e/a", "A & B", "lead", "one bold\ntwo", ["tag1"])]
    odd = spark.createDataFrame([(4, "http://e/d", "<h1>  </h1><h1> x&amp;&amp <b>y</b>\n&quot;z&#33; &amp;lt; a & b</h1>")], p.schema)
    assert rows(nw.parse_pages(odd, spelled=True).select("title", "title_spelled")) == [('x&& y "z! &lt; a & b', "x&amp;&amp y &quot;z&#33; &amp;lt; a & b")]
    assert rows(nw.page_links(p.where("page_id = 1"), "^/")) == [(1, "/t")]


def test_splits_samples_and_routes(spark):
    x = spark.range(200).select("id", (F.col("id") % 2).alias("l"))
    s = labels.stratified_split(x, ["l"], "id")
    assert rows(s.groupBy("l", "split").count(), "l", "split") == [(k, n, c) for k in (0, 1) for n, c in (("test", 15), ("train", 70), ("validation", 15))]
    assert rows(s, "id") == rows(labels.stratified_split(x.repartition(3), ["l"], "id"), "id")
    rare = x.where("l = 0").limit(7).unionByName(x.where("l = 1"))
    assert rows(labels.oversample(rare, "l", 20, "id").groupBy("l").count(), "l") == [(0, 20), (1, 100)]
    assert labels.balanced_sample(x.withColumn("source", F.col("l").cast("string")), 30, key="id").count() == 20


def test_record_validation_and_topics(spark):
    r = spark.createDataFrame([("positive", 0.9, ["M&A"], {"M&A": 0.9, "Khác": 0.1}), ("great", 1.5, ["x"], {"y": 2.0}), ("neutral", None, ["Khác"], {"Khác": 0.5})], "label string, confidence double, topics array<string>, topic_distribution map<string,double>")
    assert [x.errors for x in labels.record_errors(r).collect()] == [[], ["label", "confidence", "topics", "distribution_keys", "distribution_range", "distribution_sum"], ["confidence", "distribution_sum"]]
    got = r.select(labels.topics_of("topic_distribution")).collect()
    assert [x[0] for x in got] == [["M&A"], ["y"], ["Khác"]]
    assert spark.range(1).select(labels.canonical_label(F.lit(" Mixed "))).first()[0] == "neutral"


def test_metrics(spark):
    x = spark.createDataFrame([("a", "a")] * 8 + [("a", "b")] * 2 + [("b", "b")] * 9 + [("b", "a")], "t string, g string")
    m = labels.confusion(x, "t", "g")
    got = labels.overall_metrics(m).first()
    assert got.accuracy == 0.85 and got.passed and got.macro_f1 == pytest.approx((16 / 19 + 18 / 21) / 2)
    assert rows(labels.class_weights(x.limit(15), "t").select("t", "weight"), "t")[0][0] == "a"
    shares = rows(labels.label_shares(x, "t").select("t", "n", "share", "too_rare", "too_common"), "t")
    assert shares == [("a", 10, 0.5, False, False), ("b", 10, 0.5, False, False)]


def test_lexicon_file_and_external(spark, tmp_path):
    f = tmp_path / "lex.txt"
    f.write_text("# comment\na\t1\t0.5\t0.1\tTốt\tg\nb\t2\tbad\t0\tx\ty\nshort\tline\n")
    assert rows(labels.read_lexicon(spark, str(f))) == [("tốt", 0.4)]
    base = spark.createDataFrame([(1, "p")], "id long, label string")
    ext = spark.range(10, 30).select("id", F.lit("p").alias("label"), F.lit("e").alias("origin"))
    assert labels.add_external(base, ext, "label", 5, "id").count() == 6


def test_alert_history_falls_back(spark):
    e = spark.createDataFrame([("u", "A", "P", "m"), ("u", "B", "P", "m"), ("u", "A", "Q", "m")], "user_id string, ticker string, condition_type string, channel string")
    r = spark.createDataFrame([("u", "A", "P", "m", 5), ("u", "ALL", "P", "m", 60)], "user_id string, ticker string, condition_type string, channel string, cooldown_minutes int")
    assert rows(marts.alert_history(e, r).select("ticker", "condition_type", "cooldown_minutes"), "condition_type", "ticker") == [("A", "P", 5), ("B", "P", 60), ("A", "Q", 0)]


def test_word_model_shuffles_only_rare_words(spark):
    r = __import__("random").Random(3)
    texts = [(i, " ".join(r.choice([f"w{k}" for k in range(30)] + [f"rare{i}"]) for _ in range(r.randint(0, 40))), r.choice("abc")) for i in range(60)]
    df = spark.createDataFrame([*texts, (99, None, None)], "id int, text string, label string")
    w = nw.word_weights(df).cache()
    judged = lambda **k: [(x[0], x[1], round(x[2], 9)) for x in rows(nw.infer_by_words(df, w, "m", key="id", **k).select("id", "sentiment_label", "confidence_score"), "id")]
    want = judged()
    assert len(want) == 61 and all(judged(most_sent=n) == want for n in (0, 7, 30))
