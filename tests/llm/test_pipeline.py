"""The pipeline's stages on a small table, each against what its operator promises."""

import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from test_operators import brute_components, corpus, shingle_set

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, tmp_path):
    c = [(d, t) for d, t, _ in corpus()]
    df = spark.createDataFrame([(d, t, "en", f"s{d % 4}", len(t or "")) for d, t in c], "doc_id long, text string, lang string, source string, n_chars long")
    base = str(tmp_path / "sf")
    df.write.parquet(f"{base}/documents.parquet")
    at, seen = spark.read.parquet(f"{base}/documents.parquet"), []
    # Columns that clash with what the stages add: they go, and change nothing.
    clashes = {n: F.lit("x") for n in ("kept", "cleaned", "n_words", "n_removed", "component_id", "component_label", "size", "taken", "key", "piece", "_copy")}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at.withColumns(clashes) if k < 4 else at, base).write.parquet(f"{base}/{k}")
        at = spark.read.parquet(f"{base}/{k}")
        seen.append(at)
        if k < 4:
            assert at.columns == df.columns
    words = {d: WORD.findall(t or "") for d, t in c}
    kept = {r.doc_id for r in seen[0].collect()}
    assert kept <= {d for d, w in words.items() if len(w) >= 50} and len(kept) >= 25
    group = brute_components({d: shingle_set(t) for d, t in c if d in kept})
    one = {r.doc_id: r.text for r in seen[1].collect()}
    assert set(one) == {d for d in kept if group[d] == d}
    cut = {r.doc_id: r for r in seen[2].collect()}
    first: dict = {}
    for d in sorted(one):
        w = WORD.findall(one[d])
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), d)
    for d, r in cut.items():
        w = WORD.findall(one[d])
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                gone[i : i + 50] = [True] * 50
        assert r.text == (" ".join(x for x, g in zip(w, gone, strict=True) if not g) if any(gone) else one[d]) and r.n_chars == len(r.text)
    copies = Counter(r.doc_id for r in seen[3].collect())
    assert max(copies.values()) <= 3 and set(copies) <= set(cut)
    pieces = seen[4].groupBy("doc_id").agg(F.sum(F.when(F.col("piece") == 0, 1).otherwise(0)).alias("n")).collect()
    assert {r.doc_id: r.n for r in pieces} == copies
    assert corpus_pipeline.run(spark, base).count() == seen[4].count()


def test_stages_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
