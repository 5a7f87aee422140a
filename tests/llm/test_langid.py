import zlib

import numpy as np

from cropledger.llm import langid, queries


def test_held_out_accuracy_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op7_langid(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_marginals_match_enumeration():
    import itertools

    rng = np.random.default_rng(2)
    e, trans, first = rng.normal(size=(4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    total, by, pair = 0.0, np.zeros((4, 3)), np.zeros((3, 3))
    for path in itertools.product(range(3), repeat=4):
        w = np.exp(first[path[0]] + sum(e[t, y] for t, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        total += w
        for t, y in enumerate(path):
            by[t, y] += w
        for a, b in zip(path, path[1:]):
            pair[a, b] += w
    marginal, pairs = langid._forward_backward(e, np.array([0]), np.array([4]), trans, first)
    assert np.allclose(marginal, by / total) and np.allclose(pairs, pair / total)


def test_code_switched_words():
    text = {"en": "the house of the winter and the harvest in a small town", "de": "der winter und die ernte von einem kleinen dorf nicht weit"}
    model = langid.fit([(t, k) for k, t in text.items() for _ in range(30)])
    words = "the winter of the harvest und die ernte von einem kleinen dorf".split()
    m = langid.label_texts(model, [words], {}, [np.zeros((0, 2))])[0]
    best = [model["languages"][i] for i in m.argmax(1)]
    assert best[:5] == ["en"] * 5 and best[5:] == ["de"] * 7


def test_edge_rows(spark):
    rows = [(1, None, "en", 0.0), (2, "", "en", 0.0), (3, "123 ...½", "de", 0.0), (4, "the cat", None, 0.0), (None, "le chat", "fr", 0.0), (5, "a " * 40000, "en", 0.0), (6, "der hund", "de", 0.0), (6, "der hund", "de", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    out = langid.identify(df).collect()
    assert len(out) == 8 and [r.lang_pred for r in sorted(out, key=lambda r: r.doc_id or 99)][:3] == ["und"] * 3
    assert langid.identify(df.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.identify(df.where("lang is null")).collect()} == {"und"}


def test_rare_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 200)
    monkeypatch.setattr(langid, "RUNS", 400)
    en, xx = "the house of the winter and the harvest in a small town".split(), "qvox zuntu qvarre zelto quxim zoq velqu zanti".split()
    rows = [(i, " ".join(en[(i + j) % len(en)] for j in range(9)), "en") for i in range(3000)] + [(5000 + i, " ".join(xx[(i + j) % len(xx)] for j in range(9)), "xx") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    runs = langid.training_runs(df).groupBy("lang").count().collect()
    assert {r.lang: 12 <= r["count"] <= 600 for r in runs} == {"en": True, "xx": True}
    out = langid.identify(df).collect()
    assert all(r.lang_pred == ("en" if r.doc_id < 5000 else "xx") for r in out)


def test_late_words_of_long_texts_are_learned(spark):
    early, late = "der winter und die ernte " * 400, "qvox zuntu qvarre zelto " * 400
    df = spark.createDataFrame([(i, early + late if k == "de" else "the house of the town " * 300, k) for i in range(30) for k in (["de", "en"][i % 2],)], "doc_id long, text string, lang string")
    assert any("qvox" in r.text for r in langid.training_runs(df).collect())
    extra = df.where("false").union(spark.createDataFrame([(900, "qvox zelto zuntu", None)], df.schema))
    assert [r.lang_pred for r in langid.identify(df.union(extra)).where("doc_id = 900").collect()] == ["de"]
