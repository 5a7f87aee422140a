import zlib

import numpy as np

from cropledger.llm import quality, queries


def test_held_out_accuracy_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op8_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    for label in (0, 1):
        own = [r for r in held if r.quality == label]
        assert np.mean([r.predicted == label for r in own]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 0), (3, "x" * 100000, 1), (None, "A text.", 1), (3, "again", 0)], "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 7), (None, 1)], "doc_id long, quality int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(docs.limit(0), labels).collect() == []
    assert len(quality.classify(docs, labels.limit(0)).collect()) == 5


def test_same_sums_as_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, len(quality.FEATURES)))
    y = (x[:, 0] + 0.1 * rng.normal(size=60) > 0).astype(int)
    model = quality.fit(spark.createDataFrame([(list(map(float, v)), int(c)) for v, c in zip(x, y)], "x array<double>, label int"))
    assert np.allclose(model["mean"][1], x[y == 1].mean(0))
    s = quality.score_array(model, x)
    assert ((s > 0.5) == (y == 1)).mean() > 0.9


def test_scores_are_those_of_the_two_normal_densities(spark):
    """Sums, shrinkage and scores against densities written out with inverses and determinants."""
    rng = np.random.default_rng(4)
    d = len(quality.FEATURES)
    y = np.arange(200) % 3 % 2
    x = rng.normal(size=(200, d)) @ rng.normal(size=(d, d)) + y[:, None] * 0.5
    model = quality.fit(spark.createDataFrame([(list(map(float, v)), int(c)) for v, c in zip(x, y)], "x array<double>, label int"))
    scatter = [np.cov(x[y == c].T, bias=True) * (y == c).sum() for c in (0, 1)]
    pooled = sum(scatter) / len(y)
    log = []
    for c in (0, 1):
        cov = (1 - quality.POOLED) * scatter[c] / (y == c).sum() + quality.POOLED * pooled + quality.RIDGE * np.diag(np.diag(pooled))
        gap = x - x[y == c].mean(0)
        log.append(-0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap) - 0.5 * np.log(np.linalg.det(cov)))
    odds = np.exp(log[1] - log[0]) * ((y == 1).sum() + 1) / ((y == 0).sum() + 1)
    assert np.allclose(quality.score_array(model, x), odds / (1 + odds), atol=1e-9)


def test_query_scores_by_brute_force(spark):
    """op8's rows from Python statistics, numpy covariances and direct densities."""
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    known = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 5]
    stats = {i: np.array(quality.statistics(t)) for i, t in docs.items()}
    log, pooled = [], sum(np.cov(np.array([stats[i] for i, q in known if q == c]).T, bias=True) * sum(q == c for _, q in known) for c in (0, 1)) / len(known)
    for c in (0, 1):
        own = np.array([stats[i] for i, q in known if q == c])
        cov = (1 - quality.POOLED) * np.cov(own.T, bias=True) + quality.POOLED * pooled + quality.RIDGE * np.diag(np.maximum(np.diag(pooled), 1e-6))
        gap = np.array([stats[i] for i in docs]) - own.mean(0)
        log.append(-0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap) - 0.5 * np.linalg.slogdet(cov)[1] + np.log(len(own) + 1))
    want = dict(zip(docs, 1 / (1 + np.exp(-np.clip(log[1] - log[0], -60, 60)))))
    for r in queries.op8_quality(spark, sf).collect():
        assert abs(r.score - want[r.doc_id]) < 1e-6 and r.predicted == int(r.score >= 0.3)
