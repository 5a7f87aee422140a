import math

import numpy as np
from pyspark.sql import functions as F

from cropledger.llm import nearest, queries


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b))


def fine(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def plain(rows, k, asks):
    """{query: [(vec_id, score)]}: every candidate compared with every query."""
    rows = [(i, v) for i, v in rows if fine(v)]
    asked = {}
    for i, v in rows:
        if i is not None and asks(i):
            asked[i] = min(asked.get(i, v), v)
    found = {}
    for q, v in asked.items():
        near = sorted(((-cosine(v, w), i is None, i) for i, w in rows if i != q and len(w) == len(v)), key=lambda x: (round(x[0], 12), x[1], x[2] or 0))[:k]
        if near:
            found[q] = [(i, -s) for s, _, i in near]
    return found


def results(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def test_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = plain(rows, 5, lambda i: i % 50 == 0)
    got = results(queries.op13_nearest(spark, sf))
    assert got.keys() == want.keys() and all(len(x) == 5 for x in got.values())
    true = {(q, i) for q, near in want.items() for i, _ in near}
    assert len(true & {(q, i) for q, near in got.items() for i, _ in near}) >= 0.9 * len(true)
    by_id = dict(rows)
    assert all(abs(s - cosine(by_id[q], by_id[i])) < 1e-12 for q, near in got.items() for i, s in near)


def test_factor_one_is_exact_and_prunes(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD", 500)  # tasks get it with the function
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 6))
    rows = [(i, (centres[i % 40] + rng.normal(size=6) * 0.05).tolist()) for i in range(2000)]
    got = results(nearest.nearest(frame(spark, rows).repartition(3), F.col("vec_id") % 50 == 0, 7, factor=1.0))
    same(got, plain(rows, 7, lambda i: i % 50 == 0))
    points = nearest._unit([v for _, v in rows])
    order, nodes = nearest.build_tree(points)
    asked = points[::50]
    seen = {f: nearest.search_tree(points[order], nodes, asked, 5, f, np.ones(2000, int), np.full(40, -1), np.full(40, -np.inf))[2] for f in (1.0, 0.3)}
    assert seen[0.3] < seen[1.0] < 40 * 2000 / 4  # near clusters, a quarter of the points is not needed, and less with a smaller factor


def test_small_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(nearest, "QUERIES", 7)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(200)]
    same(results(nearest.nearest(frame(spark, rows), F.col("vec_id") % 10 == 0, 3, factor=1.0)), plain(rows, 3, lambda i: i % 10 == 0))


def test_long_vectors_make_smaller_shards(spark, monkeypatch):
    monkeypatch.setattr(nearest, "VALUES", 2000)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=(3, 40, 900)[i % 3]).tolist()) for i in range(150)]
    df = frame(spark, rows, "float").coalesce(1)
    rows = [(i, np.float32(v).astype(float).tolist()) for i, v in rows]
    same(results(nearest.nearest(df, F.col("vec_id") % 10 == 0, 4, factor=1.0)), plain(rows, 4, lambda i: i % 10 == 0))
    sizes = {}
    for r in nearest.build(df, 4).collect():
        sizes.setdefault(r.d, []).append(r.n)
    assert all(d * max(n) <= 2000 and sum(n) == 50 for d, n in sizes.items()) and len(sizes[900]) == 25


def test_ties_repeats_and_bad_vectors(spark):
    inf = float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100, [0.0, 1.0]), (7, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, 2.0])]
    rows += [(150, None), (151, []), (152, [0.0, 0.0]), (153, [None, 1.0]), (154, [inf, 1.0]), (155, [float("nan"), 1.0]), (200, [1.0]), (250, [1.0, 2.0, 3.0]), (251, [1.0, 2.0, 3.0]), (300, [0.0, 1.0]), (300, [-1.0, 0.0])]
    want = plain(rows, 5, lambda i: i % 50 == 0)
    assert [i for i, _ in want[0]] == [1, 2, 3, 4, 5] and want[250] == [(251, 1.0)] and 200 not in want
    same(results(nearest.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, 5, factor=1.0)), want)


def test_all_equal_and_empty(spark):
    rows = [(i, [0.5, 0.5, -0.0]) for i in range(300)]
    got = results(nearest.nearest(frame(spark, rows, "float"), F.col("vec_id") % 50 == 0, 5))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[250]] == [0, 1, 2, 3, 4]
    none = nearest.nearest(frame(spark, rows).limit(0), F.col("vec_id") % 50 == 0)
    assert none.collect() == [] and none.columns == ["query_id", "rank", "vec_id", "score"]


def test_clashing_columns(spark):
    rows = frame(spark, [(i, [1.0, float(i)]) for i in range(60)]).withColumns({"v": F.lit("x"), "rank": F.lit(1), "score": F.lit(None), "query_id": F.lit("q"), "a.b": F.lit(0)})
    assert len(results(nearest.nearest(rows, F.col("vec_id") % 50 == 0))[50]) == 5
