import math
import random

import numpy as np
from brute import components

from cropledger.llm import embeddings, queries


def plain(rows, threshold=0.93):
    """rows: (id, vector, label). {id: (links, component)}."""
    by = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            by.setdefault((label, len(v)), []).append((i, np.array(v, float)))
    links = []
    for group in by.values():
        x = np.array([v / np.linalg.norm(v) for _, v in group])
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1))):
            links.append((group[a][0], group[b][0]))
    n = {i: 0 for i, _, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    root = components(n, links)
    return {i: (n[i], root[i]) for i in n}


def found(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return {r.vec_id: (r.n_links, r.component_id) for r in rows}


def test_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert found(queries.op1_embeddings(spark, sf)) == plain(rows)


def test_many_tiles_copies_and_clusters(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 16)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(12, 40))
    rows = [(i, [float(x) for x in centre[i % 12] + rng.normal(size=40) * 0.25], i % 2) for i in range(240)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(30)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<double>, label int, cls string")
    assert found(embeddings.near_duplicates(df)) == plain(rows)


def test_edge_rows(spark):
    v = [1.0, 2.0, 0.5]
    rows = [
        (1, v, 1), (2, v, 1), (3, v, None), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 1.0], 1), (7, [float("nan"), 1.0, 1.0], 1),
        (8, [float("inf"), 1.0, 1.0], 1), (9, [], 1), (10, [2.0, 4.0, 1.0], 1), (11, v, 2), (12, [1.0, 2.0], 1), (13, [-1.0, -2.0, -0.5], 1),
        (14, [1e200, 2e200, 5e199], 1), (15, [-0.0, 1.0, 0.0], 3), (16, [0.0, 1.0, -0.0], 3),
    ]
    schema = "vec_id long, embedding array<double>, label int, v string, y int"
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], schema)
    expected = plain([r for r in rows if r[0] != 14])
    expected |= {1: (3, 1), 2: (3, 1), 10: (3, 1), 14: (3, 1)}
    assert found(embeddings.near_duplicates(df)) == expected
    assert embeddings.near_duplicates(df.limit(0)).collect() == []
    twice = embeddings.near_duplicates(df.where("vec_id = 1").unionAll(df.where("vec_id = 1")).unionAll(spark.createDataFrame([(None, v, 1, "c", 1)], schema)))
    assert sorted(map(str, map(tuple, twice.collect()))) == ["(1, 2, 1, True)", "(1, 2, 1, True)", "(None, 2, 1, False)"]


def test_one_label_of_many_tiles_and_high_dimensions(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 8)
    monkeypatch.setattr(embeddings, "BROADCAST_ROWS", 0)
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(40, 200))
    rows = [(i, [float(x) for x in np.float32(centre[i % 40] + rng.normal(size=200) * 0.27)], 7) for i in range(700)]
    rows += [(5000 + i, [float(x) for x in rng.normal(size=3)], 7) for i in range(60)] + [(6000, None, 7), (6001, rows[0][1], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = found(embeddings.near_duplicates(df))
    assert got == plain([(i, v and [float(np.float32(x)) for x in v], k) for i, v, k in rows])
    assert max(n for n, _ in got.values()) > 3


def test_hot_keys_are_joined_apart(spark, monkeypatch):
    from cropledger.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 3)
    rows = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 50}" if i % 3 == 1 else None) for i in range(6000)], "i int, k string")
    named = spark.createDataFrame([("hot", 1)] + [(f"k{j}", 2) for j in range(0, 50, 2)], "k string, v int")
    want = {(r.i, r.k, r.v) for r in rows.join(named, "k", "left").select("i", "k", "v").collect()}
    got = common.join_named(rows, named, "k")
    assert got.columns == ["i", "k", "v"] and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
