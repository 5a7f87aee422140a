import random

import numpy as np

from brute import near_duplicates as plain

from cropledger.llm import minhash, queries

SCHEMA = "doc_id long, text string, cls string, root string, path string"


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_matches_brute_force_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op5_minhash(spark, sf)
    assert found(out) == plain(docs, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_crowded_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.sample("abcdefgh", 1)[0] + w if rng.random() < 0.04 else w for w in base)) for i in range(120)]
    docs += [(200 + i, " ".join(rng.choice(["xx", "yy", "zz"]) for _ in range(30))) for i in range(40)]
    df = spark.createDataFrame([(*d, "c", "r", "p") for d in docs], SCHEMA)
    assert found(minhash.near_duplicates(df, width=2)) == plain(docs, 2)


def test_blocks_keep_every_component(spark, monkeypatch):
    monkeypatch.setattr(minhash, "REGION", 4)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(5)
    stock = [f"s{i}" for i in range(70)]
    docs = [(i, " ".join(stock + [f"d{i // 3}-{k}" if rng.random() < 0.97 else f"o{i}-{k}" for k in range(22)])) for i in range(60)]
    df = spark.createDataFrame([(*d, None, None, None) for d in docs], SCHEMA)
    assert found(minhash.near_duplicates(df, width=2)) == plain(docs, 2)


def test_edge_rows(spark):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a b"), (7, "A\tB"), (None, "a b"), (8, "x y z"), (8, "x y z"), (9, "w " * 30000)]
    out = minhash.near_duplicates(spark.createDataFrame([(*d, None, "r", "p") for d in docs], SCHEMA), width=5)
    rows = sorted((tuple(r) for r in out.collect()), key=str)
    assert rows == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 1, 6, False), (None, 1, 6, False), (8, 1, 8, True), (8, 1, 8, True), (9, 1, 9, True)], key=str)
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_crowds_are_as_sure_as_small_regions(spark, monkeypatch):
    """Pairs at the threshold that share four hashes, but no six of the first 20 trees."""
    monkeypatch.setattr(minhash, "REGION", 2)
    monkeypatch.setattr(minhash, "CROWD", 4)
    stock = " ".join(f"s{i}" for i in range(70))

    def path(text):
        sig = minhash._signature(minhash.shingle_set(text.encode(), 2))
        return [sig[24 * t : 24 * t + 24] for t in range(minhash.TREES)]

    texts, tried = [], 0
    while len(texts) < 12:
        tried += 1
        tail = [f"t{tried}-{k}" for k in range(12)]
        a, b = (" ".join([stock, *tail, *(f"{side}{tried}-{k}" for k in range(10))]) for side in "ab")
        deep = max(next((d for d in range(6) if p[4 * d : 4 * d + 4] != q[4 * d : 4 * d + 4]), 6) for p, q in zip(path(a), path(b)))
        if deep in (4, 5):
            texts += [a, b]
    docs = list(enumerate(texts + [" ".join([stock, *(f"o{i}-{k}" for k in range(22))]) for i in range(200)]))
    df = spark.createDataFrame([(*d, None, None, None) for d in docs], SCHEMA)
    assert found(minhash.near_duplicates(df, width=2)) == plain(docs, 2)


def test_neighbours_across_tasks(spark):
    """One region holds most rows and spreads over tasks; neighbours are those of one sorted list."""
    rng = random.Random(11)
    hot = bytes(16)
    rows = {(rng.randrange(2), (hot if rng.random() < 0.7 else rng.randbytes(2) * 8) + bytes([rng.randrange(3)]) * 8, rng.randbytes(4)) for _ in range(3000)}
    rows |= {(5, bytes([9]) * 24, b"alone"), (6, bytes([9]) * 24, b"x"), (6, bytes([9]) * 24, b"y")}
    line, want = sorted(rows), set()
    for before, at, after in zip([None, *line], line, [*line[1:], None]):
        near = [x[2] if x and (x[0], x[1][:16]) == (at[0], at[1][:16]) else None for x in (before, after)]
        if any(near):
            want.add((*at, *near))
    forest = spark.createDataFrame(sorted(rows), "tree int, path binary, cls binary")
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        for many in ("false", "true"):
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", many)
            got = [(r.tree, *(None if x is None else bytes(x) for x in (r.path, r.cls, r.before, r.after))) for r in minhash._in_order(forest).collect()]
            assert len(got) == len(want) and set(got) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    assert minhash._in_order(forest.limit(0)).collect() == []


def test_candidates_of_a_block(spark):
    """Sets that share a template below the threshold are hardly ever paired; every pair at the threshold is, and near copies too."""
    rng = np.random.default_rng(12)
    template = rng.integers(0, 2**60, 140)
    sets = [np.unique(np.concatenate((template, rng.integers(0, 2**60, 60)))) for _ in range(200)]
    near = [np.unique(np.concatenate((s[:-15], rng.integers(0, 2**60, 4)))) for s in sets[:20]]
    copies = [np.unique(np.concatenate((sets[0][i:], rng.integers(0, 2**60, i)))) for i in range(60)]
    for group, most in ((sets + near, 400), (sets[:5] + copies, 10**6)):
        group = sorted(group, key=len)
        pairs = list(minhash._candidates(group, 80))
        assert len(pairs) == len(set(pairs)) <= most
        close = {(p, q) for q in range(len(group)) for p in range(q) if 100 * (n := len(np.intersect1d(group[p], group[q]))) >= 80 * (len(group[p]) + len(group[q]) - n)}
        assert close and close <= set(pairs)
