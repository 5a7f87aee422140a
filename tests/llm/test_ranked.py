import math
import re
from collections import Counter

import duckdb
import numpy as np
from brute import SMALL
from pyspark.sql import functions as F

from cropledger.llm import queries, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def plain(docs, items, k):
    """{item: [(score, doc_id)]}: every document scored for every item."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    found = {}
    for i, ts in asked.items():
        rows = []
        for d, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if score > 0:
                rows.append((-score, d is not None, d or 0, d))
        if rows:
            found[i] = [(-r[0], r[3]) for r in sorted(rows, key=lambda r: r[:3])[:k]]
    return found


def results(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (str(r.item_id), r["rank"])):
        found.setdefault(r.item_id, []).append((r.score, r.doc_id))
        assert r["rank"] == len(found[r.item_id])
    return found


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_same_rows_as_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = sorted(con.execute(ranked.SQL).fetchall())
    assert sorted(tuple(r) for r in queries.op11_ranked(spark, sf).collect()) == want and len(want) > 1000


def test_small_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked, "POSTINGS", 300)  # tasks get it with the function
    monkeypatch.setattr(ranked, "PAIRS", 40)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(words[min(59, int(x))] for x in rng.exponential(9, n))
    docs = [(i, text(int(rng.integers(1, 80)))) for i in range(700)]
    items = [(i, text(12)) for i in range(25)]
    assert results(ranked.search(*frames(spark, docs, items), k=5)) == plain(docs, items, 5)


def test_stops_early():
    """A few documents hold the rare words: what the best positions allow is soon below them."""
    rng = np.random.default_rng(1)
    n = 20_000
    doc, term = np.tile(np.arange(n), 3), np.repeat(np.arange(3), n)
    impact = np.concatenate([rng.permutation(n) + 1, rng.permutation(n) + 1, rng.permutation(n) + 1])
    impact[[5, n + 5, 2 * n + 5]] = 10 * n
    shard = ranked.Shard(doc, term, impact, n, 3)
    found, scores, scored = shard.best(np.arange(3), 1, 0)
    assert found.tolist() == [5] and scores.tolist() == [30 * n] and scored <= 3 * ranked.STEP
    sums = impact.reshape(3, n).sum(0)
    found, scores, _ = shard.best(np.arange(3), 10, 0)
    assert sorted(scores.tolist()) == sorted(sums)[-10:]
    assert shard.best(np.arange(3), 10, 31 * n)[0].tolist() == []  # a floor of earlier shards


def test_stops_strictly_below_the_kth():
    """A document that ties with the k-th is found even if the bound is equal to it."""
    doc, term, impact = np.array([0, 1, 2, 3, 0, 1]), np.array([0, 0, 0, 0, 1, 1]), np.array([7] * 4 + [3, 3])
    found, _, _ = ranked.Shard(doc, term, impact, 4, 2).best(np.arange(2), 3, 0)
    assert sorted(found.tolist()) == [0, 1, 2, 3]


def test_edges(spark):
    docs = [(1, "Alpha beta"), (2, "alpha BETA"), (2, "alpha BETA"), (3, None), (4, ""), (5, "... --"), (6, "alpha " * 30000 + "omega"), (None, "alpha beta"), (7, "été ÉTÉ É2"), (8, "gamma")]
    items = [(1, "alpha"), (1, "BETA alpha"), (2, None), (3, "?"), (None, "été gamma"), (4, "nowhere"), (5, "omega omega"), (6, "alpha é2 gamma")]
    want = plain(docs, items, 3)
    assert results(ranked.search(*frames(spark, docs, items), k=3)) == want and set(want) == {1, None, 5, 6}
    d, i = frames(spark, docs, items)
    clash = d.withColumns({"n": F.lit(1), "term": F.lit("x"), "tf": F.lit(None), "score": F.lit(0), "a.b": F.lit(1)}), i.withColumns({"term": F.lit(1), "doc_id": F.lit(2)})
    assert results(ranked.search(*clash, k=3)) == want
    assert ranked.search(d.limit(0), i, k=3).collect() == [] and ranked.search(d, i.limit(0), k=3).collect() == []
