import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
from brute import SMALL
from pyspark.sql import functions as F

from cropledger.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs):
    """Rows of audit() over (text, lang, source), all terms and pairs spelled out."""
    n, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source, words = lang or "", source or "", TERM.findall((text or "").translate(SMALL))
        groups.add((lang, source))
        n[lang, source].update(words)
        df[lang].update(set(words))
    kept = {lang: sorted(t for t, c in df[lang].items() if c >= 10) for lang, _ in groups}
    whole = {lang: sum((n[g] for g in groups if g[0] == lang), Counter()) for lang in kept}
    share = lambda counts, ts: {t: 1 + 10**9 * (counts[t] + 2) // (sum(counts[t] for t in ts) + 2 * len(ts)) for t in ts}
    p, q = {g: share(n[g], kept[g[0]]) for g in groups}, {lang: share(whole[lang], ts) for lang, ts in kept.items()}
    f = lambda a, b: (a - b) ** 2 // (a + b)
    out = []
    for lang, source in groups:
        own = p[lang, source]
        pair = [(-sum(f(own[t], p[lang, s][t]) for t in kept[lang]), s.encode(), s) for x, s in groups if x == lang and s != source]
        term = [(-f(own[t], q[lang][t]), t.encode(), t) for t in kept[lang] if n[lang, source][t] > 0 and own[t] > q[lang][t]]
        out += [(lang, source, "pair", x[2], -x[0], i) for i, x in enumerate(sorted(pair), 1)]
        out += [(lang, source, "term", x[2], -x[0], i) for i, x in enumerate(sorted(term)[:10], 1)]
    return sorted(out)


def results(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


def test_same_rows_as_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    got = results(queries.op12_divergence(spark, sf))
    assert got == sorted(con.execute(divergence.SQL).fetchall()) and {r[2] for r in got} == {"pair", "term"}


def test_small_slices_blocks_and_flushes(spark, monkeypatch):
    for name, value in (("SLICE", 7), ("BLOCK", 2), ("COUNTED", 40), ("HELD", 60)):
        monkeypatch.setattr(divergence, name, value)  # tasks get it with the function
    rng = np.random.default_rng(2)
    words = [f"{a}{b}" for a in "abcdé" for b in "vwxyz"]
    rows = [(" ".join(words[min(24, int(x))] for x in rng.exponential(6, 12)), "en" if i % 3 else "de", f"s{int(rng.integers(0, 5))}") for i in range(400)]
    assert results(divergence.audit(frame(spark, rows).repartition(3))) == plain(rows)


def test_skyband():
    rng = np.random.default_rng(4)
    for n, spread in ((1500, 2000), (1500, 5), (30, 3), (0, 1)):
        high, low, early = rng.integers(0, spread, n), rng.integers(0, spread, n), rng.permutation(n)
        above = ((high[:, None] >= high) & (low[:, None] <= low) & (early[:, None] < early)).sum(0) if n else np.array([])
        assert sorted(divergence.skyband(high, low, early, 3)) == np.flatnonzero(above < 3).tolist()


def test_edges(spark):
    rows = [("Alpha beta", "en", "a")] * 12 + [("alpha gamma gamma", "en", "b")] * 11 + [("ALPHA", "en", None)] * 3 + [(None, None, None), ("", "fr", "a"), ("solo", "fr", "b"), ("-- 12", "en", "c"), ("été " * 20000, "en", "a"), ("x", "it", "a")]
    rows += [("été", "en", "d")] * 10
    want = plain(rows)
    assert results(divergence.audit(frame(spark, rows))) == want and ("fr", "a", "pair", "b", 0, 1) in want
    clash = frame(spark, rows).withColumns({"term": F.lit("t"), "n": F.lit(1), "df": F.lit(None), "part": F.lit(0), "value": F.lit(1), "a.b": F.lit(2)})
    assert results(divergence.audit(clash)) == want
    assert divergence.audit(frame(spark, rows).limit(0)).collect() == []
    big = spark.range(1).select(divergence.share(F.lit(9 * 10**15), F.lit(10**16), F.lit(3)).alias("p")).first().p
    assert big == 1 + 10**9 * (9 * 10**15 + 2) // (10**16 + 6)
