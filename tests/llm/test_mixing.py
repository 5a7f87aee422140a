import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cropledger.llm import mixing, queries

SCHEMA = "doc_id long, text string, source string, key string, epoch int, n_tokens int"


def corpus(spark, sizes, words=5):
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((i, " ".join(f"w{i}" for _ in range(1 + i % words)), s, "k", 1, 2))
            i += 1
    return spark.createDataFrame(rows, SCHEMA), rows


def plain_exponent(sizes, repetition):
    """Bisection on the ratio of the most to the least repeated source."""
    p = [n / sum(sizes.values()) for n in sizes.values()]
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        r = [x ** (mid - 1) for x in p]
        lo, hi = (lo, mid) if max(r) / min(r) <= repetition else (mid, hi)
    return hi


def tokens(rows):
    out = Counter()
    for r in rows:
        out[r[2]] += max(1, len((r[1] or "").split()))
    return out


def test_repetition_limit_keeps_all_rows(spark):
    df, rows = corpus(spark, {"a": 300, "b": 40, "c": 10})
    out = mixing.mix(df).collect()
    assert {r.doc_id for r in out} == {r[0] for r in rows}
    size, got = tokens(rows), Counter()
    for r in out:
        got[r.source] += r.mix.n_tokens
    x = plain_exponent(size, 2.0)
    assert abs(out[0].mix.exponent - x) < 1e-9
    budget = math.ceil(max(n / (n**x / sum(m**x for m in size.values())) for n in size.values()))
    for s, n in size.items():
        own = n**x / sum(m**x for m in size.values()) * budget
        assert own - 5 <= got[s] <= own + 1 and got[s] <= 2 * n + 1
    assert max(Counter((r.doc_id, r.mix.epoch) for r in out).values()) == 1


def test_budget_and_entropy(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 40)
    df, rows = corpus(spark, {"a": 300, "b": 40, None: 10})
    out = mixing.mix(df, repetition=None, entropy=0.9, budget=600).collect()
    w = {r.source: r.mix.weight for r in out}
    h = -sum(x * math.log(x) for x in w.values())
    assert abs(sum(w.values()) - 1) < 1e-9 and abs(h - 0.9 * math.log(3)) < 1e-6
    got, slots = Counter(), defaultdict(list)
    for r in out:
        got[r.source] += r.mix.n_tokens
        slots[r.source].append(r.mix.slot)
    for s, x in w.items():
        assert x * 600 - 6 <= got[s] <= x * 600 + 1e-6
    assert all(0 <= v < 1 for vs in slots.values() for v in vs)


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, None, "k", 1, 1), (2, "", "a", "k", 1, 1), (2, "", "a", "k", 1, 1), (None, "x " * 50000, "b", None, None, None)], SCHEMA)
    out = mixing.mix(df).collect()
    assert {(r.doc_id, r.source) for r in out} == {(1, None), (2, "a"), (None, "b")}
    assert mixing.mix(df.limit(0)).collect() == []
    assert mixing.mix(df.where("doc_id = 2")).count() == 2


def replay(spark, docs, budget=None, seed=0):
    """Rows (doc_id, epoch) that mix() takes, chosen one by one; hashes alone are Spark's."""
    hashed = docs.select(
        "doc_id", "text", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("s"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"), F.xxhash64(F.lit(seed), F.xxhash64(F.lit(seed), "doc_id", "text")).alias("to_block"),
        F.xxhash64(F.lit(seed + 1), F.xxhash64(F.lit(seed), "doc_id", "text")).alias("fill"),
    ).collect()
    size = defaultdict(int)
    tokens_of = {}
    for r in hashed:
        tokens_of[r.key] = max(1, len(re.findall(r"\S+", r.text or "")))
        size[r.s] += tokens_of[r.key]
    whole = sum(size.values())
    x = plain_exponent(size, 2.0) if budget is None else 1.0
    norm = sum((n / whole) ** x for n in size.values())
    if budget is None:
        budget = math.ceil(max((n / whole) * whole / ((n / whole) ** x / norm) for n in size.values()))
    taken = Counter()
    for s, n in size.items():
        own = math.floor((n / whole) ** x / norm * budget + 1e-6)
        own = n if n - 1 <= own < n else own
        blocks = min(mixing.MOST_BLOCKS, math.ceil(n / mixing.BLOCK_TOKENS))
        by = defaultdict(list)
        for r in hashed:
            if r.s == s:
                by[r.to_block % blocks].append(r)
        for epoch in range(own // n + 1):
            placed = spark.createDataFrame([(b,) for b in by], "block int").select("block", F.xxhash64(F.lit(seed), F.lit(epoch), F.lit(s), "block").alias("h")).collect()
            end = epoch * n
            for b in [r.block for r in sorted(placed, key=lambda r: (r.h, r.block))]:
                start, rows = end, by[b]
                end += sum(tokens_of[r.key] for r in rows)
                if end <= own:
                    taken.update((r.doc_id, epoch) for r in rows)
                elif start < own:
                    used, keys = start, sorted({(r.fill, r.key) for r in rows})
                    for _, key in keys:
                        same = [r for r in rows if r.key == key]
                        used += sum(tokens_of[key] for _ in same)
                        if used <= own:
                            taken.update((r.doc_id, epoch) for r in same)
    return taken


@pytest.mark.parametrize("budget", [None, 40_000])
def test_chosen_rows_by_a_plain_version(spark, monkeypatch, budget):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 700)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    args = {} if budget is None else {"repetition": None, "entropy": 0.0, "budget": budget}
    got = Counter((r.doc_id, r.mix.epoch) for r in mixing.mix(docs, **args).collect())
    assert got == replay(spark, docs, budget)


def test_clashing_columns(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30).withColumns({"mix": F.lit("m"), "MIX_": F.lit(1), "_mix": F.struct(F.lit(1).alias("epoch")), "row": F.lit(2), "hash": F.lit(3), "a.b": F.lit(4)})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op6_mixing(spark, str(tmp_path))
    assert out.columns == ["doc_id", "source", "epoch", "block", "slot", "n_tokens", "weight", "exponent"] and out.count() >= 30
