"""Source divergence audit: how far each source's term shares are from other sources' and from its language's, top terms by dominance skybands."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialise, small_batches

#: Fewest documents of a language that a kept term is in, and terms that are ranked for a group.
LEAST_DOCUMENTS, TOP = 10, 10
#: Entries that a task counts before it hands them on, and rows that it holds in skybands.
COUNTED, HELD = 1_000_000, 200_000
#: Terms in a slice and sources in a block: a cell compares two blocks on a slice.
SLICE, BLOCK = 4096, 64
#: Groups that a group's first skybands are dealt to and merged in.
SALTS = 8

#: Letters and the bytes of all code points from 0x80 on make terms; A-Z in lower case.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents of each term of each group, and one row with a null term for each group.

    A task adds up what it reads and hands sums on, again whenever it holds COUNTED of them; they are then added up by key.
    """
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, df) in sums.items():
                terms = list(n)
                columns = [pa.array([None, *terms], pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()), pa.array([0, *map(df.__getitem__, terms)], pa.int64())]  # first the group itself
                size = len(terms) + 1
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, size), pa.repeat(source, size), *columns], names=["lang", "source", "term", "n", "df"])

        for batch in batches:
            langs, sources, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()
            for lang, source, t in zip(langs, sources, texts):
                n, df = sums.setdefault((lang, source), (Counter(), Counter()))
                words = t.translate(_TERMS).split()
                n.update(words)
                df.update(set(words))
            if sum(len(n) for n, _ in sums.values()) + len(sums) > COUNTED:
                yield from told()
                sums.clear()
        yield from told()

    small_batches(docs.sparkSession)
    counted = rows.mapInArrow(run, "lang string, source string, term string, n long, df long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(1e9 * (count + 2) / (total + 2 * terms)), exact for counts of any size."""
    wide = lambda c: c.cast("decimal(19,0)")
    above, below = (F.lit(1_000_000_000).cast("decimal(10,0)") * (wide(count) + 2)).cast("decimal(30,0)"), (wide(total) + wide(terms) * 2).cast("decimal(22,0)")
    return F.lit(1) + F.call_function("div", above, below)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of shares: both are at most 1e9 + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def skyband(high: np.ndarray, low: np.ndarray, early: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that fewer than k others dominate: others of high at least as high, low at least as low and a smaller early.

    Rows are walked from high to low, so a row's dominators come before it. A row outside the skyband is dominated by k of it at
    least, which dominate whatever that row does: rows are compared with the skyband so far alone.
    """
    order = np.lexsort((early, low, -high))
    low, early = low[order], early[order]
    kept_low, kept_early, kept = np.empty(0, low.dtype), np.empty(0, early.dtype), []
    for at in range(0, len(order), 512):
        part_low, part_early = low[at : at + 512], early[at : at + 512]
        above = np.zeros(len(part_low), np.int64)
        for i in range(0, len(kept_low), 4096):
            above += ((kept_low[i : i + 4096, None] <= part_low) & (kept_early[i : i + 4096, None] < part_early)).sum(0)
            if (above >= k).all():
                break
        left = np.flatnonzero(above < k)
        new: list[int] = []
        for j in left:
            mine = np.array(new, np.int64)
            if above[j] + np.count_nonzero((part_low[mine] <= part_low[j]) & (part_early[mine] < part_early[j])) < k:
                new.append(int(j))
        kept_low, kept_early = np.concatenate((kept_low, part_low[new])), np.concatenate((kept_early, part_early[new]))
        kept += [at + j for j in new]
    return order[kept]


def _skybands(rows: DataFrame, k: int) -> DataFrame:
    """Of rows (lang, source, term, n, lang_n), those in the skybands of their groups within each partition, as they are dealt."""

    def kept(parts: list[pd.DataFrame]) -> pd.DataFrame:
        both = pd.concat(parts)
        early = np.empty(len(both), np.int64)
        early[np.argsort(both["term"].to_numpy(), kind="stable")] = np.arange(len(both))  # code points order as UTF-8 does
        return both.iloc[skyband(both["n"].to_numpy(), both["lang_n"].to_numpy(), early, k)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str], list[pd.DataFrame]] = {}
        size = 0
        for frame in frames:
            for key, part in frame.groupby(["lang", "source"], sort=False):
                held.setdefault(key, []).append(part)
            size += len(frame)
            if size > HELD:
                held = {key: [kept(parts)] for key, parts in held.items()}
                size = sum(len(parts[0]) for parts in held.values())
                if size > HELD // 2:
                    yield from (parts[0] for parts in held.values())
                    held, size = {}, 0
        yield from map(kept, held.values())

    return rows.select("lang", "source", "term", "n", "lang_n").mapInPandas(run, "lang string, source string, term string, n long, lang_n long")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _pairs(own: DataFrame, kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): for every two sources a < b of a language the divergences of all its kept terms, summed.

    A term falls to a slice of its language by hash, a source to a block by its number. A cell (slice, two blocks) fills in the terms that a source
    has not got and gives one sum for two sources; terms of the slice that none of its sources has count together. Cells' sums are then added up.
    """
    slices = F.greatest(F.lit(1), F.ceil(F.col("v") / SLICE)).cast("int")
    numbered = groups.withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    numbered = materialise(numbered.select("*", slices.alias("slices"), F.floor(F.col("number") / BLOCK).cast("int").alias("block")), "source_blocks")
    langs = numbered.groupBy("lang").agg(F.first("slices").alias("slices"), (F.max("block") + 1).alias("blocks"))
    place = F.pmod(F.xxhash64("term"), F.col("slices")).cast("int").alias("slice")
    in_slice = kept.join(_small(langs), "lang").select("lang", place).groupBy("lang", "slice").agg(F.count("*").alias("terms"))
    # Each source is in every slice of its language, if only by a row without a term.
    every = numbered.select("lang", "number", "block", "p0", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")).join(in_slice, ["lang", "slice"], "left")
    every = every.select("lang", "slice", "number", "block", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), F.coalesce("terms", F.lit(0)).alias("terms"))
    held = own.join(_small(numbered.select("lang", "source", "number", "block", "slices")), ["lang", "source"])
    held = held.select("lang", place, "number", "block", "term", "p", F.lit(0).cast("long").alias("terms"))
    dealt = every.unionByName(held).join(_small(langs.drop("slices")), "lang").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("lang", "slice", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "number", "term", "p", "terms")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lang, i, j = pdf["lang"].iloc[0], int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        none = pdf["term"].isna()
        bases, rows = pdf[none].sort_values("number"), pdf[~none]
        number, base = bases["number"].to_numpy(), bases["p"].to_numpy()
        term, column = np.unique(rows["term"].to_numpy(str), return_inverse=True)
        p = np.repeat(base[:, None], len(term), axis=1)
        p[np.searchsorted(number, rows["number"].to_numpy()), column] = rows["p"].to_numpy()
        rest = int(pdf["terms"].max()) - len(term)
        found = []
        for x in np.flatnonzero(number // BLOCK == i):
            y = np.flatnonzero((number // BLOCK == j) & (number > number[x]))
            value = ((p[y] - p[x]) ** 2 // (p[y] + p[x])).sum(1) + rest * ((base[y] - base[x]) ** 2 // (base[y] + base[x]))
            found.append(pd.DataFrame({"lang": lang, "a": number[x], "b": number[y], "value": value}))
        return pd.concat(found)

    sums = dealt.groupBy("lang", "slice", "i", "j").applyInPandas(run, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    for side in "ab":
        sums = sums.join(_small(numbered.select("lang", F.col("number").alias(side), F.col("source").alias(f"source_{side}"))), ["lang", side])
    return sums.select("lang", F.col("source_a").alias("a"), F.col("source_b").alias("b"), "value")


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank: each source's divergence from every other source of its language, and its own leading terms.

    The terms of a language are those in at least LEAST_DOCUMENTS of its documents. Part `pair` has the other sources, part `term` the TOP terms
    of which the source has more than its language, by divergence() of share()s; equal values rank by the UTF-8 of item. Counts are of
    whole texts and all documents. A term's value grows with its count in the group and falls with that in the language, so it is ranked
    only if fewer than TOP others dominate it: tasks keep the skyband of each group in what they read, these are merged, and the rest is ranked exactly.
    Null lang, source and text are empty ones, and empty lang and source are values like others. Repeated rows count as often as they occur. A source without kept
    terms has its pairs; a language without any has pairs of value 0. An empty table gives no rows. Extra columns are not read, whatever their names.
    """
    counts = materialise(term_counts(docs, lang_col, source_col, text_col), "term_counts")
    known = counts.where("term is not null")
    kept = materialise(known.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df")).where(F.col("df") >= LEAST_DOCUMENTS).drop("df"), "kept_terms")
    held = materialise(known.drop("df").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept_counts")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "v", "lang_total")))
    p0 = F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v"))).otherwise(1)
    groups = materialise(groups.withColumn("p0", p0), "groups")
    scale = _small(groups.select("lang", "source", "total", "v", "lang_total"))
    own = held.join(scale, ["lang", "source"]).select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    two = materialise(_pairs(own, kept, groups), "source_pairs")
    pairs = two.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(two.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    scaled = lambda rows: rows.join(scale, ["lang", "source"]).withColumns({"p": share(F.col("n"), F.col("total"), F.col("v")), "q": share(F.col("lang_n"), F.col("lang_total"), F.col("v"))}).where("p > q")
    first = _skybands(scaled(held), TOP).repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(SALTS)))
    merged = scaled(_skybands(first, TOP))
    terms = merged.select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")
    columns = lambda part: ("lang", "source", F.lit(part).alias("part"), "item", "value", rank)
    return pairs.select(*columns("pair")).unionByName(terms.select(*columns("term")).where(F.col("rank") <= TOP))


#: DuckDB SQL for audit(documents).
SQL = r"""
with docs as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as place,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
words as (select lang, source, place, unnest(terms) as term from docs),
counted as (select lang, source, term, count(*) as n, count(distinct place) as df from words group by all),
kept as (select lang, term, sum(n) as lang_n from counted group by lang, term having sum(df) >= 10),
langs as (select lang, count(*) as v, sum(lang_n) as lang_total from kept group by lang),
groups as (select distinct lang, source from docs),
own as (
  select g.lang, g.source, k.term, coalesce(c.n, 0)::hugeint as n, k.lang_n
  from groups g join kept k using (lang) left join counted c using (lang, source, term)),
totals as (select lang, source, sum(n) as total from own group by lang, source),
shares as (
  select o.lang, o.source, o.term, o.n, 1 + (1000000000 * (n + 2)) // (total + 2 * v) as p, 1 + (1000000000 * (lang_n + 2)) // (lang_total + 2 * v) as q
  from own o join totals using (lang, source) join langs using (lang)),
summed as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
rows_of as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source left join summed s on s.lang = a.lang and s.source = a.source and s.item = b.source
  union all
  select lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::bigint from shares where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from rows_of)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
"""
