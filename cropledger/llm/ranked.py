"""Ranked lexical search: the best position algorithm over impact-ordered lists of shards of documents."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialise, small_batches

#: Pairs (item, term) in a block of items that is sent to all tasks, and postings that a shard holds before it is searched.
PAIRS, POSTINGS = 200_000, 4_000_000
#: Positions that a list is read by at first; each further step reads twice as many.
STEP = 64
#: Groups that the best rows of all tasks are dealt to before the last ranking of an item.
SALTS = 64

#: Bytes of terms are kept, A-Z in lower case; the bytes of all code points from 0x80 on belong to terms.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERMS).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term), each once; rows that share an id are one item."""
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            found = [sorted(set(terms_of(t))) for t in texts]
            at = np.repeat(np.arange(len(found)), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.array([t for x in found for t in x], pa.binary())], names=["item_id", "term"])

    rows = items.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"item_id {kind}, term binary").distinct()


def index(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, term, tf) of every document that has a term at all: n terms with repeats; of those in `terms` the places there and counts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        for batch in batches:
            n, term, tf, keep = [], [], [], []
            for i, t in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                if words := terms_of(t):
                    counts = Counter(map(place.get, words))
                    counts.pop(None, None)
                    known = sorted(counts.items())
                    keep.append(i)
                    n.append(len(words))
                    term.append([x for x, _ in known])
                    tf.append([x for _, x in known])
            if keep:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), pa.array(n, pa.int64()), pa.array(term, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64()))], names=["doc_id", "n", "term", "tf"])

    return docs.mapInArrow(run, f"doc_id {kind}, n long, term array<int>, tf array<bigint>")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 50 + 50 * n * n_docs // n_terms


class Shard:
    """The impact lists of some documents: for each term its documents, highest impact first, and for each document its terms' impacts and positions."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        by_term = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[by_term], impact[by_term]
        self.starts = np.searchsorted(term[by_term], np.arange(n_terms + 1))
        position = np.empty(len(doc), np.int64)
        position[by_term] = np.arange(len(doc)) - self.starts[term[by_term]]
        by_doc = np.argsort(doc, kind="stable")
        self.d_term, self.d_impact, self.d_position = term[by_doc], impact[by_doc], position[by_doc]
        self.d_starts = np.searchsorted(doc[by_doc], np.arange(n_docs + 1))
        self.slot = np.full(n_terms, -1, np.int64)
        self.seen = np.zeros(n_docs, bool)

    def best(self, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores) that hold the k highest sums over terms and all that tie with the k-th; how many documents were scored.

        Lists are read from the top, some positions at a time. A document that comes up is looked up in all lists, which gives its score and
        marks its positions as seen. The best position of a list is the last before its first unseen one, so no unseen document has more there
        than the impact that follows; past the end it has none. Reading stops once the sum of these bounds is strictly below
        the k-th score, which is at least floor.
        """
        terms = terms[self.starts[terms + 1] > self.starts[terms]]
        first, size = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        self.slot[terms] = np.arange(len(terms))
        marks = [np.zeros(n + 1, bool) for n in size]
        bound_at = np.zeros(len(terms), np.int64)
        docs, scores, read, step, kth = [], [], 0, STEP, floor
        top = np.full(k, floor, np.int64)
        while len(terms):
            fresh = np.unique(np.concatenate([self.doc[f + read : f + min(n, read + step)] for f, n in zip(first, size) if n > read] or [self.doc[:0]]))
            fresh = fresh[~self.seen[fresh]]
            read, step = read + step, step * 2
            if len(fresh):
                self.seen[fresh] = True
                lengths = self.d_starts[fresh + 1] - self.d_starts[fresh]
                at = np.repeat(self.d_starts[fresh] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
                slot, owner = self.slot[self.d_term[at]], np.repeat(np.arange(len(fresh)), lengths)
                own = slot >= 0
                slot, owner, at = slot[own], owner[own], at[own]
                score = np.zeros(len(fresh), np.int64)
                np.add.at(score, owner, self.d_impact[at])
                docs.append(fresh)
                scores.append(score)
                both = np.concatenate((top, score))
                top = both if len(both) <= k else np.partition(both, -k)[-k:]
                kth = int(top.min())
                order = np.argsort(slot, kind="stable")
                ends = np.searchsorted(slot[order], np.arange(len(terms) + 1))
                for i in range(len(terms)):
                    marks[i][self.d_position[at[order[ends[i] : ends[i + 1]]]]] = True
            for i, m in enumerate(marks):  # one place more than the list has is never marked
                bound_at[i] += int(np.argmin(m[bound_at[i] :]))
            inside = bound_at < size
            bound = int(self.impact[(first + bound_at)[inside]].sum())
            if bound < max(kth, 1) or not inside.any():
                break
        self.slot[terms] = -1
        if not docs:
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        self.seen[docs] = False
        keep = scores >= max(kth, 1)
        return docs[keep], scores[keep], len(docs)


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's k documents of the highest score above 0, equal scores by ascending doc_id.

    Terms, weights and scores are those of term_weight() and length_norm(): whole numbers, exact. Items come in blocks of bounded size. The
    documents' counts of a block's terms are written once; every task then fills shards of bounded size from them and searches each
    with all items of the block, handing on the k-th score as the next shard's floor. At most k rows an item (and ties of the k-th that have
    no smaller doc_id) leave a task.
    Null texts have no terms and are never found; texts are read whole. Repeated rows are documents of their own and may each be ranked;
    rows without doc_id come first among equal scores. Items that share an id are one item of all their terms, a null id included; items without
    terms and empty tables give no rows. Extra columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pairs = materialise(item_terms(items, item_col, item_text_col), "item_terms")
    n_blocks = -(-pairs.count() // PAIRS)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = [_search_block(rows, pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b), k) for b in range(n_blocks)]
    kinds = pairs.schema["item_id"].dataType.simpleString(), rows.schema["doc_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kinds[0]}, doc_id {kinds[1]}, score long, salt int")
    for more in found:
        out = out.unionByName(more)
    for keys in (["item_id", "salt"], ["item_id"]):
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
        out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    by_item: dict = {}
    for r in pairs.collect():  # about PAIRS rows
        by_item.setdefault(r.item_id, []).append(bytes(r.term))
    terms = sorted({t for ts in by_item.values() for t in ts})
    place = {t: i for i, t in enumerate(terms)}
    kinds = {c: d.schema[c].dataType.simpleString() for d, c in ((pairs, "item_id"), (docs, "doc_id"))}
    arrow = to_arrow_type(pairs.schema["item_id"].dataType), to_arrow_type(docs.schema["doc_id"].dataType), pa.int64()
    postings = materialise(index(docs, terms), "postings")
    total = postings.agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_terms")).collect()[0]
    n_docs, n_terms = total.n_docs, total.n_terms or 0
    weights = np.zeros(len(terms), np.int64)
    for r in postings.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():  # one row a term of the block
        weights[r.term] = term_weight(n_docs, r.df)
    shared = docs.sparkSession.sparkContext.broadcast((list(by_item), [np.array([place[t] for t in ts], np.int64) for ts in by_item.values()], weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, lists, w = shared.value
        best: list[list] = [[] for _ in names]  # (-score, has an id, id) in order, k at most

        def searched(held: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            sizes = t.column("term").chunk(0).value_lengths().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(len(t)), sizes)
            term, tf = (t.column(c).chunk(0).flatten().to_numpy().astype(np.int64) for c in ("term", "tf"))
            norm = np.array([length_norm(x, n_docs, n_terms) for x in t.column("n").to_pylist()], np.int64)
            impact = w[term] * (1_000_000_000 * tf // (1000 * tf + 20 * norm[doc]))
            shard, ids = Shard(doc, term, impact, len(t), len(w)), t.column("doc_id")
            for i, own in enumerate(lists):
                docs_found, scores, _ = shard.best(own, k, -best[i][-1][0] if len(best[i]) == k else 0)
                if len(docs_found):
                    new = zip(scores.tolist(), ids.take(pa.array(docs_found)).to_pylist())
                    best[i] = sorted([*best[i], *((-s, d is not None, d) for s, d in new)], key=lambda x: (x[0], x[1], x[2] if x[1] else 0))[:k]

        held, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            size += len(batch.column("term").flatten())
            if size >= POSTINGS:
                searched(held)
                held, size = [], 0
        if held:
            searched(held)
        rows = [(names[i], x[2], -x[0]) for i, near in enumerate(best) for x in near]
        if rows:
            a, b, s = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip((a, b, s), arrow)], names=["item_id", "doc_id", "score"])

    out = postings.mapInArrow(run, f"item_id {kinds['item_id']}, doc_id {kinds['doc_id']}, score long")
    return out.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))


#: DuckDB SQL for search(documents, benchmark).
SQL = r"""
with found as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term, place
  from (select *, row_number() over () as place from documents)),
sized as (select place, any_value(doc_id) as doc_id, count(*) as n from found group by place),
total as (select count(*) as docs, sum(n)::bigint as terms from sized),
asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
counted as (select place, term, count(*) as tf from found where term in (select term from asked) group by place, term),
weighed as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w from counted, total group by term),
scored as (
  select a.item_id, s.doc_id, c.place, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // terms)))))::bigint as score
  from asked a join counted c using (term) join weighed using (term) join sized s using (place), total
  group by a.item_id, s.doc_id, c.place),
ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""
