"""MinHash near-duplicates with an LSH forest: sorted signature orders, longest-common-prefix neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, connected_components, join_named, materialise, small_batches

#: Trees (sorted orders), the prefix that makes two rows neighbours at all, and the deepest prefix of a crowded region.
#: A pair of similarity 0.8 shares no prefix of 4 in 20 trees with probability (1 - 0.8 ** 4) ** 20 = 3e-5.
TREES, SHALLOW, DEEP = 20, 4, 6
#: Largest region whose pairs are listed as they are; larger ones are taken deeper, and then compared in blocks.
REGION = 32
#: Classes in a block of a crowded region, and the largest region that is compared in blocks before it is taken deeper.
BLOCK, CROWD = 256, 4096
#: Trees at depth DEEP in all for the classes of regions beyond CROWD: the fewest that miss a pair at 0.8 no more often than
#: TREES at depth SHALLOW do, as (1 - 0.8 ** 6) ** 35 = 2.4e-5. Only these classes get the signatures of the further ones.
CROWD_TREES = 35

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MULTIPLIERS = (np.random.default_rng(20240607).integers(0, 2**31, TREES * DEEP, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_FURTHER = (np.random.default_rng(20251128).integers(0, 2**31, (CROWD_TREES - TREES) * DEEP, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_WORDS: dict[bytes, int] = {}
_WORDS_KEPT = 400_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; a text of fewer words has one, of all its words."""
    from xxhash import xxh3_64_intdigest

    words = (text or b"").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_WORDS) > _WORDS_KEPT:
        _WORDS.clear()
    for w in set(words).difference(_WORDS):
        _WORDS[w] = xxh3_64_intdigest(w)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(width, len(words))
    out = _mix(h[: len(h) - k + 1] + np.uint64(k))
    for i in range(1, k):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
    return np.unique(out)


def _signature(s: np.ndarray, multipliers: np.ndarray = _MULTIPLIERS) -> bytes:
    x = (s >> np.uint64(32)).astype(np.uint32)
    low = np.empty(len(multipliers), np.uint32)
    buf = np.empty_like(x)
    for i, m in enumerate(multipliers):
        np.multiply(x, m, out=buf)
        low[i] = buf.min()
    return low.astype(">u4").tobytes()


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, cls, sig) per row; cls is a 128-bit hash of the whole shingle set, null if empty."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cls, sig = [], [], []
            for t in batch.column(2).cast(pa.binary()).to_pylist():
                s = shingle_set(t, width)
                n.append(len(s))
                cls.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(_signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "text_hash", "n_shingles", "cls", "sig"])

    return docs.mapInArrow(run, f"doc_id {id_type}, text_hash long, n_shingles long, cls binary, sig binary")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t, width).view(np.int64) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["cls", "items"])

    return docs.mapInArrow(run, "cls binary, items array<bigint>")


def _sets_of(involved: DataFrame, docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(cls, items) of the distinct classes in involved, built again from the text that stands for each."""
    keys = materialise(classes.join(involved, "cls").select("cls", F.col("rep.doc_id").alias("k1"), F.col("rep.text_hash").alias("k2")), "keys")
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
    texts = docs.join(keys, F.col("doc_id").eqNullSafe(F.col("k1")) & (F.col("text_hash") == F.col("k2"))).select("cls", "text")
    return materialise(_sets(texts, width).dropDuplicates(["cls"]), "sets")


def _linked(threshold: int):
    """Jaccard similarity of the sets of two rows, in whole numbers: 100 * common >= threshold * union."""
    common = F.size(F.array_intersect("items_a", "items_b"))
    return common * 100 >= (F.size("items_a") + F.size("items_b") - common) * threshold


def _confirm(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, threshold: int) -> DataFrame:
    """Those of the distinct (a, b) pairs of classes whose full sets are similar enough. Sets are built for these classes alone."""
    involved = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    sets = _sets_of(involved, docs, classes, width)
    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("items").alias("items_a")), "a").join(sets.select(F.col("cls").alias("b"), F.col("items").alias("items_b")), "b")
    return both.where(_linked(threshold)).select("a", "b")


def _in_order(forest: DataFrame) -> DataFrame:
    """(tree, path, cls, before, after) of the rows of forest that have a neighbour: the row next to it in the order of
    (tree, path, cls) with the same tree and a common prefix of SHALLOW.

    Ranges of that order are dealt to tasks, so a region of any size spreads over as many as it needs. Only the first and the
    last row of each task miss a neighbour; they are put side by side in a table of two rows a task at most.
    """
    ranged = forest.repartitionByRange("tree", "path", "cls").sortWithinPartitions("tree", "path", "cls")
    names = ["tree", "path", "cls", "before", "after", "part", "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, known, first = TaskContext.get().partitionId(), None, None, True

        def told(t: pa.RecordBatch, before: pa.Array, after: pa.Array, last: bool) -> pa.RecordBatch:
            at_first = np.zeros(len(t), bool)
            at_first[0] = first
            ends = pa.array(at_first), pa.array(np.full(len(t), last))
            keep = pc.or_(pc.or_(before.is_valid(), after.is_valid()), pc.or_(*ends))
            return pa.RecordBatch.from_arrays([*t.columns, before, after, pa.array(np.full(len(t), part, np.int32)), *ends], names=names).filter(keep)

        for batch in batches:
            if not len(batch):
                continue
            t = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            tree, cls = t.column(0).to_numpy(), t.column(2)
            path = np.frombuffer(b"".join(t.column(1).to_pylist()), np.uint8).reshape(len(t), -1)[:, : 4 * SHALLOW]
            unlike, at = (tree[1:] != tree[:-1]) | (path[1:] != path[:-1]).any(axis=1), np.arange(len(t))
            before = pa.concat_arrays([pa.array([known], cls.type), cls.take(pa.array(at[:-1], mask=unlike))])
            if len(t) > 1:
                yield told(t.slice(0, len(t) - 1), before[:-1], cls.take(pa.array(at[1:], mask=unlike)), False)
                first = False
            held, known = t.slice(len(t) - 1), before[-1].as_py()
        if held is not None:
            kind = held.column(2).type
            yield told(held, pa.array([known], kind), pa.array([None], kind), True)

    kept = materialise(ranged.mapInArrow(run, "tree int, path binary, cls binary, before binary, after binary, part int, first boolean, last boolean"), "forest")
    order = Window.orderBy("part", "tree", "path", "cls")
    place = F.struct("tree", F.substring("path", 1, 4 * SHALLOW))
    ends = kept.where("first or last").withColumn("place", place)
    ends = ends.withColumns({"p": F.lag("place").over(order), "pc": F.lag("cls").over(order), "n": F.lead("place").over(order), "nc": F.lead("cls").over(order)})
    mended = {"before": F.when(F.col("first"), F.when(F.col("p") == F.col("place"), F.col("pc"))).otherwise(F.col("before")), "after": F.when(F.col("last"), F.when(F.col("n") == F.col("place"), F.col("nc"))).otherwise(F.col("after"))}
    ends = materialise(ends.withColumns(mended).where("before is not null or after is not null").select(*names[:5]), "forest_ends")
    return kept.where("not first and not last").select(*names[:5]).unionByName(ends)


def _candidates(items: list[np.ndarray], threshold: int) -> Iterator[tuple[int, int]]:
    """Places (p, q) of all pairs of sets that can have a similarity of threshold, and some others; sets are in order of size.

    Two such sets share one of their first |s| - threshold * |s| + 1 elements, whatever order all elements are put in; here the rarest
    come first. Sets that share much, as near copies do, would meet in many of these lists: they are paired by size alone.
    """
    sizes = [len(x) for x in items]
    element, place, count = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    rank = np.empty(len(element), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(element))
    ends = np.cumsum([0, *sizes])
    firsts = [np.sort(rank[place[ends[i] : ends[i + 1]]])[: n + 1 + (-n * threshold) // 100] for i, n in enumerate(sizes)]
    held = np.bincount(np.concatenate(firsts), minlength=len(element)).astype(np.int64)
    if (held * (held - 1)).sum() > len(items) * len(items):
        for p, n in enumerate(sizes):
            for q in range(p + 1, len(items)):
                if n * 100 < threshold * sizes[q]:
                    break
                yield p, q
        return
    holders: dict[int, list[int]] = {}
    for q, own in enumerate(firsts):
        seen: set[int] = set()
        for x in own[held[own] > 1].tolist():
            others = holders.setdefault(x, [])
            seen.update(others)
            others.append(q)
        yield from ((p, q) for p in sorted(seen) if sizes[p] * 100 >= threshold * sizes[q])


def _crowded_links(rows: DataFrame, docs: DataFrame, classes: DataFrame, width: int, threshold: int) -> DataFrame:
    """Spanning links of regions that stay crowded: rows (region, cls, root, size), compared exactly block by block.

    Every class goes to as many cells as its region has blocks; a cell holds two blocks at most and gives a
    spanning forest of its links, not the links. All classes are compared, so no link between groups is lost.
    """
    counted = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    own = counted.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    sets = _sets_of(rows.select("cls").distinct(), docs, classes, width)
    dealt = own.join(sets, "cls").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("region", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cls", "root", "items")

    def run(pdf):
        import pandas as pd

        inside = pdf["i"].iloc[0] == pdf["j"].iloc[0]
        pdf = pdf.iloc[np.argsort([len(x) for x in pdf["items"]], kind="stable")]
        cls, items, block = list(pdf["cls"]), [np.asarray(x) for x in pdf["items"]], list(pdf["block"])
        known = {}  # what is linked already needs no comparison
        root, a, b = [known.setdefault(r, i) for i, r in enumerate(pdf["root"])], [], []

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        sizes = [len(x) for x in items]
        for p, q in _candidates(items, threshold):
            if (inside or block[p] != block[q]) and (x := find(p)) != (y := find(q)):
                common = len(np.intersect1d(items[p], items[q], assume_unique=True))
                if 100 * common >= threshold * (sizes[p] + sizes[q] - common):
                    root[x] = y
                    a.append(cls[p])
                    b.append(cls[q])
        return pd.DataFrame({"a": a, "b": b})

    return dealt.groupBy("region", "i", "j").applyInPandas(run, "a binary, b binary")


def _further_trees(crowd: DataFrame, docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(tree, path, cls, root) of the distinct (cls, root) rows of crowd in trees beyond TREES; path is DEEP hashes long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = [_signature(np.asarray(x, np.int64).view(np.uint64), _FURTHER) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sig, pa.binary())], names=["cls", "sig"])

    signed = _sets_of(crowd.select("cls"), docs, classes, width).mapInArrow(run, "cls binary, sig binary")
    number = F.explode(F.sequence(F.lit(0), F.lit(len(_FURTHER) // DEEP - 1)))
    placed = crowd.join(signed, "cls").select("cls", "root", "sig", number.alias("n"))
    return placed.select((F.col("n") + TREES).alias("tree"), F.substring("sig", F.col("n") * (4 * DEEP) + 1, F.lit(4 * DEEP)).alias("path"), "cls", "root")


def _grouped(docs: DataFrame, width: int, threshold: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, n_shingles, cls) of every row, and (cls, rep) of every class; rep is the first (doc_id, text_hash) of the class's component.

    Rows with equal shingle sets are one class. Signatures of classes are sorted in TREES orders; neighbours with
    a common prefix of SHALLOW or more are confirmed on full sets. Regions (equal prefixes) that still hold several
    components are then compared whole: their pairs if they are small, else in blocks. Regions beyond CROWD are
    taken deeper first, and their classes are sorted in CROWD_TREES orders, so that a pair is missed no more often there.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"), F.col(f"`{text_col}`").alias("text"))
    rows = materialise(_sketches(docs, width), "sketches")
    classes = materialise(
        rows.where("cls is not null").groupBy("cls").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("rep"), F.max("sig").alias("sig")), "classes"
    )
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    forest = classes.select("cls", "sig", tree.alias("tree")).select("tree", F.substring("sig", F.col("tree") * (4 * DEEP) + 1, F.lit(4 * DEEP)).alias("path"), "cls")
    shared = _in_order(forest)
    near = materialise(shared.where("before is not null").select(F.least("before", "cls").alias("a"), F.greatest("before", "cls").alias("b")).distinct(), "neighbours")
    links = materialise(_confirm(near, docs, classes, width, threshold), "links")
    first = connected_components(links)

    # What neighbours can't show: regions that still hold several components.
    grouped = shared.join(first.withColumnRenamed("node", "cls"), "cls", "left").select("tree", "path", "cls", F.coalesce("root", "cls").alias("root"))
    mixed, more, crowded = grouped, [], []
    for depth in range(SHALLOW, DEEP + 1):
        if depth == DEEP:
            mixed = mixed.unionByName(_further_trees(crowd, docs, classes, width))
        region = F.concat(F.lpad(F.col("tree").cast("string"), 3, "0").cast("binary"), F.substring("path", 1, 4 * depth))
        keyed = mixed.withColumn("region", region)
        size = keyed.groupBy("region").agg(F.count("*").alias("size"), F.min("root").alias("lowest"), F.max("root").alias("highest")).where("lowest != highest")
        size = materialise(size.select("region", "size"), "region_sizes")
        sized = materialise(join_named(keyed, size, "region").where("size is not null"), "regions")
        few = sized.where(F.col("size") <= REGION)
        left, right = few.select("region", F.col("cls").alias("a"), F.col("root").alias("ra")), few.select("region", F.col("cls").alias("b"), F.col("root").alias("rb"))
        more.append(left.join(right, "region").where("a < b and ra != rb").select("a", "b"))
        most = CROWD if depth < DEEP else 2**62
        blocks = sized.where((F.col("size") > REGION) & (F.col("size") <= most)).select("region", "cls", "root", "size")
        if not blocks.isEmpty():
            crowded.append(blocks)
        mixed = sized.where(F.col("size") > most).drop("size", "region")
        if depth == SHALLOW:
            crowd = materialise(mixed.select("cls", "root").distinct(), "crowd")
            if crowd.isEmpty():
                break
    pairs = more[0]
    for m in more[1:]:
        pairs = pairs.union(m)
    pairs = materialise(pairs.distinct().join(near, ["a", "b"], "left_anti"), "pairs")
    added = [] if pairs.isEmpty() else [_confirm(pairs, docs, classes, width, threshold)]
    added += [_crowded_links(blocks, docs, classes, width, threshold) for blocks in crowded]
    for m in added:
        links = links.union(m)
    roots = connected_components(links) if added else first
    labelled = materialise(classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("cls", F.coalesce("root", "cls").alias("root"), "rep"), "classes_of_roots")
    first_of = materialise(labelled.groupBy("root").agg(F.min("rep").alias("first")), "roots")
    return rows.select("doc_id", "text_hash", "n_shingles", "cls"), materialise(join_named(labelled.select("cls", "root"), first_of, "root").select("cls", F.col("first").alias("rep")), "named_classes")


def near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id linked, itself included), kept. See _grouped().

    Null or wordless texts link with nothing; rows without doc_id take part, but never name a component unless no
    row of theirs has an id. Repeated rows are all returned and texts read whole; an empty table gives no rows. Extra columns
    are not read, whatever their names.
    """
    rows, named = _grouped(docs, width, threshold, id_col, text_col)
    out = join_named(rows, named, "cls").select("doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("rep.doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, width: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near-duplicates, columns as they were: that of the smallest doc_id, and of the smallest text hash under it.

    Rows are told apart by id and text, so an id with several texts loses none that is unlike all others. Of rows that repeat both,
    one stays, whichever; rows without id go last in their group. Null or wordless texts link with nothing and all stay. An empty
    table gives none. Columns may have any names.
    """
    rows, named = _grouped(docs, width, threshold, id_col, text_col)
    keyed = join_named(rows.where("cls is not null"), named, "cls")
    first = F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("text_hash") == F.col("rep.text_hash"))
    marked = keyed.groupBy(F.col("doc_id").alias("k1"), F.col("text_hash").alias("k2")).agg(F.first(first).alias("first"), F.count("*").alias("n"))
    marked = materialise(marked.where("not first or n > 1"), "dropped")
    same = F.col("id").eqNullSafe(F.col("k1")) & (F.col("hash") == F.col("k2"))
    whole = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("hash"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    part = whole.join(F.broadcast(marked) if marked.count() <= BROADCAST_ROWS else marked, same, "left")
    out = part.where("first is null").select("row")
    if not marked.where("first").isEmpty():
        out = out.unionByName(materialise(part.where("first"), "repeated").dropDuplicates(["id", "hash"]).select("row"))
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns))
