"""Embedding near-duplicates: PCA-ordered tiles, leading dimensions first, suffix norms as bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, join_named, materialise, small_batches

#: Vectors in a tile, the leading dimensions after which the bound is tried again, and those in which tiles are boxes.
TILE = 2048
STAGES = (8, 24)
BOXES = 4
#: Widens bounds, so that rounding in the rotated space never discards a pair that the exact cosine accepts.
SLACK = 1e-6
#: Most rows of a table of tiles or labels that is broadcast (about 100 bytes each); larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _valid(v: str) -> str:
    return f"{v} is not null and size({v}) > 0 and forall({v}, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists({v}, x -> x != 0)"


def _unit(vectors: list) -> np.ndarray:
    """Vectors of one length, as given in doubles, at length 1."""
    x = np.array(vectors, float)
    largest = np.abs(x).max(1, keepdims=True)
    x = np.where((largest > 1e100) | (largest < 1e-100), x / largest, x)  # else squares could leave the range of doubles
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """The axes, most variance first, of each number of dimensions with more than TILE vectors; others need no tiles.

    Tasks add up products batch by batch and send d * d sums for each d; the driver gets the d * d totals.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            by: dict[int, list] = {}
            for v in batch.column(0).to_pylist():
                by.setdefault(len(v), []).append(v)
            for d, vs in by.items():
                x = _unit(vs)
                total[d] = total.get(d, 0) + x.T @ x
        for d, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d * d, d, np.int32)), pa.array(np.arange(d * d, dtype=np.int32)), pa.array(m.ravel())], names=["d", "at", "v"])

    many = [r.d for r in classes.groupBy("d").agg(F.count("*").alias("n")).where(F.col("n") > TILE).collect()]
    sums = {d: np.zeros(d * d) for d in many}
    for r in classes.where(F.col("d").isin(many)).select("v").mapInArrow(run, "d int, at int, v double").groupBy("d", "at").agg(F.sum("v").alias("v")).collect() if many else []:
        sums[r.d][r["at"]] = r.v
    return {d: np.linalg.eigh(m.reshape(d, d))[1][:, ::-1] for d, m in sums.items()}


def _along(x: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    return x @ axes[x.shape[1]] if x.shape[1] in axes else x


def _leading(classes: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """Add lead, the first BOXES coordinates of the unit vector along the axes."""
    names, shared = classes.columns, classes.sparkSession.sparkContext.broadcast(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[int, list[int]] = {}
            vectors = batch.column(names.index("v")).to_pylist()
            for i, v in enumerate(vectors):
                by.setdefault(len(v), []).append(i)
            lead = np.zeros((len(vectors), BOXES))
            for d, rows in by.items():
                lead[rows, : min(d, BOXES)] = _along(_unit([vectors[i] for i in rows]), shared.value)[:, :BOXES]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(lead), pa.list_(pa.float64()))], names=[*names, "lead"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{kinds}, lead array<double>")


def _tiled(turned: DataFrame, reach: float) -> DataFrame:
    """turned with tile: at most TILE vectors of a label and length that are next to each other in bands of the first axis, then along the second.

    Rows are sorted by ranges, so that a label of any size is dealt over many tasks; ranks are places in a partition moved by the sizes
    of those before it, a table of one row per partition.
    """
    order = ["label", "d", F.floor(F.col("lead")[0] / reach), F.col("lead")[1], "cls"]
    ranged = turned.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    ranged = materialise(ranged, "ranged")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first_at"))
    moved = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n") - F.col("first_at")).alias("moved"))
    ranked = ranged.join(F.broadcast(moved), "part").withColumn("rank", F.col("at") + F.col("moved")).drop("part", "at", "moved")
    first = _small(materialise(ranked.groupBy("label", "d").agg(F.min("rank").alias("first")), "first_ranks"))
    return ranked.join(first, ["label", "d"]).withColumn("tile", F.floor((F.col("rank") - F.col("first")) / TILE)).drop("rank", "first")


def _links_of(a: np.ndarray, b: np.ndarray, ya: np.ndarray, yb: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the rows of two tiles whose cosine reaches threshold; each pair once if the tiles are the same."""
    d, done = ya.shape[1], 0
    alive = np.triu(np.ones((len(a), len(b)), bool), 1) if same else np.ones((len(a), len(b)), bool)
    dot = np.zeros(alive.shape)
    for k in [s for s in STAGES if s < d]:
        dot += ya[:, done:k] @ yb[:, done:k].T
        done = k
        rest_a, rest_b = (np.sqrt(np.maximum(0, (y[:, k:] ** 2).sum(1))) for y in (ya, yb))
        alive &= dot + rest_a[:, None] * rest_b[None, :] >= threshold - SLACK
        if np.count_nonzero(alive) < alive.size // 50:
            break
    rows, cols = np.nonzero(alive)
    keep_a, keep_b = [], []
    some = max(1, 2_000_000 // d)
    for i in range(0, len(rows), some):  # what may still reach it: exact cosines of the vectors as given
        r, c = rows[i : i + some], cols[i : i + some]
        ok = np.einsum("ij,ij->i", a[r], b[c]) >= threshold
        keep_a.append(r[ok])
        keep_b.append(c[ok])
    return np.concatenate(keep_a or [rows[:0]]), np.concatenate(keep_b or [cols[:0]])


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Indices of links that span the components of all links (a[i], b[i])."""
    root = np.arange(int(max(a.max(), b.max())) + 1) if len(a) else np.arange(0)
    used = []
    left = np.arange(len(a))
    while len(left):
        ra, rb = root[a[left]], root[b[left]]
        left = left[ra != rb]
        if not len(left):
            break
        hi, lo = np.maximum(root[a[left]], root[b[left]]), np.minimum(root[a[left]], root[b[left]])
        order = np.lexsort((lo, hi))
        first = order[np.concatenate(([True], hi[order][1:] != hi[order][:-1]))]
        used.append(left[first])  # every root hooks once, to a lower one
        hook = np.arange(len(root))
        hook[hi[first]] = lo[first]
        while (hook[hook] != hook).any():
            hook = hook[hook]
        root = hook[root]
    return np.concatenate(used) if used else np.arange(0)


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one label link when their cosine in doubles is at least threshold; those of unlike length never do.
    Equal vectors of a label are compared once and count as often as they occur. Tiles hold a bounded number of vectors of
    a label; every pair of tiles whose boxes along the leading axes are within reach of the threshold is compared
    in a cell of its own, which gives numbers of links and a spanning forest, never the links. Null labels and vectors
    that are null, empty, zero or hold null or non-finite values link with nothing. Rows without vec_id take part, but
    name a component only if no row of it has one. Repeated rows are all returned; an empty table gives none. Extra columns are not read.
    """
    small_batches(vectors.sparkSession)
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"  # as narrow as given: vectors are shuffled
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast(f"array<{kind}>").alias("v"), F.col(f"`{label_col}`").alias("label"))
    fine = f"label is not null and {_valid('v')}"
    # Adding zero makes -0.0 and 0.0 equal; two hashes of label and values stand for the vector.
    rows = rows.select("vec_id", F.expr(f"case when {fine} then label end").alias("label"), F.expr(f"case when {fine} then transform(v, x -> x + {kind}(0)) end").alias("v"))
    hashes = [F.lpad(F.hex(F.xxhash64(F.lit(seed), "label", "v")), 16, "0") for seed in (1, 2)]
    rows = rows.withColumn("cls", F.when(F.col("v").isNotNull(), F.concat(*hashes)))
    named = materialise(rows.select("vec_id", "cls"), "vectors")
    classes = rows.where("v is not null").groupBy("cls").agg(F.count("*").alias("copies"), F.min("vec_id").alias("rep"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = materialise(classes.withColumn("d", F.size("v")), "vector_classes")
    axes = principal_axes(classes)
    shared = vectors.sparkSession.sparkContext.broadcast(axes)
    reach = (2 - 2 * (threshold - SLACK)) ** 0.5  # unit vectors of cosine t are sqrt(2 - 2t) apart
    tiled = _tiled(_leading(classes.drop("rep"), axes), reach)
    box = {f"{end}{k}": f(F.col("lead")[k]) for k in range(BOXES) for end, f in (("lo", F.min), ("hi", F.max))}
    spans = materialise(tiled.groupBy("label", "d", "tile").agg(*(c.alias(name) for name, c in box.items())), "tile_spans")
    one, two = (spans.select("label", "d", *(F.col(c).alias(f"{c}_{side}") for c in ("tile", *box))) for side in "ab")
    gaps = [F.greatest(F.lit(0.0), F.col(f"lo{k}_b") - F.col(f"hi{k}_a"), F.col(f"lo{k}_a") - F.col(f"hi{k}_b")) for k in range(BOXES)]
    near = sum((g * g for g in gaps), F.lit(0.0)) <= reach * reach
    # Tiles are put in the squares of side reach that they cover along two axes. What is within reach of a tile lies in these or the ones around them.
    squares = lambda side, more: [F.explode(F.sequence(F.floor(F.col(f"lo{k}_{side}") / reach) - more, F.floor(F.col(f"hi{k}_{side}") / reach) + more)).alias(f"at{k}") for k in (0, 1)]
    dealt_a, dealt_b = (t.select("*", squares(side, more)[0]).select("*", squares(side, more)[1]) for t, side, more in ((one, "a", 1), (two, "b", 0)))
    cells = dealt_a.join(dealt_b, ["label", "d", "at0", "at1"]).where("tile_a <= tile_b").where(near).select("label", "d", "tile_a", "tile_b").distinct()
    cells = materialise(cells, "cells")
    sides = cells.select("*", F.col("tile_a").alias("tile"), F.lit(0).alias("side")).unionByName(cells.where("tile_a != tile_b").select("*", F.col("tile_b").alias("tile"), F.lit(1).alias("side")))
    dealt = tiled.join(sides, ["label", "d", "tile"]).select("label", "d", "tile_a", "tile_b", "side", "cls", "copies", "v")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "cls"], kind="stable")
        x = _unit(pdf["v"].tolist())
        y = _along(x, shared.value)
        cls, weight = pdf["cls"].to_numpy(), pdf["copies"].to_numpy()
        cut = int((pdf["side"] == 0).sum())
        same = cut == len(pdf)
        a, b = _links_of(x[:cut], x if same else x[cut:], y[:cut], y if same else y[cut:], threshold, same)
        b = b if same else b + cut
        links = np.bincount(a, weights=weight[b], minlength=len(pdf)) + np.bincount(b, weights=weight[a], minlength=len(pdf))
        some, tree = np.flatnonzero(links), _forest(a, b)
        none = np.zeros(len(tree), np.int64)
        return pd.concat([
            pd.DataFrame({"a": cls[some], "b": None, "n": links[some].astype(np.int64)}),
            pd.DataFrame({"a": cls[a[tree]], "b": cls[b[tree]], "n": none}),
        ])

    found = materialise(dealt.groupBy("label", "d", "tile_a", "tile_b").applyInPandas(run, "a string, b string, n long"), "vector_links")
    numbers = found.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("others"))
    roots = connected_components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "cls")
    labelled = materialise(classes.select("cls", "copies", "rep").join(roots, "cls", "left").join(numbers, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "labelled")
    lowest = materialise(labelled.groupBy("root").agg(F.min("rep").alias("component_id")), "lowest")
    known = join_named(labelled, lowest, "root").select("cls", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = join_named(named, materialise(known, "known"), "cls").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
