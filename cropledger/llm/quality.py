"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches

#: Share of the pooled covariance in each class's covariance, and of the pooled variances on its diagonal.
POOLED, RIDGE = 0.1, 0.02
#: Most ids of labelled rows that are broadcast (some 30 bytes each); more are joined by a shuffle.
LABELS_BROADCAST = 500_000
FEATURES = ("length", "upper", "symbols", "marks", "digits", "spaces", "breaks", "word_length", "variety", "repeated_lines", "plain_ends", "entropy", "sentences", "commonest", "short_words", "shouted")

# Classes of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 line break, 6 sentence mark, 7 symbol, 8 not ASCII.
_CLASS = np.zeros(256, np.int64)
for _name, _code in ((b"abcdefghijklmnopqrstuvwxyz", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), (b"0123456789", 3), (b" \t", 4), (b"\r\n", 5), (b".,;:?'\"-()", 6), (b"!#$%&*+/<=>@[\\]^_`{|}~", 7)):
    _CLASS[list(_name)] = _code
_CLASS[128:] = 8


def statistics(raw: bytes) -> list[float]:
    """The transformed statistics of one UTF-8 text; shares are taken to log odds, sizes to logs."""
    n = len(raw)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    by = np.bincount(_CLASS, weights=counts, minlength=9)
    seen = Counter(words)
    k = max(1, len(words))

    def odds(x: float, of: float, prior: float = 0.01, weight: float = 2.0) -> float:
        """Log odds of a share, drawn towards prior while there is little text."""
        p = (x + weight * prior) / (of + weight)
        return float(np.log(p / (1 - p)))

    p = counts[counts > 0] / max(1, n)
    letters = by[1] + by[2] + by[8]
    return [
        float(np.log1p(n)),
        odds(by[2], letters, 0.03),
        odds(by[7], n, 0.001),
        odds(by[6], n, 0.02),
        odds(by[3], n, 0.001),
        odds(by[4], n, 0.15),
        odds(by[5], n, 0.005),
        float(np.log((n - by[4] - by[5] + 12) / (k + 2))),
        float(np.log((len(seen) + 2) / (k + 2)) / np.log(k + 10)),
        odds(len(lines) - len(set(lines)), len(lines), 0.01, 4.0),
        odds(sum(not (65 <= w[-1] <= 90 or 97 <= w[-1] <= 122 or w[-1] >= 128 or w[-1] in b".,") for w in words), k, 0.005),
        float((-n * (p * np.log(p)).sum() + 40 * 2.9) / (n + 40)),
        odds(sum(w[-1] == 46 for w in words), k, 0.1),
        odds(max(seen.values(), default=0), k, 0.05, 8.0),
        odds(sum(len(w) <= 3 for w in words), k, 0.4),
        odds(sum(len(w) > 1 and w.isupper() for w in words), k, 0.005),
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every whole text, written to the scratch folder. A null text is an empty one."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    small_batches(docs.sparkSession)
    return materialise(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, x array<double>"), "statistics")


def fit(labelled: DataFrame) -> dict:
    """Fit on all rows of (x, label 0/1). Tasks send sums of x and of its products by class; the driver sees 2 rows of them.

    With one class or none there is nothing to tell apart: the model then scores every text by the prior, (n1 + 1) / (n + 2).
    """
    d = len(FEATURES)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(-1, d)
            label = np.asarray(batch.column(1))
            for c in (0, 1):
                own = x[label == c]
                total[c] += np.concatenate(([len(own)], own.sum(0), (own.T @ own).ravel()))
        at = np.arange(total.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], len(at)), pa.int32()), pa.array(np.tile(at, 2), pa.int32()), pa.array(total.ravel())], names=["label", "at", "v"])

    rows = labelled.select("x", F.col("label").cast("int").alias("label")).where("label in (0, 1)").mapInArrow(sums, "label int, at int, v double").groupBy("label", "at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((2, 1 + d + d * d))
    for r in rows:
        total[r.label, r.at] = r.v
    n = total[:, 0]
    model: dict = {"prior": float((n[1] + 1) / (n.sum() + 2))}
    if n.min() < 2:
        return model
    mean = total[:, 1 : 1 + d] / n[:, None]
    scatter = total[:, 1 + d :].reshape(2, d, d) - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
    pooled = scatter.sum(0) / n.sum()
    floor = np.diag(np.maximum(np.diag(pooled), 1e-6))
    model["mean"], model["factor"] = mean, []
    for c in (0, 1):
        cov = (1 - POOLED) * scatter[c] / n[c] + POOLED * pooled + RIDGE * floor
        model["factor"].append(np.linalg.cholesky(cov))
    model["log_prior"] = float(np.log((n[1] + 1) / (n[0] + 1)))
    return model


def score_array(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 from the difference of the two Mahalanobis log densities; the model keeps the Cholesky factors."""
    if "factor" not in model:
        return np.full(len(x), model["prior"])
    log = []
    for mean, factor in zip(model["mean"], model["factor"]):
        z = (x - mean).T
        for i, row in enumerate(factor):  # forward substitution
            z[i] = (z[i] - row[:i] @ z[:i]) / row[i]
        log.append(-0.5 * (z * z).sum(0) - np.log(np.diag(factor)).sum())
    return 1 / (1 + np.exp(-np.clip(log[1] - log[0] + model["log_prior"], -60, 60)))


def score(stats: DataFrame, model: dict) -> DataFrame:
    """stats with a column score."""
    names = stats.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(names.index("x")).to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score_array(model, x))], names=[*names, "score"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema)
    return stats.mapInArrow(run, f"{kinds}, score double")


def accept(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """docs without the rows that are scored below threshold, columns as they were.

    The model is fitted on all labelled rows; each text is then scored where it is read, so no text is shuffled. A null text is
    an empty one; repeated rows go or stay together; without labels of both kinds all texts get one score, the prior; an empty
    table gives no rows. Texts are read whole, columns may have any names.
    """
    known = labels.select("doc_id", F.col("quality").alias("label")).where("label in (0, 1) and doc_id is not null")
    ids = known.select("doc_id").distinct()
    few = F.broadcast(ids) if ids.count() <= LABELS_BROADCAST else ids
    model = fit(features(docs.join(few, "doc_id", "left_semi")).join(known, "doc_id").select("x", "label"))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t or b"") for t in batch.column(at).cast(pa.binary()).to_pylist()], float).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(score_array(model, x) >= threshold))

    small_batches(docs.sparkSession)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # mapInArrow reads no names with dots
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def classify(docs: DataFrame, labels: DataFrame, held_out: int = 5, threshold: float = 0.3) -> DataFrame:
    """One row per row of docs: doc_id, held_out (crc32 of the id is a multiple of held_out), score, predicted.

    Learns quality from all labelled rows that are not held out; a doc_id with several labels counts once for each,
    labels that are null or not 0/1 and rows without doc_id are not learned from (held_out is then false). A null text is
    an empty one, texts are read whole, repeated rows are scored alike, an empty table gives no rows, and without labels of
    both kinds all scores are the prior. Extra columns are not read, whatever their names.
    """
    stats = features(docs)
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % held_out == 0, F.lit(False))
    known = labels.select("doc_id", F.col("quality").alias("label")).where("label in (0, 1)")
    model = fit(stats.where(~out).join(known, "doc_id").select("x", "label"))
    return score(stats, model).select("doc_id", out.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
