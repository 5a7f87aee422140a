"""Language of every word, and of the text, by a linear-chain conditional random field.

Word features are character n-grams of the word between boundary marks (those with a mark are its affixes) and the
word itself (the lexicon); transitions between the languages of neighbouring words are learned with them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches

#: Labelled documents that the model is fitted on in all, the fewest of a language (all of them where it has fewer), and
#: the same for the runs of RUN words into which their whole texts are cut; both are drawn by hashes, language by language.
#: These bound what the driver holds: RUNS + LEAST_RUNS * languages runs of words, whatever the input.
SAMPLE, LEAST, RUNS, LEAST_RUNS = 3000, 100, 20_000, 1000
#: Hashed features, longest n-gram, rounds of training, words of a training sequence and of its one-language stretches.
SLOTS, LONGEST, ROUNDS, SEQUENCE, RUN = 1 << 16, 4, 45, 96, 24
#: Words whose scores a Python worker remembers, and words that are labelled side by side.
REMEMBERED, TOGETHER = 400_000, 400_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters of the whole text, in lower case; empty if it has no letter."""
    found = _WORD.findall((text or "").lower())
    return found if any(any(map(str.isalpha, w)) for w in found) else []


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, slot) of every feature of the words, all words at once."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    of = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    mixed, at, slot = np.zeros(len(code), np.uint64), [], []
    for n in range(1, LONGEST + 1):
        m = len(code) - n + 1
        if m <= 0:
            break
        mixed = (mixed[:m] + code[n - 1 :] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        inside = of[:m] == of[n - 1 :]
        at.append(of[:m][inside])
        slot.append((mixed[inside] >> np.uint64(40)) % np.uint64(SLOTS))
    # The word itself: a sum of its mixed codes by position.
    place = np.arange(len(code)) - np.repeat(np.cumsum([0, *(len(w) + 2 for w in words[:-1])]), [len(w) + 2 for w in words])
    hashed = (code + np.uint64(7)) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    hashed ^= hashed >> np.uint64(32)
    starts = np.flatnonzero(place == 0)
    at.append(np.arange(len(words)))
    slot.append((np.add.reduceat(hashed, starts) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(SLOTS))
    return np.concatenate(at), np.concatenate(slot).astype(np.int64)


def _emissions(model: dict, words: list[str]) -> np.ndarray:
    at, slot = _features(words)
    w = model["weights"]
    count = np.bincount(at, minlength=len(words))[:, None]
    return np.stack([np.bincount(at, weights=w[slot, j], minlength=len(words)) for j in range(w.shape[1])], 1) / np.sqrt(count)


def _forward_backward(e: np.ndarray, start: np.ndarray, size: np.ndarray, trans: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all words (rows of e, a sequence is start : start + size) and the sum of the pair marginals.

    Step t handles word t of every sequence that has one; start and size are sorted by falling size.
    """
    p = np.exp(e - e.max(1, keepdims=True))
    a, f = np.exp(trans), np.exp(first)
    alpha, scale = np.empty_like(p), np.empty(len(p))
    longest = int(size.max(initial=0))
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    now = np.zeros((0, p.shape[1]))
    for t in range(longest):
        at = start[: active[t]] + t
        now = p[at] * (f if t == 0 else now[: active[t]] @ a)
        total = now.sum(1)
        now /= total[:, None]
        alpha[at], scale[at] = now, total
    marginal, pairs = np.empty_like(p), np.zeros_like(a)
    beta = np.ones((0, p.shape[1]))
    for t in range(longest - 1, -1, -1):
        at = start[: active[t]] + t
        grown = np.ones((active[t], p.shape[1]))
        if len(beta):
            after = at[: len(beta)] + 1
            ahead = p[after] * beta / scale[after][:, None]
            pairs += a * (alpha[at[: len(beta)]].T @ ahead)
            grown[: len(beta)] = ahead @ a.T
        beta = grown
        marginal[at] = alpha[at] * beta
    return marginal / marginal.sum(1, keepdims=True), pairs


def fit(texts: list[tuple[str, str]]) -> dict:
    """Fit on (text, language) pairs by full-batch gradients with Adagrad steps.

    Training sequences switch language every RUN words, so that transitions are learned from code-switched text.
    """
    languages = sorted({lang for _, lang in texts})
    model: dict = {"languages": languages}
    runs = []
    for text, lang in texts:
        found, label = words_of(text), languages.index(lang)
        runs += [(found[i : i + RUN], label) for i in range(0, len(found), RUN)]
    if not runs:
        return {"languages": []}
    rng = np.random.default_rng(7)
    runs = [runs[i] for i in rng.permutation(len(runs))]
    per = SEQUENCE // RUN
    sequences = [[(w, y) for r, y in runs[i : i + per] for w in r] for i in range(0, len(runs), per)]
    sequences.sort(key=len, reverse=True)
    flat = [x for s in sequences for x in s]
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for w, _ in flat))}
    ids, gold = np.array([vocabulary[w] for w, _ in flat]), np.array([y for _, y in flat])
    size = np.array([len(s) for s in sequences])
    start = np.cumsum(size) - size
    at, slot = _features(list(vocabulary))
    scale = 1 / np.sqrt(np.bincount(at, minlength=len(vocabulary)))
    k = len(languages)
    weights, trans, first = np.zeros((SLOTS, k)), np.zeros((k, k)), np.zeros(k)
    gold_pairs = np.zeros((k, k))
    inner = np.ones(len(flat), bool)
    inner[start] = False
    np.add.at(gold_pairs, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
    gold_first = np.bincount(gold[start], minlength=k)
    seen = [np.full_like(x, 1e-3) for x in (weights, trans, first)]
    one = np.zeros((len(flat), k))
    one[np.arange(len(flat)), gold] = 1
    for _ in range(ROUNDS):
        e = np.stack([np.bincount(at, weights=weights[slot, j], minlength=len(vocabulary)) for j in range(k)], 1) * scale[:, None]
        marginal, pairs = _forward_backward(e[ids], start, size, trans, first)
        wrong = one - marginal
        by_word = np.stack([np.bincount(ids, weights=wrong[:, j], minlength=len(vocabulary)) for j in range(k)], 1) * scale[:, None]
        steps = (
            np.stack([np.bincount(slot, weights=by_word[at, j], minlength=SLOTS) for j in range(k)], 1) - 0.05 * weights,
            gold_pairs - pairs - 0.05 * trans,
            gold_first - marginal[start].sum(0) - 0.05 * first,
        )
        for x, g, s in zip((weights, trans, first), steps, seen):
            s += g * g
            x += 0.5 * g / np.sqrt(s)
    return model | {"weights": weights.astype(np.float32), "trans": trans, "first": first}


def label_texts(model: dict, texts: list[list[str]], known: dict[str, int], scores: list[np.ndarray]) -> list[np.ndarray]:
    """Marginals (words by languages) of each list of words. known and scores remember emissions of words."""
    if not any(texts):
        return [np.zeros((0, len(model["languages"])))] * len(texts)
    fresh = list({w for t in texts for w in t}.difference(known))
    if len(known) + len(fresh) > REMEMBERED:
        known.clear()
        scores[:] = [np.zeros((0, len(model["languages"])))]
        fresh = list({w for t in texts for w in t})
    if fresh:
        known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
        scores[0] = np.concatenate([scores[0], *(_emissions(model, fresh[i : i + 20_000]) for i in range(0, len(fresh), 20_000))])
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    size = np.array([len(texts[i]) for i in order])
    ids = np.fromiter((known[w] for i in order for w in texts[i]), np.int64, int(size.sum()))
    start = np.cumsum(size) - size
    marginal, _ = _forward_backward(scores[0][ids], start, size, model["trans"], model["first"])
    out: list[np.ndarray] = [marginal[:0]] * len(texts)
    for i, s, n in zip(order, start, size):
        out[i] = marginal[s : s + n]
    return out


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, n_words, switches) of every whole text.

    lang_pred is the language with the largest mean marginal over all words, score that mean, switches the places
    where the likeliest language of neighbouring words differs. Texts without a letter, and all texts if no language
    was learned, are und with score 0.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS weights for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        languages = own["languages"]
        known: dict[str, int] = {}
        scores = [np.zeros((0, len(languages)))]
        for batch in batches:
            texts = [words_of(t) if languages else [] for t in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                end, total = at, 0
                while end < len(texts) and (end == at or total + len(texts[end]) <= TOGETHER):
                    total += len(texts[end])
                    end += 1
                lang, score, switches = [], [], []
                for m in label_texts(own, texts[at:end], known, scores):
                    mean = m.mean(0) if len(m) else None
                    lang.append("und" if mean is None else languages[int(mean.argmax())])
                    score.append(0.0 if mean is None else float(min(1.0, mean.max())))
                    best = m.argmax(1) if len(m) else np.zeros(0)
                    switches.append(int((best[1:] != best[:-1]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array([len(t) for t in texts[at:end]], pa.int64()), pa.array(switches, pa.int64())],
                    names=["doc_id", "lang_pred", "score", "n_words", "switches"],
                )
                at = end

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double, n_words long, switches long")


def _drawn(rows: DataFrame, number: int, least: int, key: Column) -> DataFrame:
    """About max(number / languages, least) rows of each lang, chosen by a hash of key; all rows of a lang that has fewer."""
    counts = rows.groupBy("lang").agg(F.count("*").alias("_n")).collect()  # a row per language
    each = max(number / max(1, len(counts)), least)
    rates = rows.sparkSession.createDataFrame([(r.lang, int(2**31 * min(1.0, each / r["_n"]))) for r in counts], "lang string, _rate long")
    return rows.join(F.broadcast(rates), "lang").where(F.pmod(key, F.lit(2**31)) < F.col("_rate")).drop("_rate")


def training_runs(labelled: DataFrame) -> DataFrame:
    """(lang, text): runs of RUN words of labelled (doc_id, text, lang), about RUNS in all and LEAST_RUNS of a language at least."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, lang in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = words_of(text)
                runs = [" ".join(words[i : i + RUN]) for i in range(0, len(words), RUN)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(runs), pa.string()), pa.array(runs, pa.string()), pa.array([key] * len(runs), pa.int64()), pa.array(range(len(runs)), pa.int64())], names=["lang", "text", "key", "at"])

    chosen = _drawn(labelled, SAMPLE, LEAST, F.xxhash64("doc_id", F.lit(0))).select(F.xxhash64("doc_id", "text").alias("key"), "text", "lang")
    runs = materialise(chosen.mapInArrow(cut, "lang string, text string, key long, at long"), "training_runs")
    return _drawn(runs, RUNS, LEAST_RUNS, F.xxhash64("key", "at")).select("lang", "text")


def identify(docs: DataFrame, held_out: int = 3) -> DataFrame:
    """One row per document: doc_id, held_out (crc32 of the id leaves 1 by held_out), lang_pred, score and more.

    Learns from a sample of runs of words of labelled documents that are not held out, see training_runs(); a language
    with a single labelled document is learned too. Rows without doc_id are not learned from and not held out; repeated rows
    are labelled alike; of languages that tie the first by name is told; null and wordless texts are und; texts of any length are labelled whole; an empty table gives no
    rows, and one without labelled documents und for all. Extra columns are not read, whatever their names.
    """
    small_batches(docs.sparkSession)
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % held_out == 1, F.lit(False))
    labelled = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~out).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sample = training_runs(labelled).orderBy("lang", "text").collect()  # in one order, so that equal tables give equal models
    return predict(docs, fit([(r.text, r.lang) for r in sample])).select("doc_id", out.alias("held_out"), "lang_pred", "score", "n_words", "switches")
