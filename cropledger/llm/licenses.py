"""License scan: Aho-Corasick over tags and notice phrases, and a shunting-yard reader of licence expressions."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: The base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notice phrases, in words.
NOTICE_PHRASES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "isc license": "isc",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "all rights reserved": "proprietary",
    "public domain": "public-domain",
}
#: Tags that precede a licence expression.
TAGS = ("spdx-license-identifier:", "license-expression:")
#: How freely text under a label may be used, 1 is most freely; other labels get UNKNOWN.
FREEDOM = {"public-domain": 1.0, "cc0": 1.0, "mit": 1.0, "isc": 1.0, "bsd": 1.0, "apache": 0.95, "cc-by": 0.9, "mpl": 0.6, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl": 0.3, "agpl": 0.2, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "proprietary": 0.0}
UNKNOWN = 0.4

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_TOKEN = re.compile(r"[a-z0-9][a-z0-9.+-]*|[()]|\S")
_LINE_END = re.compile(r"[\r\n]")
_BINDS = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str:
    """The label of a licence identifier: its family, else the identifier itself."""
    return next((x for x in sorted(FREEDOM, key=len, reverse=True) if identifier == x or identifier.startswith((f"{x}-", f"{x}+"))), identifier)


def read_expression(text: str) -> tuple[list[str], float] | None:
    """Labels and freedom of a lower-case licence expression, by Dijkstra's shunting yard; None if it is not one.

    or takes the freer side, and the stricter one; with (an exception) halves the distance to full freedom.
    """
    output: list[tuple[list[str], float]] = []
    waiting: list[str] = []

    def reduce() -> None:
        op = waiting.pop()
        (right, y), (left, x) = output.pop(), output.pop()
        output.append((left, (1 + x) / 2) if op == "with" else (left + right, (max if op == "or" else min)(x, y)))

    operand = True
    for found in _TOKEN.finditer(text):
        token = found.group()
        if token == "(" and operand:
            waiting.append(token)
        elif token == ")" and not operand and "(" in waiting:
            while waiting[-1] != "(":
                reduce()
            waiting.pop()
        elif token in _BINDS and not operand:
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[token]:
                reduce()
            waiting.append(token)
            operand = True
        elif operand and token not in _BINDS and token[0].isascii() and token[0].isalnum():
            label = label_of(token)
            output.append(([label], FREEDOM.get(label, UNKNOWN)))
            operand = False
        elif not operand and "(" not in waiting:
            break  # what follows the expression on its line
        else:
            return None
    if operand or "(" in waiting:
        return None
    while waiting:
        reduce()
    return output[0]


@functools.cache
def _automata():
    import ahocorasick

    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in {**NOTICE_PHRASES, **BASE_PHRASES}.items():
        phrases.add_word(f" {phrase} ", (phrase.count(" ") + 1, label, phrase in BASE_PHRASES))
    for tag in TAGS:
        tags.add_word(tag, tag)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def scan_text(raw: bytes) -> dict:
    """What one UTF-8 text holds: word count, places as (first word, label, base), tagged expressions."""
    phrases, tags = _automata()
    words = raw.translate(_WORDS).split()
    hay = (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""
    places, spaces, done = [], 0, 0
    for end, (size, label, base) in phrases.iter(hay):
        spaces += hay.count(" ", done, end + 1)
        done = end + 1
        places.append((spaces - 1 - size, label, base))
    expressions = []
    if b":" in raw:
        lowered = raw.translate(_LOWER).decode("latin-1")
        tagged = [(end + 1 - len(tag), end + 1) for end, tag in tags.iter(lowered)]
        # An expression ends with its line, or where the next tag stands: each character is read once, however long the line.
        for (_, at), (stop, _) in zip(tagged, [*tagged[1:], (len(lowered), 0)]):
            line_end = _LINE_END.search(lowered, at, stop)
            line = lowered[at : line_end.start() if line_end else stop].encode("latin-1").decode("utf-8", "replace")
            if found := read_expression(line):
                expressions.append((line.strip(), *found))
    return {"n_words": len(words), "places": places, "expressions": expressions}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, places, expressions, n_base, first_word, last_word, base_labels, labels, score.

    places: array of (word, label, base) in text order of their ends; expressions: array of (expression, labels,
    freedom). score is the freedom of the strictest thing found: a phrase's label or a tagged expression; 0
    without any. A null text is an empty one. Rows are independent; repeated rows give repeated results, an empty table gives none, and texts
    of any length are read whole. Phrases that overlap or tie in place are each a place. Further columns are not read, whatever their names.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    place = pa.struct([("word", pa.int64()), ("label", pa.string()), ("base", pa.bool_())])
    expression = pa.struct([("expression", pa.string()), ("labels", pa.list_(pa.string())), ("freedom", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan_text(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
            out: list[list] = [[] for _ in range(6)]
            for x in found:
                base = [p for p in x["places"] if p[2]]
                worth = [FREEDOM[p[1]] for p in x["places"]] + [e[2] for e in x["expressions"]]
                labels = {p[1] for p in x["places"]} | {y for e in x["expressions"] for y in e[1]}
                for column, value in zip(out, (len(base), min((p[0] for p in base), default=None), max((p[0] for p in base), default=None), ",".join(sorted({p[1] for p in base})), ",".join(sorted(labels)), min(worth, default=0.0))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x["n_words"] for x in found], pa.int64()),
                    pa.array([[dict(zip(("word", "label", "base"), p)) for p in x["places"]] for x in found], pa.list_(place)),
                    pa.array([[dict(zip(("expression", "labels", "freedom"), e)) for e in x["expressions"]] for x in found], pa.list_(expression)),
                    *(pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()))),
                ],
                names=["doc_id", "n_words", "places", "expressions", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run,
        f"doc_id {id_type}, n_words long, places array<struct<word:long,label:string,base:boolean>>, expressions array<struct<expression:string,labels:array<string>,freedom:double>>, "
        "n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )
