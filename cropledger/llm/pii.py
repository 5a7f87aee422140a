"""Personal data: exact spans of known kinds, and information-theoretic sanitisation of the terms around them.

DataFrame functions only. Spans are found once and written with their rows; texts without an entity are never shuffled, and
of the others only those that hold a disclosing term.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_named, materialise

#: Patterns of the base kinds, in the order in which their spans are listed. Possessive quantifiers and
#: the look-behinds leave the leftmost non-overlapping matches as they are, but keep time linear and the stack flat.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of fewer than 16 digits never pass; asking for 16 here leaves them unlisted.
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A protected kind of the method's own. A value may have any length.
SECRET = r"(?i)\b(?:api[_-]?key|access[_-]?key|secret|password|passwd|token)\s{0,3}[=:]\s{0,3}[\"'][^\"'\s]{8,}+[\"']"
#: A word, as the method around the spans counts it.
WORD = r"[\p{L}\p{N}]+"
_SPAN = "struct<start:int,end:int,value:string>"
#: What a span is replaced by.
MASKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "secret": "<SECRET>", "term": "<TERM>"}
KINDS = [*BASE, "secret"]

#: Words on either side of a protected entity that may reveal it.
WINDOW = 4
#: Distinct contexts in which a term must stand near one entity, the least share of the term's uses in the corpus that
#: stand near that entity, and the least information about the entity in bits.
CONTEXTS, SHARE, BITS = 2, 0.5, 3.0
#: Code points on either side of an entity in which its WINDOW words are looked for, one after the other; all the text serves where they are not enough.
REACHES = (240, 8192)
#: Code points of the pieces that long texts are cut out of, and entries of an array that are folded together: neither changes a result.
PIECE, STRETCH = 1024, 256
#: Most rows of a table of entities, terms or row keys that is broadcast (about 100 bytes each); larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: No words but the first few of a text, and whether a text goes on behind them.
_NO_WORD = r"[^\p{L}\p{N}]"
_SOME_WORDS = rf"^(?:{_NO_WORD}*+{WORD}+){{0,{WINDOW}}}+"
_ENOUGH_WORDS = rf"^(?:{_NO_WORD}*+{WORD}+){{{WINDOW}}}+{_NO_WORD}"


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def _pieces(text: Column) -> Column:
    """text in pieces of PIECE code points."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}+"), F.lit(0))


def _cut(pieces: Column, a: Column, b: Column) -> Column:
    """Code points a to b (exclusive; at most the end) of the text in pieces: steps grow with b - a, not with a."""
    i, j = F.floor(a / PIECE).cast("int"), F.floor(b / PIECE).cast("int")
    head = lambda n: F.coalesce(F.substring(F.get(pieces, i), a - i * PIECE + 1, n), F.lit(""))
    tail = F.coalesce(F.substring(F.get(pieces, j), F.lit(1), b - j * PIECE), F.lit(""))
    return F.when(i == j, head(b - a)).otherwise(F.concat(head(F.lit(PIECE)), F.array_join(F.slice(pieces, i + 2, j - i - 1), ""), tail))


def _before(values: Column, zero: int, op: Callable[[Column, Column], Column]) -> Column:
    """array<int>: op over all values before each one, from zero on.

    A fold copies its state at every step, so stretches are folded apart, each from what op gives for those before it.
    """

    def grown(start: Column, more: Column) -> Column:
        return F.aggregate(more, F.array(start), lambda acc, x: F.concat(acc, F.array(op(F.element_at(acc, -1), x))))

    def joined(stretches: Column) -> Column:
        starts = grown(F.lit(zero), F.transform(stretches, lambda s: F.aggregate(s, F.lit(zero), lambda acc, x: op(acc, x))))
        return F.flatten(F.zip_with(stretches, F.slice(starts, 1, F.size(stretches)), lambda s, b: F.slice(grown(b, s), 1, F.size(s))))

    cut = lambda v: F.transform(F.sequence(F.lit(0), F.floor(F.size(v) / STRETCH).cast("int")), lambda k: F.slice(v, k * STRETCH + 1, STRETCH))
    return _let(_let(values, cut), joined)


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: F.when(d == "", 0).otherwise(d.cast("int")))
    weighed = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + d) % 10 == 0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.substring(F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))), 1, 4).cast("int") <= 255))
    if kind == "card":
        return F.length(_digits(match)).between(16, 19) & _luhn(F.substring(_digits(match), 1, 19))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def spans_of(text: Column, kind: str) -> Column:
    """array<struct<start, end, value>> of a kind in text; code points, end exclusive.

    split() and regexp_extract_all() walk the same matches, so a match starts after all gaps and matches before it.
    """
    pattern = SECRET if kind == "secret" else BASE[kind]
    hint = {"email": F.contains(text, F.lit("@")), "ip": F.contains(text, F.lit(".")), "phone": F.contains(text, F.lit("+")), "secret": F.contains(text, F.lit("\"")) | F.contains(text, F.lit("'"))}.get(kind, F.lit(True))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    return F.when(hint & F.regexp_like(text, F.lit(pattern)), F.filter(_placed(found, gaps), lambda s: _passes(kind, s["value"]))).otherwise(_no_spans())


def _no_spans() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


def _placed(found: Column, gaps: Column) -> Column:
    """array<struct<start, end, value>> of the matches found, each gap standing before its match."""
    pairs = F.zip_with(found, F.slice(gaps, 1, F.greatest(F.size(found), F.lit(1))), lambda m, g: F.struct(m.alias("m"), g.alias("g"), F.length(m).alias("n")))

    def spans(pairs: Column) -> Column:
        at = _before(F.transform(pairs, lambda p: p["g"] + p["n"]), 0, lambda a, x: a + x)
        return F.zip_with(pairs, at, lambda p, a: F.struct((a + p["g"]).alias("start"), (a + p["g"] + p["n"]).alias("end"), p["m"].alias("value")))

    return _let(F.filter(pairs, lambda p: p["m"].isNotNull()), spans)


def _listed(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def _entities(kind: str) -> Column:
    return F.transform(F.col(kind), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit(f"{kind}:"), F.lower(s["value"])).alias("entity")))


def _with_kind(kind: str) -> Column:
    return F.transform(F.array_sort(F.col(kind)), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, copy: a hash of the text, whole: a struct of docs' columns, and one array of spans per kind of KINDS).

    A null text is an empty one; repeated rows give repeated results; an empty table gives no rows; texts are searched whole.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), whole.alias("whole")).select("doc_id", "text", F.sha2("text", 256).alias("copy"), "whole", *(spans_of(F.col("text"), k).alias(k) for k in KINDS))


def _near(pieces: Column, start: Column, end: Column) -> Column:
    """array<struct<at, term>>: the WINDOW words before start and after end in lower case, with their code points in the text in pieces."""

    def walked(reached: Callable[[int | None], Column], placed: Callable[[Column, Column], Column]) -> Column:
        """placed(words, gaps) of the first WINDOW words of reached(n), the text as far as n code points, or all of it."""
        part = reached(None)
        for reach in reversed(REACHES):
            part = F.when(F.regexp_like(reached(reach), F.lit(_ENOUGH_WORDS)), reached(reach)).otherwise(part)
        split = lambda t: F.struct(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("words"), F.transform(F.split(t, WORD, -1), F.length).alias("gaps"))
        return _let(_let(F.regexp_extract(part, _SOME_WORDS, 0), split), lambda s: placed(s["words"], s["gaps"]))

    def total(lengths: Column) -> Column:
        return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)

    def passed(words: Column, gaps: Column, n: Column, more: Column | int) -> Column:
        """Code points of the first n gaps and n + more words."""
        return total(F.slice(gaps, 1, n)) + total(F.transform(F.slice(words, 1, n + more), F.length))

    # Before the entity the text is read backwards.
    back = lambda n: F.reverse(_cut(pieces, F.greatest(start - n, F.lit(0)) if n else F.lit(0), start))
    on = lambda n: _cut(pieces, end, end + n if n else F.size(pieces) * PIECE)
    before = walked(back, lambda words, gaps: F.transform(words, lambda w, i: F.struct((start - passed(words, gaps, i + 1, 0)).alias("at"), F.lower(F.reverse(w)).alias("term"))))
    after = walked(on, lambda words, gaps: F.transform(words, lambda w, i: F.struct((end + passed(words, gaps, i + 1, -1)).alias("at"), F.lower(w).alias("term"))))
    return F.concat(F.reverse(before), after)


def disclosing_terms(found: DataFrame, contexts: int = CONTEXTS, share: float = SHARE, bits: float = BITS) -> DataFrame:
    """(entity, term): terms that give an entity away. found: find()'s rows.

    A use of a term is near an entity if it is one of the WINDOW words on either side. Everything is counted over distinct texts, so
    copies of a text change nothing, and a term must stand near the entity in several distinct contexts. For a term
    t near an entity e, share = uses of t near e / uses of t estimates how surely t tells of e, and bits =
    log2(share / (texts with e / texts)) what is learned from it. An entity in so many texts that no share could tell bits
    of it has no such terms and is left out at once. Only terms that come into question are counted in all texts.
    """
    entities = F.concat(*map(_entities, KINDS))
    around = _let(_pieces(F.col("text")), lambda ps: F.transform(entities, lambda e: F.struct(e["entity"].alias("entity"), _near(ps, e["start"], e["end"]).alias("near"))))
    held = found.where(F.greatest(*(F.size(k) for k in KINDS)) > 0).select("copy", F.explode(around).alias("e"))
    windows = materialise(held.select("copy", "e.entity", "e.near").distinct(), "contexts")
    texts = found.select("copy").distinct().count()
    held_in = windows.select("copy", "entity").distinct().groupBy("entity").agg(F.count("*").alias("of_entity"))
    told_of = _small(materialise(held_in.where(F.col("of_entity") * 2.0**bits <= texts), "entities"))
    terms = windows.join(told_of, "entity").select("entity", "of_entity", "copy", F.xxhash64(F.transform("near", lambda w: w["term"])).alias("context"), F.explode("near").alias("w"))
    terms = terms.select("entity", "of_entity", F.col("w.term").alias("term"), "context", F.struct("copy", "w.at").alias("use"))
    repeated = terms.groupBy("entity", "term").agg(F.first("of_entity").alias("of_entity"), F.count_distinct("context").alias("n"), F.count_distinct("use").alias("near_uses")).where(F.col("n") >= contexts)
    repeated = materialise(repeated, "repeated_terms")
    if repeated.isEmpty():
        return repeated.select("entity", "term")
    # Copies of a text hold a term equally often as it does, so each of n copies counts an n-th; tasks add up before the shuffle.
    copies = materialise(found.groupBy("copy").agg(F.count("*").alias("n")).where("n > 1"), "copies")
    texts_of = join_named(found.select("copy", "text"), copies, "copy").select("text", (1 / F.coalesce("n", F.lit(1))).alias("part"))
    words = texts_of.select("part", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))).alias("term"))
    asked = materialise(repeated.select("term").distinct(), "asked_terms")
    words = words.join(F.broadcast(asked), "term", "left_semi") if asked.count() <= BROADCAST_ROWS else words
    uses = words.groupBy("term").agg(F.round(F.sum("part")).alias("uses"))
    p = F.least(F.col("near_uses") / F.col("uses"), F.lit(1.0))
    told = F.log2(p / (F.col("of_entity") / F.lit(float(texts))))
    return repeated.join(uses, "term").where((p >= share) & (told >= bits)).select("entity", "term")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text, whole (a struct of docs' columns), an array of spans per kind and of terms, all_spans, clean_text.

    all_spans lists every span as (start, end, kind), by kind, then start. clean_text has each span replaced by its
    kind's mask; where spans overlap, the one that starts first (then the longer) takes the whole stretch. Terms that
    disclose an entity are masked in the documents that hold the entity; other documents are left as they are, letter
    for letter. Null texts are empty ones; repeated rows give repeated results; an empty table gives none; texts of any
    length are read whole; extra columns, whatever their names, are only handed on in whole.
    """
    found = materialise(find(docs, id_col, text_col).drop("text"), "spans").withColumn("text", F.coalesce(F.col(f"whole.`{text_col}`"), F.lit("")))
    pairs = materialise(disclosing_terms(found), "disclosing")
    rows = found.withColumn("term", _no_spans()) if pairs.isEmpty() else _with_terms(found, pairs)
    rows = rows.withColumn("all_spans", F.concat(*map(_with_kind, [*KINDS, "term"]))).drop("copy")
    return rows.withColumn("clean_text", _masked(F.col("text"), F.col("all_spans")))


def _with_terms(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add the spans of disclosing terms: a text's entities give its terms, its words are then matched with them."""
    kinds = F.concat(*map(_entities, KINDS))
    any_entity = F.greatest(*(F.size(k) for k in KINDS)) > 0
    held = found.where(any_entity).select("copy", F.explode(F.array_distinct(F.transform(kinds, lambda e: e["entity"]))).alias("entity"))
    terms = _small(materialise(held.distinct().join(_small(pairs), "entity").groupBy("copy").agg(F.collect_set("term").alias("terms")), "terms_of_texts"))
    words, gaps = F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.transform(F.split("text", WORD, -1), F.length)
    walked = F.filter(_placed(words, gaps), lambda s: F.array_contains(F.col("terms"), F.lower(s["value"])))
    joined = found.where(any_entity).join(terms, "copy", "left")
    joined = joined.withColumn("term", F.when(F.col("terms").isNotNull(), _apart(walked, F.concat(*(F.col(k) for k in KINDS)))).otherwise(_no_spans())).drop("terms")
    return joined.unionByName(found.where(~any_entity).withColumn("term", _no_spans()))


def _apart(spans: Column, taken: Column) -> Column:
    """Those of spans, which don't overlap each other, that overlap none of taken, in order."""
    far = 2**31 - 1
    # Others that start no later reach as far as their largest end; others that start later, as near as their least start.
    marked = lambda a, own: F.transform(a, lambda s: F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s["end"].alias("end"), s["value"].alias("value")))

    def left(all_spans: Column) -> Column:
        reach = _before(F.transform(all_spans, lambda s: F.when(s["own"], 0).otherwise(s["end"])), 0, F.greatest)
        after = F.reverse(_before(F.transform(F.reverse(all_spans), lambda s: F.when(s["own"], far).otherwise(s["start"])), far, F.least))
        edges = F.zip_with(reach, after, lambda r, a: F.struct(r.alias("reach"), a.alias("after")))
        clear = F.zip_with(all_spans, edges, lambda s, e: F.when(s["own"] & (e["reach"] <= s["start"]) & (s["end"] <= e["after"]), F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))))
        return F.filter(clear, lambda s: s.isNotNull())

    return _let(F.array_sort(F.concat(marked(spans, True), marked(taken, False))), left)


def _masked(text: Column, spans: Column) -> Column:
    """text with every span replaced by its kind's mask, from left to right."""
    masks = F.create_map(*(F.lit(x) for kv in MASKS.items() for x in kv))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), s["kind"].alias("kind"))))

    def done(both: Column) -> Column:
        pieces, cuts = both["pieces"], both["ordered"]
        ends = F.transform(cuts, lambda s: -s["less"])
        parts = F.zip_with(cuts, _before(ends, 0, F.greatest), lambda s, at: F.when(s["start"] >= at, F.concat(_cut(pieces, at, s["start"]), masks[s["kind"]])).otherwise(""))
        return F.concat(F.array_join(parts, ""), _cut(pieces, F.array_max(ends), F.size(pieces) * PIECE))

    return F.when(F.size(spans) > 0, _let(F.struct(_pieces(text).alias("pieces"), ordered.alias("ordered")), done)).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """Counts and the canonical lists of sanitise()'s spans."""
    base = F.concat_ws(",", F.concat(*(_listed(F.col(k), k) for k in BASE)))
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("all_spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))).alias("spans"),
    )
