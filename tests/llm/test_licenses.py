import random
import re

from brute import SMALL

from cropledger.llm import licenses, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall((text or "").translate(SMALL))
    places = []
    for phrase, label in licenses.BASE_PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
    starts = [p for p, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def compare(rows, docs):
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    compare(queries.op9_licenses(spark, sf).collect(), docs)


def test_edges(spark):
    docs = dict(enumerate([None, "", "MIT License", "mit\nlicense mit-license MIT license", "the General Public License", "mit mit license license", "é apache license 2.0", "x " * 30000 + "mit license", "SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0"]))
    df = spark.createDataFrame([(i, t, "l") for i, t in docs.items()], "doc_id long, text string, labels string")
    rows = licenses.scan(df).collect()
    compare(rows, docs)
    assert rows[8].labels == "apache,gpl,mit" and rows[8].score == 0.95
    assert licenses.scan(df.limit(0)).collect() == []


def test_expressions():
    assert licenses.read_expression("mit") == (["mit"], 1.0)
    assert licenses.read_expression("gpl-2.0 or mit and apache-2.0") == (["gpl", "mit", "apache"], 0.95)
    assert licenses.read_expression("(gpl-2.0 or mit) and cc-by-nc-4.0")[1] == 0.1
    assert licenses.read_expression("gpl-2.0-or-later with classpath-exception-2.0")[1] == 0.65
    for bad in ("", "or mit", "(mit", "mit or", "and", "été"):
        assert licenses.read_expression(bad) is None


def test_long_expressions_are_read_whole():
    long = b"SPDX-License-Identifier: " + b"(MIT) OR " * 400 + b"GPL-2.0-only"
    assert licenses.scan_text(long)["expressions"][0][1:] == (["mit"] * 400 + ["gpl"], 1.0)
    two = licenses.scan_text("SPDX-License-Identifier: MIT license-expression: (CC0-1.0) ünd\nGPL".encode())["expressions"]
    assert [e[1] for e in two] == [["mit"], ["cc0"]] and two[1][0] == "(cc0-1.0) ünd"


def plain_expression(text):
    """(labels, freedom) by recursive descent: or binds least, then and, then with."""
    tokens, at = licenses._TOKEN.findall(text), 0

    def operand():
        nonlocal at
        token = tokens[at] if at < len(tokens) else ""
        at += 1
        if token == "(":
            value = either()
            if at >= len(tokens) or tokens[at] != ")":
                raise ValueError
            at += 1
            return value
        if token in ("", "or", "and", "with") or not (token[0].isascii() and token[0].isalnum()):
            raise ValueError
        label = licenses.label_of(token)
        return [label], licenses.FREEDOM.get(label, licenses.UNKNOWN)

    def chain(word, part, join):
        nonlocal at
        left = part()
        while at < len(tokens) and tokens[at] == word:
            at += 1
            left = join(left, part())
        return left

    exception = lambda: chain("with", operand, lambda a, _: (a[0], (1 + a[1]) / 2))
    both = lambda: chain("and", exception, lambda a, b: (a[0] + b[0], min(a[1], b[1])))
    either = lambda: chain("or", both, lambda a, b: (a[0] + b[0], max(a[1], b[1])))
    try:
        return either()
    except ValueError:
        return None


def test_expressions_by_recursive_descent():
    rng = random.Random(11)
    words = ["mit", "gpl-2.0-only", "apache-2.0", "cc-by-nc-4.0", "x11", "or", "and", "with", "(", ")", "or", "and", "-", "é"]
    seen = set()
    for _ in range(6000):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 9)))
        got, want = licenses.read_expression(text), plain_expression(text)
        assert got == want or got is not None and got[0] == want[0] and abs(got[1] - want[1]) < 1e-12, text
        seen.add(want is None)
    assert seen == {True, False}


def test_labels_and_scores_by_a_plain_version(spark):
    """The method's own labels and score, over the table and texts with tags."""
    lines = ["SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND CC-BY-4.0", "license-expression: Apache-2.0 WITH LLVM-exception license-expression: or", "all rights reserved, under the BSD license", "CC BY-SA and cc by nc nd", "public domain CC0", ""]
    extra = [(10**6 + i, "\n".join(lines[i:] + lines[:i]) + " mit license" * (i % 2)) for i in range(6)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    told = 0
    for r in licenses.scan(docs).collect():
        low = (texts[r.doc_id] or "").translate(SMALL)
        hay = " " + " ".join(WORD.findall(low)) + " "
        labels = [label for phrase, label in {**licenses.NOTICE_PHRASES, **licenses.BASE_PHRASES}.items() if f" {phrase} " in hay]
        found = []
        for part in re.split("(?=" + "|".join(map(re.escape, licenses.TAGS)) + ")", low):
            tag = next((t for t in licenses.TAGS if part.startswith(t)), None)
            if tag and (value := plain_expression(re.split(r"[\r\n]", part[len(tag) :])[0])):
                found.append(value)
        worth = [licenses.FREEDOM[x] for x in labels] + [f for _, f in found]
        want = ",".join(sorted({*labels, *(x for xs, _ in found for x in xs)})), min(worth, default=0.0)
        assert (r.labels, r.score) == want
        told += bool(worth)
    assert told > 20
