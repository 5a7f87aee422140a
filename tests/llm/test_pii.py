import hashlib
import math
import random
import re
import time

from cropledger.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMA = "doc_id long, text string, email string, row string"


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def plain(text):
    return [[(m.start(), m.end()) for m in re.finditer(p, text or "") if passes(k, m[0])] for k, p in PATTERNS.items()]


def compare(out, docs):
    rows = {r.doc_id: r for r in out.collect()}
    assert set(rows) == {d[0] for d in docs}
    for i, text in docs:
        by = plain(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, s in zip(PATTERNS, by) for a, b in s)
        r = rows[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(s) for s in by], text[:200]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.spans.startswith(listed)


def test_table(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    compare(pii.digest(pii.sanitise(df)), docs)


def test_edges(spark):
    docs = list(enumerate([
        None, "", "a@b.c_d@e.fg", "x@@y.z a@b", "é a.b@c-d.e.f. 1.2.3.4.5 256.1.1.1 001.02.3.255 99999999999999.1.1.1",
        "4111 1111 1111 1111 and 4111-1111-1111-1112 5 4111111111111111 1", "+1 (437) 555-0689 +12 +1234567 +12345678 +1....2 +1 (1) (2)",
        "1" * 40000, "a" * 40000 + "@" + "b." * 20000, "1.1" * 9000, "+1" + " " * 20000, "12 3-4  56--7", "😀 me@x.org 😀 10.0.0.1",
    ]))
    df = spark.createDataFrame([(i, t, "e", "r") for i, t in docs], SCHEMA)
    compare(pii.digest(pii.sanitise(df)), docs)
    assert pii.sanitise(df.limit(0)).count() == 0


def test_terms_that_give_an_entity_away(spark):
    filler = ["the harvest was good that year", "prices rose in spring again", "rain fell over the plain"]
    docs = [(i, f"{filler[i]}. Zebulon wrote from zeb@farm.org about {filler[(i + 1) % 3]}. Zebulon left.") for i in range(3)]
    docs += [(10 + i, f"{filler[i % 3]} and nothing else {i}") for i in range(90)]
    df = spark.createDataFrame([(i, t, None, None) for i, t in docs], SCHEMA)
    rows = {r.doc_id: r for r in pii.sanitise(df).collect()}
    for i in range(3):
        assert "Zebulon" not in rows[i].clean_text and "zeb@" not in rows[i].clean_text
        assert "<TERM>" in rows[i].clean_text and "<EMAIL>" in rows[i].clean_text and "harvest" in rows[0].clean_text
        for s in rows[i].all_spans:
            assert s.kind != "term" or rows[i].text[s.start : s.end] in ("Zebulon", "wrote", "from", "about")
    assert all(rows[i].clean_text == t for i, t in docs if i >= 10)


def test_copies_of_one_context_count_once(spark):
    df = spark.createDataFrame([(i, "Zebulon wrote from zeb@farm.org today", None, None) for i in range(5)], SCHEMA)
    assert {r.clean_text for r in pii.sanitise(df).collect()} == {"Zebulon wrote from <EMAIL> today"}


def test_copies_do_not_hide_terms(spark):
    told = ["Zebulon wrote from zeb@farm.org today", "Yes, Zebulon answers zeb@farm.org at once"]
    other = [f"nothing else happened {i}" for i in range(40)]
    for copies in (1, 5, 300):
        docs = [(i, t, None, None) for i, t in enumerate(told * copies + other)]
        texts = {r.clean_text for r in pii.sanitise(spark.createDataFrame(docs, SCHEMA)).collect()}
        assert texts == {"<TERM> wrote from <EMAIL> today", "Yes, <TERM> answers <EMAIL> at once", *other}, copies


def test_words_near_an_entity_have_their_places(spark):
    texts = ["é, Ab cd  ef gh-ij x@y.zz; Kl 😀 mn op qr st", "x@y.zz", "a x@y.zz b"]
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA)
    at = lambda t: t.index("x@y.zz")
    rows = pii.find(df).select("doc_id", pii._near(pii._pieces(pii.F.col("text")), pii.F.col("email")[0]["start"], pii.F.col("email")[0]["end"]).alias("near")).collect()
    for r in rows:
        t = texts[r.doc_id]
        words = [(m.start(), m[0].lower()) for m in re.finditer(r"[^\W_]+", t)]
        assert [tuple(w) for w in r.near] == [w for w in words if w[0] < at(t)][-4:] + [w for w in words if w[0] >= at(t) + 6][:4]


def test_secrets_of_any_length(spark):
    values = ["k" * 8, "j" * 512, "i" * 513, "aB3._-" * 2000, "z" * 200000]
    docs = [(i, f"set token=\"{v}\" and api_key = '{v}' here", None, None) for i, v in enumerate(values)]
    docs += [(9, "token='short' " + "token='" + "token=" * 20000, None, None)]
    rows = {r.doc_id: r for r in pii.sanitise(spark.createDataFrame(docs, SCHEMA)).collect()}
    for i, v in enumerate(values):
        assert rows[i].clean_text == "set <SECRET> and <SECRET> here" and [s.value for s in rows[i].secret] == [f"token=\"{v}\"", f"api_key = '{v}'"]
    assert rows[9].clean_text == docs[-1][1]


def plain_terms(texts, contexts=2, share=0.5, bits=3.0):
    """(entity, term) by loops over the distinct texts."""
    texts = set(texts)
    word = re.compile(r"[^\W_]+")
    held, seen, near, uses = {}, {}, {}, {}
    for t in texts:
        words = [(m.start(), m[0].lower()) for m in word.finditer(t)]
        for _, w in words:
            uses[w] = uses.get(w, 0) + 1
        for kind, spans in zip(PATTERNS, plain(t)):
            for a, b in spans:
                e = f"{kind}:{t[a:b].lower()}"
                held.setdefault(e, set()).add(t)
                before, after = [w for w in words if w[0] < a][-4:], [w for w in words if w[0] >= b][:4]
                context = tuple(w for _, w in before + after)
                for at, w in before + after:
                    seen.setdefault((e, w), set()).add(context)
                    near.setdefault((e, w), set()).add((t, at))
    found = set()
    for (e, w), c in seen.items():
        p = min(1.0, len(near[e, w]) / uses[w])
        if len(c) >= contexts and p >= share and math.log2(p / (len(held[e]) / len(texts))) >= bits:
            found.add((e, w))
    return found


def test_terms_by_brute_force(spark):
    rng = random.Random(3)
    names, people, texts = ["Zebulon", "Ada", "ng", "Ö", "李", "x9"], [f"p{i}@farm.org" for i in range(6)], []
    for i in range(260):
        words = rng.choices(["corn", "soy", "rye", "oat", "hay"], k=rng.randint(0, 12))
        if i % 4 == 0:
            who = rng.randrange(6)
            gap = rng.choice([" ", " - ", " " * 300, "," * 500])
            words.insert(rng.randint(0, len(words)), f"{names[who]}{gap}{people[who]}{gap}{rng.choice(['wrote', names[who], 'w' * 400])}")
        if i % 50 == 1:
            words.append(names[i % 6])
        texts.append(" ".join(words))
    texts += texts[::3] * 4 + ["all to all@x.yz now"] * 3
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA)
    want = plain_terms(texts)
    assert len(want) >= 6
    assert {(r.entity, r.term) for r in pii.disclosing_terms(pii.find(df)).collect()} == want


def test_very_many_spans_in_one_text(spark):
    """100,000 spans in a text; ten times the spans take about ten times as long at most, as no step costs what the whole text does."""
    head = [f"Zebulon wrote {w} from zeb@farm.org" for w in ("late", "soon")]
    many = lambda n: " ".join(f"p{i}@f{i}.org é{i % 97} 10.0.{i % 256}.{i % 199}" for i in range(n))
    took = {}
    for n in (5000, 50000):
        docs = list(enumerate([f"{h}; {many(n)}" for h in head] + [f"nothing else {i}" for i in range(40)]))
        began = time.time()
        out = pii.sanitise(spark.createDataFrame(docs, "doc_id long, text string"))
        rows = {r.doc_id: r for r in out.select("doc_id", pii.F.size("email").alias("n_email"), pii.F.size("ip").alias("n_ip"), "clean_text").collect()}
        took[n] = time.time() - began
        for i, h in enumerate(head):
            assert (rows[i].n_email, rows[i].n_ip) == (n + 1, n)
            assert rows[i].clean_text.count("<EMAIL>") == n + 1 and rows[i].clean_text.count("<IP>") == n and not re.search("@|10[.]0|Zeb", rows[i].clean_text)
        assert all(rows[i].clean_text == docs[i][1] for i in range(2, 42))
    assert took[50000] < 20 * took[5000]


def test_terms_apart_from_spans(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        cuts = sorted(rng.sample(range(60), 2 * rng.randint(0, 6)))
        own = list(zip(cuts[::2], cuts[1::2]))
        taken = [(a, a + rng.randint(1, 9)) for a in (rng.randrange(60) for _ in range(rng.randint(0, 6)))]
        rows.append((i, [(a, b, "v") for a, b in own], [(a, b, "e") for a, b in taken]))
    span = "array<struct<start:int,end:int,value:string>>"
    got = spark.createDataFrame(rows, f"i int, own {span}, taken {span}").select("i", "own", "taken", pii._apart(pii.F.col("own"), pii.F.col("taken")).alias("left")).collect()
    for r in got:
        assert [tuple(s) for s in r.left] == [tuple(s) for s in r.own if not any(s.start < e.end and e.start < s.end for e in r.taken)]


def test_cuts_of_pieces(spark):
    rng = random.Random(7)
    rows = []
    for n in (0, 1, 1023, 1024, 1025, 2048, 5000):
        t = "".join(rng.choice("aé😀\n") for _ in range(n))
        rows += [(t, a, b) for a, b in [(0, 0), (0, n), (n, n), (n, n + 3000), (0, n + 3000)] + [tuple(sorted(rng.choices(range(n + 1), k=2))) for _ in range(30)]]
    for r in spark.createDataFrame(rows, "t string, a int, b int").select("t", "a", "b", pii._let(pii._pieces(pii.F.col("t")), lambda ps: pii._cut(ps, pii.F.col("a"), pii.F.col("b"))).alias("c")).collect():
        assert r.c == r.t[r.a : r.b]


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a@b.cd x", 5, "q", "w", 7), (None, None, None, None, None, None)], "doc_id long, text string, copy int, `a.b` string, whole string, all_spans int")
    rows = {r.doc_id: r for r in pii.sanitise(df).collect()}
    assert rows[1].clean_text == "<EMAIL> x" and rows[1].whole["a.b"] == "q" and rows[1].whole.copy == 5 and rows[None].clean_text == ""
