import os

import pytest
from brute import near_duplicates

pytest.importorskip("corpus_pipeline")
import corpus_pipeline as cp  # noqa: E402


def test_stages_on_the_table(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in cp.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, sf).write.parquet(os.path.join(tmp_path, name))
        docs = spark.read.parquet(os.path.join(tmp_path, name))
        kept[name] = (before, docs.collect())
        assert name == "packing" or docs.columns == columns
    before, after = kept["quality"]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    stay = {r.doc_id for r in after}
    assert sum(quality[i] == (i in stay) for i in quality) >= 0.98 * len(quality)
    before, after = kept["near_copies"]
    group = near_duplicates([(r.doc_id, r.text) for r in before.values()], 5)
    assert {r.doc_id for r in after} == {c for _, c in group.values()}
    before, after = kept["personal_data"]
    for r in after:
        assert "@mail" not in r.text and "555-" not in r.text
        assert r.text == before[r.doc_id].text or "<" in r.text
        assert r.n_chars == len(r.text)
    before, after = kept["mixture"]
    assert {r.doc_id for r in after} == set(before) and len(after) >= len(before)
    before, after = kept["packing"]
    assert {r.doc_id for r in after} == set(before)


def test_run_is_the_stages(spark):
    assert cp.run(spark, "/root/testdata/sf0.001").count() > 0
    assert [n for n, _ in cp.STAGES] == ["quality", "near_copies", "personal_data", "mixture", "packing"]


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, mix int, `a.b` string, text_hash int, row string, whole int, x double, copy string"
LONG = " ".join(f"word{i} and so on" for i in range(3000))


def edge_rows():
    more = (7, "dot", 8, "r", 9, 0.5, "c")
    texts = ["the quick brown fox jumps over the lazy dog at noon", "an entirely different text about rain in spring fields"]
    rows = [(3, texts[0], "en", "s", 51, *more), (8, texts[0], "en", "s", 51, *more), (8, texts[1], "en", None, 53, *more), (8, texts[1], "en", None, 53, *more)]
    rows += [(None, texts[1], None, "s", None, *more), (5, None, None, None, None, *more), (5, "", "en", "s", 0, *more), (6, LONG, "en", "s", len(LONG), *more), (9, "x@y.zz", "en", "t", 6, *[None] * 7)]
    return rows


def test_stages_on_edge_rows(spark, tmp_path):
    docs = spark.createDataFrame(edge_rows(), COLUMNS)
    labels = spark.createDataFrame([(3, 1, 0), (None, 0, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    found = {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        found[name] = out.collect()
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == [], name
    pick = lambda rows: sorted((r.doc_id or -1, r.text or "") for r in rows)
    assert pick(found["quality"]) == pick(docs.collect())  # one score for all, above the threshold
    assert pick(found["near_copies"]) == pick([r for r in docs.dropDuplicates(["doc_id", "text"]).collect() if not (r.doc_id in (8, None) and r.text.startswith("the" if r.doc_id else "an "))])
    assert {r.text for r in found["personal_data"]} == {r.text for r in docs.collect()} - {"x@y.zz"} | {"<EMAIL>"}
    assert {(r.doc_id, r.text) for r in found["mixture"]} == {(r.doc_id, r.text) for r in docs.collect()}
    assert {r.mix for r in found["mixture"]} == {7, None} and {r["a.b"] for r in found["mixture"]} == {"dot", None}
    pieces = cp.pack_sequences(spark, docs, str(tmp_path)).collect()
    assert len([p for p in pieces if p.start == 0]) == docs.count()
    assert cp.pack_sequences(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_near_copies_keep_a_row_of_every_text_unlike_others(spark):
    other = "an entirely different text about rain in spring fields"
    same = "the quick brown fox jumps over the lazy dog at noon"
    docs = spark.createDataFrame([(3, same), (8, same), (8, other)], "doc_id long, text string")
    assert {tuple(r) for r in cp.drop_near_copies(spark, docs, "").collect()} == {(3, same), (8, other)}
