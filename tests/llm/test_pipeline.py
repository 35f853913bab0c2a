import re

import corpus_pipeline
from test_jaccard import brute as components
from test_suffixes import brute as suffix_rows

from vigil.llm import decontaminate, quality


def fixture(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    more = [(9001, None, None, None, None), (9002, "", "en", "x", 0), (None, "null id " + "word other " * 12, "en", "x", 1)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    first = docs.filter("doc_id = 1")
    return docs.unionByName(first).unionByName(first)


def test_stages_equal_brute_force(spark, sf):
    docs = fixture(spark, sf)
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality_rules"](spark, docs, sf).cache()
    judged = quality.judge(docs.drop("n_chars"))
    assert good.columns == docs.columns and good.count() == judged.filter("kept").count()

    one = stage["ngram_jaccard_join"](spark, good, sf).cache()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    comp = {c for _, _, c in components(rows) if c != "None"}
    assert {str(r.doc_id) for r in one.collect() if r.doc_id is not None} == comp
    assert one.columns == docs.columns and one.count() == len({(c, k == "None") for k, _, c in components(rows)})

    left = stage["suffix_array_dedup"](spark, one, sf).cache()
    want = sorted(n - gone for n, gone, *_ in suffix_rows([r.text for r in one.collect()], corpus_pipeline.REPEAT_BYTES) if n > gone)
    got = sorted(len(r.text.encode()) for r in left.collect())
    assert left.columns == docs.columns and len(got) == len(want) and all(0 <= g - w <= 6 for g, w in zip(got, want))
    assert all(r.n_chars == len(r.text) for r in left.collect())

    clean = stage["benchmark_decontamination"](spark, left, sf).cache()
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    bad = {r.doc_id for r in decontaminate.find(left, items).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in left.collect()} - bad

    last = stage["merge_dropout"](spark, clean, sf)
    assert last.count() == clean.count() and last.filter("not lossless").count() == 0
    assert last.columns == [*docs.columns, "n_pieces", "ids", "lossless"]


def test_run_and_empty(spark, sf, tmp_path):
    out = corpus_pipeline.run(spark, sf)
    assert 100 < out.count() < 200
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_counters_equal_brute_force(spark, sf):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rep = "a b c d e f g h "
    odd = [(-1, None), (-2, ""), (-3, rep * 2), (-4, rep + "x " + rep + rep), (-5, "q " * 30), (-6, "é\n\né\n \n \té\r\nx\x0bx|#"), (None, "!! !!! #$"),
           (-7, "a b c d e f g"), (-8, "l\nl\nl")]
    df = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string")).withColumn("n_words", F.lit("clash"))
    got = {(r.doc_id, r.text): r for r in quality.judge(df).collect()}
    for r in df.collect():
        w, t = words(r.text), r.text or ""
        g = got[r.doc_id, r.text]
        win = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        cover = {p for i, x in enumerate(win) if win.count(x) > 1 for p in range(i, i + 8)} if len(w) < 400 else None
        lines = [x for x in t.split("\n") if words(x)]
        assert (g.n_words, g.word_chars) == (len(w), sum(map(len, w)))
        assert g.n_symbols == sum(c in "#*$%&|<>" for c in t)
        assert g.n_dup_lines == len(lines) - len(set(lines))
        if cover is not None:
            assert g.n_repeat_words == len(cover), r.text
            assert g.base_failed == (len(w) < 20 or 100 * len(cover) > 30 * len(w))
        assert not (g.base_failed and g.kept)
    assert quality.judge(df.limit(0)).collect() == []


def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    j = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert j and all(r.kept == (r.quality == 1) for r in j if not r.base_failed)
