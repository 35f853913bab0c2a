import math
import re

import pytest

from vigil.llm import ruleset as X

TEXTS = [None, "", " \n\t", "a", "One two.\nONE two!\nOne two.", "x|y | z,, 12 a1", "the the the cat", "ÉÉ éé É# no$ $5", "w" * 25 + " b c\n\nEnd?",
         "a b " * 4000, "Ünï ＡＢ \x0b x\x0cy\r\nz;"]


def plain(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, m, div = len(words), len(lines), lambda a, b: a / b if b else 0.0
    share = lambda test: div(sum(map(test, words)), n)
    chars = lambda s: div(sum(t.count(c) for c in s), n)
    return {"words": math.log1p(n), "mean_word": div(sum(map(len, words)), n), "short_words": share(lambda w: len(w) <= 2),
            "long_words": share(lambda w: len(w) > 20), "capital_words": share(lambda w: w == w.upper() and w != w.lower()),
            "sign_words": share(lambda w: w[-1] in X.SIGNS), "signs": chars(X.SIGNS), "bars": chars("|"), "bangs": chars("!"),
            "digits": chars("0123456789"), "commas": chars(","), "stops": chars("."), "distinct_words": div(len(set(words)), n),
            "stutter": div(sum(a == b for a, b in zip(words, words[1:])), n), "lines": math.log1p(m),
            "equal_lines": div(m - len(set(lines)), m), "words_a_line": div(n, m), "ended_lines": div(sum(x[-1] in ".!?:;" for x in lines), m)}


def test_statistics_equal_plain_python(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in X.statistics(docs).collect():
        want = plain(r.text)
        assert {s: r[X.PREFIX + s] for s in X.STATS} == pytest.approx(want), r.text


DEBUG = """RandomForestClassificationModel: uid=x, numTrees=2, numClasses=2, numFeatures=2
  Tree 0 (weight 1.0):
    If (feature 0 <= 5.0E-4)
     If (feature 0 <= 0.25)
      Predict: 0.0
     Else (feature 0 > 0.25)
      Predict: 1.0
    Else (feature 0 > 5.0E-4)
     Predict: 1.0
  Tree 1 (weight 1.0):
    If (feature 1 <= -1.5)
     Predict: 0.0
    Else (feature 1 > -1.5)
     Predict: 1.0
"""


def test_paths_are_read_with_their_tightest_bounds():
    assert X.paths(DEBUG, ["a", "b"]) == [(("a", "<=", 5e-4),), (("a", "<=", 5e-4), ("a", ">", 0.25)), (("a", ">", 5e-4),),
                                          (("b", "<=", -1.5),), (("b", ">", -1.5),)]


def test_score_is_the_sum_of_held_rules(spark):
    rules = X.RuleSet(-0.5, {(("a", "<=", 1.0), ("b", ">", 0.0)): 2.0, (("a", ">", 1.0),): -3.0})
    rows = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0), (2.0, 5.0), (1.0, 0.1)], "a double, b double").withColumn("s", rules.score()).collect()
    for r in rows:
        odds = -0.5 + 2.0 * (r.a <= 1 and r.b > 0) - 3.0 * (r.a > 1)
        assert r.s == pytest.approx(1 / (1 + math.exp(-odds)))


def fixture(spark, n=400):
    """Bad texts shout; a tenth of the labels is wrong."""
    rows = []
    for i in range(n):
        words = [f"word{(i * 7 + k * k) % 97}" for k in range(10 + i % 30)]
        rows.append((i, " ".join(w.upper() + "!!" if i % 4 == 0 else w for w in words), "clash", int(i % 4 != 0) ^ (i % 10 == 5)))
    return (spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, score string"),
            spark.createDataFrame([(r[0], r[3]) for r in rows] + [(0, None), (None, 1), (3, 7)], "doc_id long, quality int"))


def test_learns_through_noise_on_rows_it_has_not_seen(spark):
    docs, labels = fixture(spark)
    from pyspark.sql import functions as F

    got = X.judge(docs, labels, F.col("doc_id") % 5 != 0).collect()
    assert len(got) == 400
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    right = [r.predicted == int(r.doc_id % 4 != 0) for r in got if r.doc_id % 5 == 0]
    assert sum(right) / len(right) > 0.95


def test_few_rules_remain(spark):
    docs, labels = fixture(spark)
    rows = X.statistics(docs).join(labels, "doc_id").filter("quality in (0, 1)").selectExpr("*", "double(quality) y", "1.0D w")
    model, loose = X.train(rows, penalty=0.02), X.train(rows, penalty=0.0)
    assert 1 <= len(model.weights) < len(loose.weights)


def test_labels_of_unlearned_rows_have_no_effect(spark):
    docs, labels = fixture(spark, 120)
    from pyspark.sql import functions as F

    other = labels.withColumn("quality", F.when(F.col("doc_id") % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in X.judge(docs, x, F.col("doc_id") % 5 != 0).collect()} for x in (labels, other))
    assert a == pytest.approx(b)


def test_defined_results(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(None, "a b"), (1, None), (1, None), (2, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [(r.score, r.predicted) for r in X.judge(docs, none, F.lit(True)).collect()] == [(0.5, 1)] * 4
    ones = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, quality int")
    assert {round(r.score, 6) for r in X.judge(docs, ones, F.lit(True)).collect()} == {0.2}
    assert X.judge(docs.limit(0), ones, F.lit(True)).collect() == []


def test_documents_held_out(spark, sf):
    """Against the labels of the rows that were not learned from."""
    from vigil.llm import queries as Q

    got = Q.op12_quality_classifier(spark, sf).filter("held_out")
    both = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("predicted", "quality").collect()
    assert both and sum(r.predicted == r.quality for r in both) / len(both) >= 0.8
