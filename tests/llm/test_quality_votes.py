import re

import numpy as np
from pyspark.sql import functions as F

from vigil.llm import quality as Q

PROSE = ("The house of the river is old and it was built with stone for the people that live in the valley. "
         "A small road leads to the market, where fruit and bread are sold on every morning of the week. "
         "Some visitors stay for the night, others return before dark to a town beyond that hill. ")


def judged(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r for r in Q.judge(docs, keep=["doc_id"], **kw).collect()}


def test_new_counters_equal_plain_python(spark):
    texts = ["- one two\n* Three four...\nfive SIX 77 end.", "&&&a b$ $c$ ~~~ x", PROSE, "", None, "漢字 かな\n12.5 …\n\n• z…"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in Q.counters(docs).collect():
        t = texts[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r.n_distinct_sq == len(set(words)) ** 2
        assert r.n_odd_words == sum(bool(re.search(r"[#*$%&|<>]", w)) for w in words)
        assert r.n_symbol_runs == len(re.findall(r"([#*$%&|<>~=_])\1\1+", t))
        assert r.n_capitals == len(re.findall("[A-Z]", t)) and r.n_digits == len(re.findall("[0-9]", t))
        assert r.n_marks == len(re.findall("[!?.:;]", t))
        assert r.n_stop == len(set(words) & set(Q.STOP))
        assert r.n_bullets == sum(bool(re.match(r"\s*[-*•]", x)) for x in lines)
        assert r.n_ellipses == sum(bool(re.search(r"(\.\.\.|…)\s*$", x)) for x in lines)
        assert r.n_stutter == sum(a == b for a, b in zip(words, words[1:]))


def test_rates_are_recovered_from_generated_votes(spark):
    """20,000 documents, a quarter bad; rules abstain in a third of the cases."""
    rng = np.random.default_rng(5)
    rates = [(0.02, 0.7), (0.05, 0.6), (0.01, 0.5), (0.1, 0.8), (0.03, 0.4), (0.02, 0.9)]
    rules = {f"r{k}": ("n_words", "n_words", 0.5, 1.0) for k in range(len(rates))}
    bad = rng.random(20_000) < 0.25
    cols = {}
    for k, (g, b) in enumerate(rates):
        vote = np.where(rng.random(len(bad)) < np.where(bad, b, g), -1, 1)
        cols[f"_vg_v_r{k}"] = np.where(rng.random(len(bad)) < 1 / 3, 0, vote)
    table = spark.createDataFrame(list(zip(*(v.tolist() for v in cols.values()))), ", ".join(f"{c} int" for c in cols))
    prior, conf = Q.fit(table.groupBy(*cols).count(), rules, prior_share=0.0)
    assert abs(prior - 0.75) < 0.02
    for k, (g, b) in enumerate(rates):
        got = conf[f"_vg_v_r{k}"][-1]
        assert abs(got[0] - g) < 0.02 and abs(got[1] - b) < 0.04
    # with the prior weighing half the votes the classes stay the same
    prior, conf = Q.fit(table.groupBy(*cols).count(), rules)
    assert abs(prior - 0.75) < 0.1 and all(t[-1][0] < t[-1][1] for t in conf.values())


def test_one_bad_vote_is_outvoted_and_two_reject(spark):
    # ten short lines that all return, between lines that do not: the lines alone vote bad
    one = "\n".join(f"The person{k} in town{k} was for that road{k} of stone{k} and river{k}.\nSee the note here." for k in range(10))
    two = " ".join(f"{w}#" if k % 4 == 0 else w for k, w in enumerate((PROSE * 2).replace(",", "").split()))
    rows = [(k, PROSE.replace("house", f"house{k}").replace("road", f"road{k}")) for k in range(300)]
    rows += [(1000 + k, " ".join(f"{w}{k}&&&" for w in PROSE.split())) for k in range(30)]
    got = judged(spark, [*rows, (1, one), (2000, one), (2001, two)])
    votes = Q.counters(spark.createDataFrame([(2000, one), (2001, two)], "doc_id long, text string")).withColumns(Q.votes())
    bad = {r.doc_id: [n for n in Q.RULES if r[f"_vg_v_{n}"] == -1] for r in votes.collect()}
    assert bad[2000] == ["dup_lines"] and got[2000].kept and not got[2000].base_failed
    assert len(bad[2001]) >= 2 and not got[2001].kept
    assert all(got[k].kept for k in range(2, 300)) and not any(got[1000 + k].kept for k in range(30))


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, PROSE), (4, PROSE), (4, PROSE), (5, PROSE * 3000), (6, "\n" * 5000), (7, "x" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_marks", F.lit("own")).withColumn("p_good", F.lit("own"))
    out = Q.judge(docs, keep=["doc_id"]).collect()
    assert len(out) == 8 and not any(r.kept for r in out if r.doc_id in (1, 2, 6, 7))
    assert [r.kept for r in out if r.doc_id == 4] == [True, True]
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns and {r.n_marks for r in kept.collect()} == {"own"}
    assert Q.judge(docs.limit(0), keep=["doc_id"]).collect() == []
