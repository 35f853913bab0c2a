import random

import numpy as np

from vigil.llm import decontaminate as D


def items(seed=0, n=150):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(60)]
    out = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(6, 40))) + ". " + " ".join(rnd.choice(vocab) for _ in range(4)) + ".")
           for i in range(n)]
    common = "a phrase of five words here"
    return out + [(n + i, f"{common} x{i} y{i} z{i}") for i in range(100)] + [(n + 100, "two words"), (n + 101, ""), (n + 102, None), (n + 103, out[0][1])]


def test_wand_equals_full_scoring():
    index = D.Index([(i, t) for i, t in items()])
    rnd = random.Random(1)
    for trial in range(300):
        terms = sorted(rnd.sample(range(len(index.terms)), rnd.randrange(1, 60)))
        if trial % 2:  # most terms of one item
            d = rnd.randrange(len(index.words))
            own = np.searchsorted(index.terms, np.unique(D._runs(index.words[d], D.TERM)))
            terms = sorted(set(terms) | set(own[: max(1, len(own) * 3 // 4)].tolist()))
        score = np.zeros(len(index.words))
        for t in terms:
            for d, w in zip(index.items[t], index.weights[t]):
                score[d] += w
        for threshold in (0.05, 0.3, 0.5, 0.8):
            want = {d: score[d] for d in np.flatnonzero(score >= threshold - 1e-12)}
            got = dict(index.search(terms, threshold))
            assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-9 for d in got)


def table(spark):
    it = items()
    rnd = random.Random(2)
    filler = lambda n: " ".join(f"f{rnd.randrange(9999)}" for _ in range(n))
    edited = it[1][1].split()
    edited[0] = "changed"
    docs = [(1, filler(500) + " " + it[0][1] + " " + filler(30)), (2, it[1][1].upper()), (3, filler(3) + "\n" + " ".join(edited)), (4, filler(100)),
            (5, None), (6, ""), (7, "two words"), (8, "has two words inside"), (9, "two other words"), (10, "a phrase of five words here x1 y1 z1"),
            (11, "a phrase of five words here and no more"), (None, filler(45) + " " + it[5][1]), (12, D.question_answer(it[6][1])[0]),
            (13, it[7][1] + " " + filler(20000) + " " + it[8][1]), (13, it[7][1])]
    want = {(1, 0), (1, 253), (2, 1), (7, 250), (8, 250), (10, 151), (None, 5), (13, 7), (13, 8)}
    n = len(it[1][1].split()) - 4
    assert n - 1 >= 0.8 * n
    want.add((3, 1))  # the changed first word is in one shingle
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(it, "item_id long, text string"), want


def test_find_and_clean(spark):
    docs, it, want = table(spark)
    for size in (16 << 20, 4000):
        assert {(r.doc_id, r.item_id) for r in D.find(docs, it, index_bytes=size).collect()} == want
        left = D.clean(docs, it, index_bytes=size).collect()
        assert sorted(str(r.doc_id) for r in left) == sorted(["4", "5", "6", "9", "11", "12"])
    assert D.find(docs.limit(0), it).collect() == [] and D.find(docs, it.limit(0)).collect() == []
    assert D.clean(docs, it.limit(0)).count() == docs.count()


def test_documents_table(spark, sf):
    """Against shingle containment by plain loops."""
    docs, it = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = set()
    split = lambda t: [tuple(w[i:i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4))]
    for d in docs.collect():
        have = set(split(d.text))
        for i in it.collect():
            own = set(split(i.text))
            if len(own & have) >= 0.8 * len(own):
                want.add((d.doc_id, i.item_id))
    assert {(r.doc_id, r.item_id) for r in D.find(docs, it).collect()} == want
