import random

from test_jaccard import brute, rows_of

from vigil.llm import jaccard


def test_a_family_around_one_text_leaves_no_pairs_to_the_last_join(spark, monkeypatch):
    rnd = random.Random(8)
    rows = []
    for f in range(2):
        base = [f"f{f}w{i}" for i in range(300)]
        texts = [" ".join(base)]
        for i in range(40):
            w = list(base)
            for at in rnd.sample(range(300), 4):
                w[at] = f"own{f}x{i}x{at}"  # links with the base, hardly with another copy
            texts.append(" ".join(w))
        rows += [(f * 1000 + i, t) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    seen, saved = {}, jaccard._saved

    def spy(df, name):
        out = saved(df, name)
        seen.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "_saved", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(jaccard.join(df, part_bytes=20_000)) == brute(rows)
    assert seen["star"][0] == 80 and seen["apart"] == [0]


def test_all_that_link_with_one_pivot_take_one_name(spark):
    comp = spark.createDataFrame([(i, i, 0) for i in range(10)], "cls long, c long, central int")
    link = spark.createDataFrame([(i, 5) for i in (1, 2, 3, 7, 9)], "x long, y long")
    got = {r["cls"]: r["c"] for r in jaccard._hook(comp, link).collect()}
    assert got == {**{i: 1 for i in (1, 2, 3, 5, 7, 9)}, 0: 0, 4: 4, 6: 6, 8: 8}
    again = jaccard._hook(jaccard._hook(comp, link), spark.createDataFrame([(9, 4), (0, 8)], "x long, y long"))
    assert {r["cls"]: r["c"] for r in again.collect()} == {**{i: 1 for i in (1, 2, 3, 4, 5, 7, 9)}, 0: 0, 8: 0, 6: 6}


def test_the_copy_with_fewest_changes_is_the_most_central():
    import numpy as np

    common, changed = np.array([7] * 90 + [0] * 10, np.uint8), np.array([7] * 60 + [0] * 40, np.uint8)
    assert jaccard.centrality(common) > jaccard.centrality(changed) > jaccard.centrality(np.zeros(3, np.uint8)) == 0
    assert jaccard.centrality(np.full(50_000, 64, np.uint8)) == 64_000
