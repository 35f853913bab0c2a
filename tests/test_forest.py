import numpy as np
import pytest

from vigil.operators import forest as X


def rows(n=2000, seed=3):
    rnd = np.random.default_rng(seed)
    a, b, d, e = rnd.integers(0, 20, n).astype(float), rnd.normal(0, 1, n), rnd.integers(0, 2, n).astype(float), rnd.normal(0, 1, n)
    y = ((a > 11) & (b > 0) | (d == 1) & (b < -0.7)).astype(int) ^ (rnd.random(n) < 0.05)
    return [(i, int(t), *map(float, r), i % 4) for i, (t, r) in enumerate(zip(y, zip(a, b, d, e)))]


DDL = "key long, label int, a double, b double, d double, e double, fold int"


@pytest.fixture(scope="module")
def table(spark):
    return X.bin_table(spark.createDataFrame(rows(), DDL).repartition(5), ["a", "b", "d", "e"], "key", "label")


def plain_tree(bins, y, w, feats_of, depth, min_leaf=1):
    """Greedy Gini tree over binned rows; nodes in level order as (feature, cut)."""
    nodes, level = {}, [(0, np.arange(len(y)))]
    count = 1
    for _ in range(depth):
        nxt = []
        for node, at in level:
            total = [int(w[at][y[at] == k].sum()) for k in (0, 1)]
            if min(total) == 0 or sum(total) < 2 * min_leaf:
                continue
            best = None
            for f in feats_of(node):
                for cut in range(bins[f].max()):
                    low = [int(w[at][(y[at] == k) & (bins[f][at] <= cut)].sum()) for k in (0, 1)]
                    high = [t - v for t, v in zip(total, low)]
                    if min(sum(low), sum(high)) < min_leaf:
                        continue
                    sc = lambda v: sum(q * q for q in v) / sum(v)
                    gain = sc(low) + sc(high) - sc(total)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                        best = gain, f, cut
            if best:
                _, f, cut = best
                nodes[node] = (f, cut, count)
                right = bins[f][at] > cut
                nxt += [(count, at[~right]), (count + 1, at[right])]
                count += 2
        level = nxt
    return nodes


def collected(spark, table):
    t = table.read(spark).orderBy("_key").toPandas()
    return t, np.stack(t["_bins"].to_numpy()).T, t["_y"].to_numpy()


def test_splits_equal_a_plain_tree(spark, table):
    forests = [X.Forest(("a", "b", "d", "e"), trees=1, depth=5, mtry=4, bootstrap=False),
               X.Forest(("a", "b", "d", "e"), trees=2, depth=4, mtry=2, min_leaf=7),
               X.Forest(("e", "b"), skip_fold=1, trees=1, depth=4, mtry=2, bootstrap=False, share=0.5)]
    grown = X.grow(spark, table, forests)
    t, bins, y = collected(spark, table)
    h = t["_h"].to_numpy()
    for i, f in enumerate(forests):
        places = np.array([table.cols.index(x) for x in f.features])
        use = np.ones(len(y), bool) if f.skip_fold is None else (t["_fold"] != f.skip_fold).to_numpy()
        use &= (t["_pos"] < np.floor(f.share * t["_n"] + 0.5)).to_numpy()
        for k in range(f.trees):
            w = use * (X.poisson_weights(42, k, h) if f.bootstrap else 1)
            want = plain_tree(bins, y, w, lambda n: X.node_features(f, places, 42, k, np.array([n]))[0], f.depth, f.min_leaf)
            feat, cut, left = grown.trees.tree(grown.first[i] + k)
            got = {n: (int(feat[n]), int(cut[n]), int(left[n])) for n in range(len(feat)) if feat[n] >= 0}
            assert got == want, (i, k)


def test_partitions_and_company_do_not_matter(spark, table):
    f = X.Forest(("a", "b", "e"), trees=5, depth=4)
    a = X.grow(spark, table, [f])
    b = X.grow(spark, X.bin_table(spark.createDataFrame(rows()[::-1], DDL).coalesce(1), ["a", "b", "d", "e"], "key", "label"), [X.Forest(("d", "e"), trees=3), f])
    assert a.importances(0) == b.importances(1)
    for k in range(5):
        for x, y in zip(a.trees.tree(k), b.trees.tree(3 + k)):
            assert (x == y).all()


def test_views_equal_smaller_forests(spark, table):
    big = X.grow(spark, table, [X.Forest(("a", "b", "d", "e"), skip_fold=2, trees=12, depth=6)])
    small = X.grow(spark, table, [X.Forest(("a", "b", "d", "e"), skip_fold=2, trees=5, depth=3)])
    views, own = X.evaluate(spark, big, [X.View(0, 5, 3), X.View(0)]), X.evaluate(spark, small)
    for part in ("train", "held"):
        assert (views[0, part] == own[0, part]).all()
    assert views[0, "train"].sum() == 1500 and views[1, "held"].sum() == 500
    assert X.metrics(views[1, "held"])["accuracy"] > 0.88


def test_scores_agree_with_the_counts(spark, table):
    grown = X.grow(spark, table, [X.Forest(("a", "b", "d"), skip_fold=0, trees=7, depth=5)])
    got = X.scores(spark, grown).where("fold = 0").collect()
    cells = X.evaluate(spark, grown)[0, "held"]
    assert cells[1, 1] == sum(r.label == 1 and r.p > 0.5 + 1e-10 for r in got) and cells.sum() == len(got)


def test_shares_are_exact_and_nested(spark, table):
    t, _, _ = collected(spark, table)
    at = {s: {int(k) for k in t["_key"][X._used(X.Forest((), skip_fold=3, share=s), t["_fold"].to_numpy(), t["_pos"].to_numpy(), t["_n"].to_numpy())]}
          for s in (0.1, 0.5, 1.0)}
    assert [len(at[s]) for s in (0.1, 0.5, 1.0)] == [150, 750, 1500] and at[0.1] < at[0.5] < at[1.0]


def test_bagging_weights_are_poisson(spark):
    w = X.poisson_weights(1, 3, np.arange(200_000))
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02
    v = X.poisson_weights(1, 4, np.arange(200_000))
    assert abs(np.corrcoef(w, v)[0, 1]) < 0.01


def test_elimination_keeps_what_matters(spark, table):
    rk = X.rfe(spark, table, ["a", "b", "d", "e"], 2, trees=10, depth=5)
    assert sorted(r for _, r in rk) == [1, 1, 2, 3] and dict(rk)["e"] == 3  # noise goes first
    (chosen, sizes), (one, few) = X.rfecv(spark, table, [["a", "b", "d", "e"], ["e", "b"]], 4, trees=10, depth=5)
    assert [r["size"] for r in sizes] == [1, 2, 3, 4] and {"a", "b"} <= set(chosen) and [r["size"] for r in few] == [1, 2] and one
    best = max(sizes, key=lambda r: (r["f1"], -r["size"]))
    assert len(chosen) == best["size"]
    full = X.fold_scores(spark, table, [("a", "b", "d", "e")], 4, trees=10, depth=5)[0]
    assert abs(np.mean(full) - sizes[-1]["f1"]) < 1e-12


def test_random_cuts_and_missing_values(spark):
    data = [(i, int(i % 3 == 0), None if i % 3 == 0 else float(i), float("nan") if i % 2 else 1.0, 0.0, float(i % 7), i % 2) for i in range(300)]
    t = X.bin_table(spark.createDataFrame(data + [(999, None, 1.0, 1.0, 1.0, 1.0, 0)], DDL), ["a", "b", "d", "e"], "key", "label")
    grown = X.grow(spark, t, [X.Forest(("a", "b", "d", "e"), trees=20, bootstrap=False, random_cuts=True), X.Forest(("a",), trees=1, mtry=1, bootstrap=False)])
    assert grown.importances(0)[0][0] == "a" and grown.importances(0)[-1] == ("d", 0.0)
    cells = X.evaluate(spark, grown)[1, "train"]
    assert cells.sum() == 300 and cells[0, 1] == cells[1, 0] == 0  # the missing values alone tell the class


def test_one_class_and_no_rows(spark):
    one = X.bin_table(spark.createDataFrame([(i, 0, 1.0, 2.0, 3.0, 4.0, 0) for i in range(9)], DDL), ["a", "b"], "key", "label")
    grown = X.grow(spark, one, [X.Forest(("a", "b"), trees=2)])
    assert X.evaluate(spark, grown)[0, "train"].tolist() == [[9]] and grown.importances(0) == [("a", 0.0), ("b", 0.0)]
    none = X.bin_table(spark.createDataFrame([], DDL), ["a", "b"], "key", "label")
    assert X.evaluate(spark, X.grow(spark, none, [X.Forest(("a", "b"), trees=2)]))[0, "train"].sum() == 0
