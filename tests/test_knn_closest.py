import numpy as np

from vigil.operators import ml as ML


def test_candidates_hold_every_neighbour_and_tie():
    rnd = np.random.default_rng(2)
    for shift in (0.0, 1e6):
        t = rnd.normal(0, 1, (400, 8)).round(1) + shift
        t[200:] = t[:200]  # ties
        q = t[:50]
        barred = np.arange(50)[:, None] == np.arange(400)
        i, j = ML._closest(q, t, 5, barred)
        got = set(zip(i.tolist(), j.tolist()))
        d = np.round(np.sqrt(((q[:, None] - t) ** 2).sum(-1)), 9)
        d[barred] = np.inf
        kth = np.sort(d, axis=1)[:, 4]
        want = set(zip(*(x.tolist() for x in np.nonzero(d <= kth[:, None]))))
        assert want <= got and len(got) < 50 * 40 and not got & {(k, k) for k in range(50)}


def test_votes_equal_brute_force(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rnd.normal(0, 1, 6)], i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    got = {r.qid: r.prediction for r in ML.knn(df, df, "id", "id", "v", "label", k=3, exclude_self=True).collect()}
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    for i in range(60):
        d = np.round(np.sqrt(((x[i] - x) ** 2).sum(-1)), 9)
        d[i] = np.inf
        near = np.lexsort((np.arange(60), d))[:3]
        votes = np.bincount(y[near], minlength=3)
        assert got[i] == votes.argmax()
