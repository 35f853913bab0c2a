from fractions import Fraction

import numpy as np

from vigil.llm import whitening as W

DDL = "vec_id long, embedding array<float>, whitened string, n int"


def plain(vectors):
    """Exact covariance in fractions, and x."""
    x = [[int(np.floor(1024 * np.float64(np.float32(c)))) + 100_000 for c in v] for v in vectors]
    n, dim = len(x), len(x[0])
    mean = [Fraction(sum(r[i] for r in x), n) for i in range(dim)]
    cov = [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n for j in range(dim)] for i in range(dim)]
    return x, mean, cov


def test_equals_exact_fractions(spark):
    rnd = np.random.default_rng(5)
    vectors = (rnd.normal(0, 1, (60, 10)) @ rnd.normal(0, 1, (10, 10)) + 3).astype(np.float32).tolist()
    vectors += vectors[:3]  # repeated rows
    rows = [(i, v, "clash", 7) for i, v in enumerate(vectors)] + [(None, vectors[0], "x", 1)]
    bad = [(900, None, "", 0), (901, [], "", 0), (902, [1.0] * 9 + [None], "", 0), (903, [float("nan")] * 10, "", 0),
           (904, [float("-inf")] * 10, "", 0), (905, [1.0, 2.0], "", 0)]
    got = W.components(spark.createDataFrame(rows + bad, DDL).repartition(4)).collect()
    used = [r[1] for r in rows]
    x, mean, cov = plain(used)
    n, e = len(x), np.linalg.eigvalsh(np.array(cov, float))[::-1]
    model = W.fit(spark.createDataFrame(rows + bad, DDL))
    assert (model.covariance == np.array([[float(c) for c in r] for r in cov])).all()
    assert len(got) == 8 * n and {r.n for r in got} == {n} and not {r.vec_id for r in got} & {900, 901, 902, 903, 904, 905}
    v = np.array(cov, float)
    for r in got:
        if r.vec_id is None:
            continue
        d = [n * a - n * m for a, m in zip(x[r.vec_id], mean)]
        assert int(r.deviation) == sum(q * q for q in d)
        assert abs(r.explained - e[r.component - 1] / e.sum()) < 1e-9 and r.identity_error < 1e-9
    w = np.array([[r.whitened for r in sorted(got, key=lambda r: r.component) if r.vec_id == i] for i in range(len(vectors))])
    centred = np.array([[float(a - m) for a, m in zip(r, mean)] for r in x[:len(vectors)]])
    basis = np.linalg.lstsq(centred, w * np.sqrt(e[:8]), rcond=None)[0]
    assert np.allclose(v @ basis, basis * e[:8], rtol=1e-8, atol=1e-5) and np.allclose(np.linalg.norm(basis, axis=0), 1)


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(3.0 ** (k + 20 * (i % 3 == k % 3))) for k in range(4)], "", 0) for i in range(9)] + [(9, [3e38, -3e38, 1.0, 0.0], "", 0)]
    model = W.fit(spark.createDataFrame(rows[:9], DDL))
    _, _, cov = plain([r[1] for r in rows[:9]])
    assert (model.covariance == np.array([[float(c) for c in r] for r in cov])).all()
    assert len(W.components(spark.createDataFrame(rows, DDL)).collect()) == 40


def test_deviations_paths_agree():
    y = np.random.default_rng(2).integers(-900, 900, (50, 12))
    for n in (7, 10**6, 10**11, 10**14):
        rest = [k - 5 for k in range(12)]
        want = [sum((n * int(a) - r) ** 2 for a, r in zip(row, rest)) for row in y]
        assert W.deviations(y, n, rest) == want


def test_void_components_and_few_dimensions(spark):
    rows = [(i, [float(i), 2.0 * i, 1.0], "", 0) for i in range(6)]
    got = W.components(spark.createDataFrame(rows, DDL)).collect()
    assert len(got) == 18 and all((r.whitened is None) == (r.component > 1) for r in got) and got[0].identity_error < 1e-9
    one = W.components(spark.createDataFrame(rows[:1], DDL)).collect()
    assert len(one) == 3 and all(r.whitened is None and r.identity_error is None and r.deviation == 0 for r in one)


def test_partitions_do_not_matter(spark, sf):
    from pyspark.sql import functions as F

    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    a, b = (W.fit(vectors.repartition(k)) for k in (1, 7))
    assert (a.covariance == b.covariance).all() and a.centre == b.centre
    out = W.components(vectors).agg(F.max("identity_error")).first()[0]
    assert out < 1e-6


def test_empty_table(spark):
    assert W.components(spark.createDataFrame([], DDL)).collect() == []
