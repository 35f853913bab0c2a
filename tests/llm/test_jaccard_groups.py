import random

from pyspark.sql import functions as F
from test_jaccard import brute, rows_of

from vigil.llm import exchange as X
from vigil.llm import jaccard


def largest(rows, by):
    bytes_, pairs = F.sum(F.octet_length("data")), F.sum(F.col("data").isNull().cast("int"))
    return rows.groupBy(*by).agg(bytes_.alias("b"), pairs.alias("p")).agg(F.max("b"), F.max("p")).first()


def test_no_group_grows_with_a_family(spark, monkeypatch):
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join([*base[:k], f"own{i}", *base[k + 1:]])) for i, k in ((i, rnd.randrange(150)) for i in range(300))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "GROUP_BYTES", 20_000)
    monkeypatch.setattr(jaccard, "GROUP_PAIRS", 100)
    seen, groups = [], jaccard._groups

    def spy(pairs, sets):
        out = groups(pairs, sets)
        seen.append((largest(out, [X.PART]), largest(out, [X.PART, "salt"])))
        return out

    monkeypatch.setattr(jaccard, "_groups", spy)
    assert rows_of(jaccard.join(df, part_bytes=20_000)) == brute(rows)
    assert max(whole[0] or 0 for whole, _ in seen) > 200_000  # one pivot for nearly all of the family
    assert all((salted[0] or 0) < 60_000 and (salted[1] or 0) < 200 for _, salted in seen)


def test_many_pairs_of_one_part(spark, monkeypatch):
    sets = spark.createDataFrame([(i % 2, i, 4, bytes(8 * [i]) * 4) for i in range(60)], f"{X.PART} long, cls long, size long, data binary")
    pairs = sets.select(F.col("cls").alias("x")).crossJoin(sets.select(F.col("cls").alias("y"))).filter("x < y")
    monkeypatch.setattr(jaccard, "GROUP_PAIRS", 50)
    rows = jaccard._groups(pairs, sets).cache()
    assert rows.filter("data is null").count() == 60 * 59 // 2
    assert largest(rows, [X.PART])[1] > 800 and largest(rows, [X.PART, "salt"])[1] <= 240
    assert rows.filter("data is not null").groupBy(X.PART, "salt", "x").count().filter("count > 1").count() == 0


def test_signatures_never_differ_more_than_the_sets():
    import numpy as np

    from vigil.llm import jaccard as J

    rnd = np.random.default_rng(6)
    for n in (1, 5, 80, 900, 5000):
        base = rnd.integers(0, 1 << 63, n).astype(np.uint64)
        for cut in (0, n // 10, n // 2, n):
            other = np.concatenate([base[cut:], rnd.integers(0, 1 << 63, cut // 2).astype(np.uint64)])
            a, b = (J.signature(np.unique(x)) for x in (base, other))
            differ = sum(int(v).bit_count() for v in (a ^ b).view(np.uint64))
            assert differ <= len(np.setxor1d(base, other)) and (cut or differ == 0)
    unlike = (J.signature(rnd.integers(0, 1 << 63, 300).astype(np.uint64)) ^ J.signature(rnd.integers(0, 1 << 63, 300).astype(np.uint64)))
    assert sum(int(v).bit_count() for v in unlike.view(np.uint64)) > 90
