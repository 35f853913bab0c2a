import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from vigil.llm import lm
from vigil.llm.queries import QUERIES


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</end>"]


def brute(rows):
    """{row: (n_tokens, n_known, N, base, score)} with the weights fitted on exact deleted estimates, per bucket."""
    uni, bi, ctx = Counter(), Counter(), Counter()
    for _, text, train in rows:
        if train:
            t = tokens(text)
            uni.update(t)
            bi.update(zip(["<s>", *t[:-1]], t))
            ctx.update(["<s>", *t[:-1]])
    n, v = sum(uni.values()), len(uni)
    bucket = lambda c: min(lm.BUCKETS - 1, math.frexp(c)[1])
    data = {}
    for (a, b), c in bi.items():
        cu = ctx[a] - 1
        est = [(c - 1) / cu if cu else 0, (uni[b] - 1) / max(n - 1, 1), 1 / (v + 1)]
        data.setdefault(bucket(cu), []).append((c, est))
    lam, last = {}, [0.0, 0.9, 0.1]
    for b in range(lm.BUCKETS):
        if b in data:
            w = np.array([c for c, _ in data[b]], float)
            e = np.array([x for _, x in data[b]])
            q = np.full(3, 1 / 3)
            for _ in range(60):
                post = e * q
                post *= (w / post.sum(axis=1))[:, None]
                q = np.maximum(post.sum(axis=0) / w.sum(), 1e-9)
                q /= q.sum()
            last = q
        lam[b] = last
    out = {}
    for key, text, _ in rows:
        t = tokens(text)
        base = sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in t)
        s = 0.0
        for a, b in zip(["<s>", *t[:-1]], t):
            q = lam[bucket(ctx[a])]
            s += math.log10(q[0] * bi[a, b] / max(ctx[a], 1) + q[1] * uni[b] / max(n, 1) + q[2] / (v + 1)) if n else 0.0
        out[key] = (len(t), sum(uni[x] > 0 for x in t), n, base, s)
    return out


def check(df, rows):
    want = brute(rows)
    for r in df.collect():
        a = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == a[:3]
        assert math.isclose(r.base_score, a[3], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(r.score - a[4]) <= 0.02 * abs(a[4]) + 1e-9  # ratios are held in steps


def test_documents_table(spark, sf):
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 != 2) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = QUERIES["op9_lm_scoring"](spark, sf)
    check(df, rows)
    held = df.filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_edge_cases_and_parts(spark):
    rows = [(1, None, True), (2, "", True), (3, "A b a\tB", True), (4, "c c c", False), (5, "é É a", True), (6, "x" * 70000, True), (7, "a b", False)]
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, t boolean, score double")
    check(lm.score(df, F.col("t"), part_bytes=10), rows)
    none = [(a, b, False) for a, b, _ in rows]
    check(lm.score(df, F.lit(False)), none)
    assert lm.score(df.limit(0), F.col("t")).collect() == []
    twice = lm.score(df.unionByName(df), F.col("t"), part_bytes=10)
    assert twice.count() == 14 and {r.train_tokens for r in twice.collect()} == {2 * sum(len(tokens(b)) for _, b, t in rows if t)}
