"""Language-model scores by deleted interpolation.

A word's probability after its context mixes the bigram and unigram
maximum-likelihood estimates and the uniform one, with weights per bucket of
the context's frequency.  Expectation-maximisation learns the weights on
held-out counts: each training token in turn is held out by taking it out of
all counts (deleted counts), so nothing is set aside.

Jobs, over text parts of bounded size: a part sends its distinct words and word
pairs with its training counts; buckets of keys add them up and answer with the
corpus counts; the parts fold their training pairs into a small histogram of
(bucket, ratio, ratio) for the fit, and score their texts with the result.
Posterior weights depend on the ratios of the three estimates alone; the
histogram holds them in steps of a sixteenth of a power of two.

Tokens are words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, then one end per
text; words are told apart by 64-bit hashes, word pairs by 40 bits inside a
bucket of about a million (one in a million is counted with another).

Defined results: null and empty texts are one end token.  Without training
rows N and V are 0 and every estimate is uniform.  Repeated rows count and
score each; a null key trains; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import exchange as X
from vigil.llm import kernel as K

END = np.uint64(0x0E5D0E5D0E5D0E5D)
START = np.uint64(0x57A857A857A857A8)
BUCKETS = 24
BUCKET_BYTES = 8 << 20  # keys and counts that a bucket task holds
TRAIN = "_vg_train"
SCORES = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
_UNI, _BI, _STATS, _MODEL = 0, 1, 2, 3
_STEPS, _MID = 16, 500  # ratio cells per power of two, cell of ratio 1
_EMPTY = 1023  # the cell of an estimate of 0


class _Tokens:
    """Tokens and contexts of a part, as indices into its distinct words and pairs."""

    def __init__(self, docs: pa.Table, text_col: str):
        buf, off = K.text_bytes(docs[text_col])
        low = K.LOWER[buf]
        s, e, words = K.words(low, off)
        self.per = words + 1
        n = int(self.per.sum())
        tok = np.full(n, END, np.uint64)
        last = np.zeros(n, bool)
        last[np.cumsum(self.per) - 1] = True
        tok[~last] = K.span_hashes(low, s, e)
        ctx = np.empty(n, np.uint64)
        ctx[1:] = tok[:-1]
        ctx[np.cumsum(self.per) - self.per] = START
        with np.errstate(over="ignore"):
            pair = K.mix(ctx * np.uint64(K._M) + tok)
        del ctx
        self.train = np.repeat(docs[TRAIN].to_numpy().astype(bool), self.per) if n else np.zeros(0, bool)
        self.words, _, inv = K.distinct(np.append(tok, START))
        del tok
        self.start_id, self.tok = int(inv[-1]), inv[:-1]
        self.ctx = np.empty(n, np.int32)
        self.ctx[1:] = self.tok[:-1]
        self.ctx[np.cumsum(self.per) - self.per] = self.start_id
        self.pairs, first, self.pair = K.distinct(pair)
        del pair
        self.pair_tok, self.pair_ctx = self.tok[first], self.ctx[first]
        self.word_n = np.bincount(self.tok[self.train], minlength=len(self.words))
        begins = np.zeros(n, bool)
        begins[np.cumsum(self.per) - self.per] = True
        self.word_n[self.start_id] = int((begins & self.train).sum())
        self.pair_n = np.bincount(self.pair[self.train], minlength=len(self.pairs))


def _bucket(count: np.ndarray) -> np.ndarray:
    """Frequency bucket of a context: 0 unseen, then by powers of two."""
    return np.minimum(BUCKETS - 1, np.frexp(count.astype(float))[1])


def _ratio(p: np.ndarray, floor: float) -> np.ndarray:
    with np.errstate(divide="ignore"):
        x = np.round(_STEPS * np.log2(p / floor)).clip(-_MID, _MID)
    return np.where(p > 0, x + _MID, _EMPTY).astype(np.int64)


def _cells(t: _Tokens, word_c: np.ndarray, pair_c: np.ndarray, total: int, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, weight) of the deleted estimates of the part's training pairs."""
    use = np.flatnonzero(t.pair_n)
    cu = word_c[t.pair_ctx[use]] - 1
    p2 = np.where(cu > 0, (pair_c[use] - 1) / np.maximum(cu, 1), 0.0)
    p1 = (word_c[t.pair_tok[use]] - 1) / max(total - 1, 1)
    floor = 1 / (distinct + 1)
    cell = (_bucket(cu) << 20) | (_ratio(p2, floor) << 10) | _ratio(p1, floor)
    cells, inv = np.unique(cell, return_inverse=True)
    return cells, np.bincount(inv, t.pair_n[use], len(cells))


def fit_weights(cells: np.ndarray, weight: np.ndarray, rounds: int = 60) -> np.ndarray:
    """EM: mixture weights (bigram, unigram, uniform) per context bucket."""
    out = np.tile([0.0, 0.9, 0.1], (BUCKETS, 1))
    value = lambda x: np.where(x == _EMPTY, 0.0, 2.0 ** ((x - _MID) / _STEPS))
    for b in np.unique(cells >> 20):
        mine = cells >> 20 == b
        c, w = cells[mine], weight[mine]
        est = np.stack([value(c >> 10 & 1023), value(c & 1023), np.ones(len(c))], axis=1)
        lam = np.array([1 / 3] * 3)
        for _ in range(rounds):
            post = est * lam
            post *= (w / post.sum(axis=1))[:, None]
            lam = post.sum(axis=0) / w.sum()
            lam = np.maximum(lam, 1e-9)
            lam /= lam.sum()
        out[b] = lam
    for b in range(1, BUCKETS):  # buckets without a training pair take the weights below
        if not (cells >> 20 == b).any():
            out[b] = out[b - 1]
    return out


def _counts(side: pa.Table, t: _Tokens, bits: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    at = X.cuts(t.words, bits[0]), X.cuts(t.pairs, bits[1])
    got = np.zeros(len(t.words), np.int64), np.zeros(len(t.pairs), np.int64)
    for kind, b, blob in zip(side["kind"].to_pylist(), side["bucket"].to_pylist(), side["blob"].to_pylist()):
        if kind in (_UNI, _BI):
            b &= 0xFFFFFF
            lo, hi = at[kind][b], at[kind][b + 1]
            got[kind][lo:hi] = X.unpack_counts(blob, hi - lo)
    return got


def _stats(side: pa.Table) -> tuple[int, int]:
    rows = side.filter(pa.array(side["kind"].to_numpy() == _STATS))
    return (rows["a"][0].as_py() or 0, rows["b"][0].as_py() or 0) if rows.num_rows else (0, 0)


def add_up(requests: DataFrame) -> DataFrame:
    """Replies with the sum of ``more`` over all parts for each key, and one
    row per word bucket with its tokens and distinct training words."""

    def answer(t: pa.Table) -> pa.Table:
        bucket = t["bucket"].to_numpy()
        kind = int(bucket[0] >> 24)
        keys = [np.frombuffer(x, np.uint64) if kind == _UNI else X.widen(x) for x in t["keys"].to_pylist()]
        count = [np.frombuffer(x, np.uint32) for x in t["more"].to_pylist()]
        every, _, inv = K.distinct(np.concatenate(keys))
        total = np.bincount(inv, np.concatenate(count), len(every)).astype(np.uint64)
        at = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
        out = X.replies(kind, t[X.PART], t["bucket"], [X.pack_counts(total[inv[i:j]]) for i, j in zip(at[:-1], at[1:])])
        if kind == _UNI:
            own = total[every != START]
            out = pa.concat_tables([out, pa.table({X.PART: [-1], "kind": [_STATS], "bucket": [0], "a": [int(own.sum())],
                                                   "b": [int((own > 0).sum())], "n": [None], "blob": [None]}, schema=X.SIDE_ARROW)])
        return out

    return requests.groupBy("bucket").applyInArrow(answer, X.SIDE)


def score(docs: DataFrame, train: Column, text_col: str = "text", part_bytes: int = X.PART_BYTES) -> DataFrame:
    """``docs`` without the text, with the columns of ``SCORES``; the model learns from the rows where ``train`` holds."""
    extra = T.StructType.fromDDL(SCORES)
    keep = [c for c in docs.columns if c != text_col and c not in extra.names]
    docs = docs.select(*[f"`{c}`" for c in keep], f"`{text_col}`", F.coalesce(train, F.lit(True)).alias(TRAIN))
    dealt, total = X.deal(docs, text_col, part_bytes)
    parts = max(1, -(-total // part_bytes))
    bits = X.bits_for(total / 4, BUCKET_BYTES), X.bits_for(2 * total, BUCKET_BYTES)

    def ask(key, t):
        x = _Tokens(t, text_col)
        part = key[0].as_py()
        cols = [X.request(part, k, n.astype(np.uint32), b, kind, short)
                for kind, k, n, b, short in ((_UNI, x.words, x.word_n, bits[0], False), (_BI, x.pairs, x.pair_n, bits[1], True))]
        return pa.concat_tables([pa.table(c, schema=X.REQUEST_ARROW) for c in cols])

    group = dealt.groupBy(X.PART)
    answers = add_up(group.applyInArrow(ask, X.REQUEST))
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias(X.PART)
    null = F.lit(None)
    stats = (answers.filter(F.col("kind") == _STATS).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
             .select(everywhere, F.lit(_STATS).alias("kind"), F.lit(0).alias("bucket"), "a", "b",
                     null.cast("long").alias("n"), null.cast("binary").alias("blob")))
    side = answers.filter(F.col("kind") != _STATS).unionByName(stats)

    def fold(key, left: pa.Table, right: pa.Table) -> pa.Table:
        x = _Tokens(left, text_col)
        cells, weight = _cells(x, *_counts(right, x, bits), *_stats(right))
        return pa.table({"cell": cells, "weight": weight.astype(float)})

    def learn(t: pa.Table) -> pa.Table:
        lam = fit_weights(t["cell"].to_numpy(), t["weight"].to_numpy())
        return pa.table({"blob": [lam.astype(float).tobytes()]})

    cells = group.cogroup(side.groupBy(X.PART)).applyInArrow(fold, "cell long, weight double")
    # the histogram has at most buckets x ratios x ratios cells, whatever the input
    model = cells.groupBy("cell").agg(F.sum("weight").alias("weight")).groupBy().applyInArrow(learn, "blob binary")
    model = model.select(everywhere, F.lit(_MODEL).alias("kind"), F.lit(0).alias("bucket"), null.cast("long").alias("a"),
                         null.cast("long").alias("b"), null.cast("long").alias("n"), "blob")

    def finish(key, left: pa.Table, right: pa.Table) -> pa.Table:
        x = _Tokens(left, text_col)
        word_c, pair_c = _counts(right, x, bits)
        n, v = _stats(right)
        rows = right.filter(pa.array(right["kind"].to_numpy() == _MODEL))
        lam = np.frombuffer(rows["blob"][0].as_py()).reshape(BUCKETS, 3) if rows.num_rows else fit_weights(np.zeros(0, np.int64), np.zeros(0))
        cu, c = word_c[x.ctx], word_c[x.tok]
        w = lam[_bucket(cu)]
        p = w[:, 0] * pair_c[x.pair] / np.maximum(cu, 1) + w[:, 1] * c / max(n, 1) + w[:, 2] / (v + 1)
        if not n:
            p = np.ones(len(c))
        at = np.cumsum(x.per) - x.per
        add = lambda y: np.add.reduceat(y, at)
        out = left.select(keep)
        for name, col in (("n_tokens", x.per), ("n_known", add((c > 0).astype(np.int64))), ("train_tokens", np.full(len(at), n)),
                          ("base_score", add(np.log10((c + 1) / (n + v + 1)))), ("score", add(np.log10(p)))):
            out = out.append_column(name, pa.array(col, pa.float64() if "score" in name else pa.int64()))
        return out

    schema = T.StructType([*[f for f in docs.schema.fields if f.name in keep], *extra.fields])
    return group.cogroup(side.unionByName(model).groupBy(X.PART)).applyInArrow(finish, schema)
