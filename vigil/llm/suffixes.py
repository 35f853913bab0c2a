"""Suffix-array dedup with a difference cover, blockwise.

A byte is removed if some ``width``-byte string over it also starts anywhere
else (same document included).  Two suffixes share ``width`` leading bytes only
if, at some distance below the cover's period, both meet a cover sample, and
from there they share ``width - period + 1`` bytes.  So:

1. cover samples (a few per cent of all positions) are ranked first: each is
   named by the hash of its leading ``width - period + 1`` bytes, and the names
   that occur twice are found one bucket of names at a time;
2. only suffixes that reach such a sample within a period can be tied over
   ``width`` bytes; they are dealt into buckets by the hash of their leading
   ``width`` bytes, and each bucket is sorted by itself: equal neighbours are
   repeats.  The order inside a bucket is that of the hash, which is enough
   for equality;
3. every part turns its repeated suffixes into runs of removed bytes.

Equal whole texts are folded to one first (128-bit hashes), so a group of
copies costs one text.  Hashes have 64 bits: a false repeat needs two of the
candidate suffixes to collide.

Defined results: null and empty texts have no bytes and lose none; texts
shorter than ``width`` lose none; repeated rows count as copies of each other;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import exchange as X
from vigil.llm import kernel as K

H1, H2 = "_vg_h1", "_vg_h2"
DIGEST = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_starts array<long>, span_ends array<long>"


def difference_cover(width: int) -> tuple[np.ndarray, int]:
    """A difference cover (Colbourn and Ling's rule for r) and its period, the
    largest that leaves a fifth of ``width`` (16 bytes at least) to a sample."""
    period = lambda r: 24 * r * r + 36 * r + 13
    if width < 29:
        raise ValueError("width must be 29 bytes at least")
    r = 0
    while period(r + 1) <= width - max(16, min(64, width // 5)) + 1:
        r += 1
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return np.concatenate(([0], np.cumsum(steps))) % period(r), period(r)


class _Part:
    """One part's texts; ``live`` documents take part in the comparison, those
    in ``copies`` have an equal text somewhere and go as a whole."""

    def __init__(self, docs: pa.Table, side: pa.Table, text_col: str, width: int):
        self.buf, self.off = K.text_bytes(docs[text_col])
        self.width = width
        self.size = np.diff(self.off)
        n = len(self.size)
        self.copies, self.live = np.zeros(n, bool), self.size >= width
        kinds = side["kind"].to_numpy()
        groups = {}
        if (kinds == 0).any():
            rows = side.filter(pa.array(kinds == 0))
            groups = dict(zip(zip(rows["a"].to_pylist(), rows["b"].to_pylist()), rows["n"].to_pylist()))
        seen = set()
        if groups:
            for i, key in enumerate(zip(docs[H1].to_pylist(), docs[H2].to_pylist())):
                if self.live[i] and key in groups:
                    self.copies[i] = True
                    self.live[i] = groups[key] == 1 and key not in seen  # one row of the leading part stays in
                    seen.add(key)

    def samples(self) -> np.ndarray:
        cover, period = difference_cover(self.width)
        w = self.width - period + 1
        ids = np.flatnonzero(self.live)
        longest = int(self.size[ids].max()) if len(ids) else 0
        grid = (np.arange(longest // period + 1)[:, None] * period + np.sort(cover)[None, :]).ravel()
        per = np.searchsorted(grid, self.size[ids] - w, "right")
        return grid[K.ragged(per)] + np.repeat(self.off[ids], per), w, period

    def candidates(self, side: pa.Table, bits: int) -> np.ndarray:
        """Positions from which a repeated cover sample lies within a period."""
        at, w, period = self.samples()
        names = K.window_hashes(self.buf, at, w)
        keys, _ = K.sorted_unique(names)
        at = at[K.member(X.answered(side, 1, keys, bits), names)]
        doc = np.searchsorted(self.off, at, "right") - 1
        lo = np.maximum(at - period + 1, self.off[doc])
        hi = np.minimum(at, self.off[doc + 1] - self.width) + 1
        ok = hi > lo
        step = np.zeros(len(self.buf) + 1, np.int32)
        np.add.at(step, lo[ok], 1)
        np.add.at(step, hi[ok], -1)
        return np.flatnonzero(np.cumsum(step[:-1]))

    def removed(self, side: pa.Table, bits: tuple[int, int]) -> np.ndarray:
        """Mask of the removed bytes."""
        at = self.candidates(side, bits[0])
        heads = K.window_hashes(self.buf, at, self.width)
        keys, _ = K.sorted_unique(heads)
        at = at[K.member(X.answered(side, 2, keys, bits[1]), heads)]
        step = np.zeros(len(self.buf) + 1, np.int32)
        np.add.at(step, at, 1)
        np.add.at(step, at + self.width, -1)
        mask = np.cumsum(step[:-1]) > 0
        for i in np.flatnonzero(self.copies):
            mask[self.off[i]:self.off[i + 1]] = True
        return mask


def _ask(part: int, hashes: np.ndarray, bits: int, short: bool = False) -> pa.Table:
    keys, n = K.sorted_unique(hashes)
    return pa.table(X.request(part, keys, (n > 1).astype(np.uint8), bits, short=short), schema=X.REQUEST_ARROW)


def _plan(docs: DataFrame, text_col: str, width: int, part_bytes: int):
    """(dealt docs, side table with all replies, bits of the two rounds)."""
    t = F.col(f"`{text_col}`")
    dealt, total = X.deal(docs, text_col, part_bytes)
    dealt = dealt.withColumns({H1: F.xxhash64(t), H2: F.xxhash64(F.lit(1), t)})
    cover, period = difference_cover(width)
    bits = X.bits_for(8 * total * len(cover) / period), X.bits_for(4 * total)
    whole = (dealt.filter(F.octet_length(t) >= width).groupBy(H1, H2, X.PART).agg(F.count(F.lit(1)).alias("n")))
    twice = (whole.groupBy(H1, H2).agg(F.sum("n").alias("n"), F.min(X.PART).alias("lead")).filter("n > 1"))
    copies = (whole.drop("n").join(twice.drop("n"), [H1, H2])
              .select(F.col(X.PART).alias(X.PART), F.lit(0).alias("kind"), F.lit(0).alias("bucket"), F.col(H1).alias("a"), F.col(H2).alias("b"),
                      (F.col(X.PART) == F.col("lead")).cast("long").alias("n"), F.lit(None).cast("binary").alias("blob")))

    def ask_names(key, left: pa.Table, right: pa.Table) -> pa.Table:
        p = _Part(left, right, text_col, width)
        at, w, _ = p.samples()
        return _ask(key[0].as_py(), K.window_hashes(p.buf, at, w), bits[0], short=True)  # a clash only adds candidates

    def ask_heads(key, left: pa.Table, right: pa.Table) -> pa.Table:
        p = _Part(left, right, text_col, width)
        return _ask(key[0].as_py(), K.window_hashes(p.buf, p.candidates(right, bits[0]), width), bits[1])

    pair = lambda side: dealt.groupBy(X.PART).cogroup(side.groupBy(X.PART))
    names = X.repeated(pair(copies).applyInArrow(ask_names, X.REQUEST), 1, short=True)
    side = copies.unionByName(names)
    heads = X.repeated(pair(side).applyInArrow(ask_heads, X.REQUEST), 2)
    return pair(side.unionByName(heads)), bits


def _fields(docs: DataFrame, names: list[str]) -> list[T.StructField]:
    return [f for f in docs.schema.fields if f.name in names]


def digest(docs: DataFrame, text_col: str = "text", width: int = 400, part_bytes: int = X.PART_BYTES) -> DataFrame:
    """Per row: the other columns, byte counts, SHA-256 of the remaining bytes and the removed spans."""
    extra = T.StructType.fromDDL(DIGEST)
    carry = [c for c in docs.columns if c != text_col and c not in extra.names]
    docs = docs.select(*[f"`{c}`" for c in carry], f"`{text_col}`")
    both, bits = _plan(docs, text_col, width, part_bytes)

    def finish(key, left: pa.Table, right: pa.Table) -> pa.Table:
        p = _Part(left, right, text_col, width)
        mask = p.removed(right, bits)
        edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
        cols = {k: [] for k in extra.names}
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        for lo, hi in zip(p.off[:-1].tolist(), p.off[1:].tolist()):
            a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, hi, "left")
            s = np.maximum(starts[a:b], lo)  # runs of neighbouring documents touch in the buffer
            e = np.minimum(ends[a:b], hi)
            kept = p.buf[lo:hi] if a == b else p.buf[lo:hi][~mask[lo:hi]]
            for k, v in zip(extra.names, (hi - lo, int((e - s).sum()), int(b - a), hashlib.sha256(kept.tobytes()).hexdigest(),
                                          (s - lo).tolist(), (e - lo).tolist())):
                cols[k].append(v)
        out = left.select(carry)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for k, kind in zip(extra.names, kinds):
            out = out.append_column(k, pa.array(cols[k], kind))
        return out

    return both.applyInArrow(finish, T.StructType([*_fields(docs, carry), *extra.fields]))


def strip(docs: DataFrame, text_col: str = "text", width: int = 400, part_bytes: int = X.PART_BYTES) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text.  A character of
    which only some bytes are repeated stays whole; a null text stays null."""
    both, bits = _plan(docs, text_col, width, part_bytes)
    names = docs.columns

    def finish(key, left: pa.Table, right: pa.Table) -> pa.Table:
        p = _Part(left, right, text_col, width)
        mask = p.removed(right, bits)
        lead = (p.buf & 0xC0) != 0x80
        first = np.flatnonzero(lead)
        whole = np.minimum.reduceat(mask, first) if len(first) else mask[:0]
        keep = ~np.repeat(whole, np.diff(np.append(first, len(mask))))
        text = [None if not ok else p.buf[lo:hi][keep[lo:hi]].tobytes().decode()
                for ok, lo, hi in zip(left[text_col].is_valid().to_pylist(), p.off[:-1].tolist(), p.off[1:].tolist())]
        k = names.index(text_col)
        return left.select(names).set_column(k, text_col, pa.array(text, left[text_col].type))

    return both.applyInArrow(finish, docs.schema)
