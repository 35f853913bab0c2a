"""Benchmark decontamination: BM25 index of the test items, block-max WAND, overlap check.

The items are indexed by word trigrams.  An item's impacts are BM25 weights
divided by the item's score for its own text, so a query scores between 0 and 1
where it holds each of the item's trigrams at most once.  Every passage of
every document is a query; passages are windows twice as long as the longest
item, one item apart, so an item in one piece lies whole in a passage.  WAND
with block maxima retrieves all items at or above the threshold.  A hit is
verified on the passage: five-word shingles of the whole item, and the words of
its question and of its answer (the last sentence; in one sentence, the last
third of the words).

The index goes to the tasks by broadcast in shards of at most ``index_bytes``
of item text; further shards are further passes over the documents.

Defined results: null and empty texts hold nothing; items without words are
never found; repeated items are found each; an item of fewer than three (five)
words counts as one trigram (shingle).  Repeated rows keep their own results.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import kernel as K
from vigil.llm.tokenfile import pieces as doc_ranges

TERM, SHINGLE, BLOCK = 3, 5, 64
K1, B = 1.2, 0.75


def _hashes(text: str) -> np.ndarray:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    low = K.LOWER[raw]
    s, e, _ = K.words(low, np.array([0, len(raw)]))
    return K.span_hashes(low, s, e)


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    return K.shingles(words, np.array([len(words)]), size)[0]


def question_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer; in one sentence, the last third of the words."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if p]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    w = text.split()
    k = max(1, len(w) - len(w) // 3)
    return " ".join(w[:k]), " ".join(w[k:])


class Index:
    """Postings with block maxima over (item id, text) pairs."""

    def __init__(self, items: list[tuple]):
        words = [_hashes(t) for _, t in items]
        keep = [i for i, w in enumerate(words) if len(w)]
        self.ids = [items[i][0] for i in keep]
        self.words = [words[i] for i in keep]
        self.parts = [tuple(map(_hashes, question_answer(items[i][1]))) for i in keep]
        self.shingles = [np.unique(_runs(w, SHINGLE)) for w in self.words]
        self.longest = max((len(w) for w in self.words), default=1)
        terms = [Counter(_runs(w, TERM).tolist()) for w in self.words]
        df = Counter(t for c in terms for t in c)
        n = len(terms)
        mean = sum(sum(c.values()) for c in terms) / max(n, 1)
        post: dict[int, list] = {t: [] for t in df}
        for d, c in enumerate(terms):
            norm = K1 * (1 - B + B * sum(c.values()) / mean)
            raw = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + norm) for t, f in c.items()}
            own = sum(raw.values())
            for t, w in raw.items():
                post[t].append((d, w / own))
        self.terms = np.array(sorted(post), np.uint64)
        self.items = [[d for d, _ in post[t]] for t in self.terms.tolist()]
        self.weights = [[w for _, w in post[t]] for t in self.terms.tolist()]
        self.maxima = [[max(w[i:i + BLOCK]) for i in range(0, len(w), BLOCK)] for w in self.weights]
        self.most = np.array([max(m) for m in self.maxima])

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All (item, score) with a score of ``threshold`` or more, for distinct
        term numbers: block-max WAND."""
        cursor = [[self.items[t][0], t, 0] for t in terms]
        found, end = [], len(self.words)
        eps = threshold - 1e-12
        while cursor:
            cursor.sort()
            bound, pivot = 0.0, None
            for k, (d, t, _) in enumerate(cursor):
                bound += self.most[t]
                if bound >= eps:
                    pivot = k
                    break
            if pivot is None:
                break
            item = cursor[pivot][0]
            while pivot + 1 < len(cursor) and cursor[pivot + 1][0] == item:
                pivot += 1
            # the blocks that hold the pivot item, and where the first of them ends
            bound, skip = 0.0, end
            for d, t, at in cursor[:pivot + 1]:
                block = bisect_left(self.items[t], item, at) // BLOCK
                if block < len(self.maxima[t]):
                    bound += self.maxima[t][block]
                    last = min(len(self.items[t]), (block + 1) * BLOCK) - 1
                    skip = min(skip, self.items[t][last] + 1)
            if bound < eps:  # no item up to the nearest block end can make it
                if pivot + 1 < len(cursor):
                    skip = min(skip, cursor[pivot + 1][0])
                target = max(skip, item + 1)
            elif cursor[0][0] == item:
                score = sum(self.weights[t][at] for d, t, at in cursor[:pivot + 1])
                if score >= eps:
                    found.append((item, score))
                target = item + 1
            else:
                target = item
            for c in cursor[:pivot + 1]:
                if c[0] < target:
                    c[2] = bisect_left(self.items[c[1]], target, c[2])
                    c[0] = self.items[c[1]][c[2]] if c[2] < len(self.items[c[1]]) else end
            cursor = [c for c in cursor if c[0] < end]
        return found

    def overlaps(self, item: int, passage: np.ndarray) -> tuple[float, float, float]:
        """Shares of the item's shingles, question words and answer words that the passage holds."""
        shingles = self.shingles[item]
        size = min(SHINGLE, len(self.words[item]))  # an item of fewer words is one shingle
        have = np.unique(_runs(passage, SHINGLE)) if size == SHINGLE else np.unique(
            np.concatenate([_runs(passage[i:i + size], SHINGLE) for i in range(len(passage) - size + 1)] or [np.zeros(0, np.uint64)]))
        whole = float(K.member(have, shingles).mean())
        inside = np.unique(passage)
        q, a = (float(K.member(inside, p).mean()) if len(p) else 1.0 for p in self.parts[item])
        return whole, q, a


def _hits(index: Index, words: np.ndarray, per: np.ndarray, threshold: float, overlap: float) -> list[tuple]:
    """(document, item, score, shingle, question and answer overlap), best passage of each pair."""
    if not (index.ids and len(words)):
        return []
    best: dict[tuple[int, int], tuple] = {}
    sizes = {min(TERM, len(w)) for w in index.words}
    step = index.longest
    first = np.cumsum(per) - per
    at, term, size = [], [], []
    for n in sizes:  # items of one or two words are looked up at their own length
        run = np.zeros(len(words), np.uint64)
        doc = np.repeat(np.arange(len(per)), per)
        ok = np.flatnonzero((np.arange(len(words)) + n <= len(words)) & (np.append(doc, -1)[np.minimum(np.arange(len(words)) + n - 1, len(words))] == doc))
        for k in range(n):
            run[ok] = K.mix(run[ok] * np.uint64(K._M) + words[ok + k] + np.uint64(k + 1))
        ok = ok[K.member(index.terms, run[ok])]
        at.append(ok)
        term.append(np.searchsorted(index.terms, run[ok]))
        size.append(np.full(len(ok), n))
    at, term, size = (np.concatenate(x) for x in (at, term, size))
    if not len(at):
        return []
    doc = np.searchsorted(np.cumsum(per), at, "right")
    local = at - first[doc]
    window = local // step  # passage w covers steps w and w + 1 of its document
    keys = np.concatenate((np.stack((doc, window, term), 1), np.stack((doc, window - 1, term), 1)[(window > 0)
                          & ((local + size - 1) // step <= window)]))
    keys = np.unique(keys, axis=0)
    # beyond its first step a passage has to end before the term does; those were left out above
    place = keys[:, 0] * (1 << 40) + keys[:, 1]
    head = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    bound = np.add.reduceat(index.most[keys[:, 2]], head)
    for k in np.flatnonzero(bound >= threshold - 1e-12):  # elsewhere WAND finds no pivot
        lo, hi = head[k], head[k + 1] if k + 1 < len(head) else len(keys)
        d, w = int(keys[lo, 0]), int(keys[lo, 1])
        found = index.search(keys[lo:hi, 2].tolist(), threshold)
        if found:
            i = first[d] + w * step
            passage = words[i:min(i + 2 * step, first[d] + per[d])]
            for item, score in found:
                seen = index.overlaps(item, passage)
                if min(seen) >= overlap and (score,) > best.get((d, item), (-1.0,))[:1]:
                    best[d, item] = (min(score, 1.0), *seen)
    return [(d, item, *v) for (d, item), v in sorted(best.items())]


def shards(items: DataFrame, id_col: str, text_col: str, index_bytes: int) -> list:
    """Broadcast indexes, each over at most about ``index_bytes`` of item text."""
    size = items.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    n = max(1, -(-size // index_bytes))
    shard = F.pmod(F.xxhash64(f"`{id_col}`", f"`{text_col}`"), F.lit(n))
    out = []
    for k in range(n):
        rows = items.filter(shard == k).select(f"`{id_col}`", f"`{text_col}`").collect()  # bounded by index_bytes
        rows.sort(key=lambda r: (r[0] is not None, r[0], r[1] or ""))
        out.append(items.sparkSession.sparkContext.broadcast(Index([(r[0], r[1] or "") for r in rows])))
    return out


def _texts(batch, text_col):
    """(first row, last row, word hashes, words per row) of slices of about 1 MB."""
    buf, off = K.text_bytes(batch.column(text_col))
    for lo, hi in doc_ranges(buf, off, 1 << 20):
        low = K.LOWER[buf[off[lo]:off[hi]]]
        s, e, per = K.words(low, off[lo:hi + 1] - off[lo])
        yield lo, hi, K.span_hashes(low, s, e), per


def find(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
         threshold: float = 0.5, overlap: float = 0.8, index_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` without the text, one row per document and verified item:
    item_id, bm25, shingle_overlap, question_overlap, answer_overlap."""
    extra = ["item_id", "bm25", "shingle_overlap", "question_overlap", "answer_overlap"]
    keep = [f for f in docs.schema.fields if f.name != text_col and f.name not in extra]
    names = [f.name for f in keep]
    kind = items.schema[item_id].dataType
    schema = T.StructType([*keep, T.StructField("item_id", kind), *[T.StructField(n, T.DoubleType()) for n in extra[1:]]])
    out = None
    for box in shards(items, item_id, item_text, index_bytes):

        def run(batches, box=box):
            index = box.value
            for b in batches:
                rows = [(lo + d, *rest) for lo, _, words, per in _texts(b, text_col) for d, *rest in _hits(index, words, per, threshold, overlap)]
                if rows:
                    took = b.select(names).take(pa.array([r[0] for r in rows], pa.int64())) if names else None
                    cols = [took.column(n) for n in names] + [pa.array([index.ids[r[1]] for r in rows])] + [
                        pa.array([float(r[k]) for r in rows]) for k in (2, 3, 4, 5)]
                    yield pa.RecordBatch.from_arrays(cols, names + extra)

        part = docs.select(*[f"`{n}`" for n in names], f"`{text_col}`").mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
          threshold: float = 0.5, overlap: float = 0.8, index_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` without the rows that hold a verified item."""
    for box in shards(items, item_id, item_text, index_bytes):

        def run(batches, box=box):
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for lo, _, words, per in _texts(b, text_col):
                    for d, *_ in _hits(box.value, words, per, threshold, overlap):
                        keep[lo + d] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
