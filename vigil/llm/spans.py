"""Substring dedup by sliding sentence spans.

Every run of ``run`` consecutive sentences with ``min_words`` words or more is
hashed; runs that occur more than once over all texts keep their first
occurrence (smallest key, then hash of the text, then place), and the sentences
under any other occurrence go.  A sentence ends with a word that ends in
``.``, ``!`` or ``?``, at a line break or with the text; sentences compare by
their words, A-Z lower-cased.  A removed sentence takes the white space behind
it along.

With ``grow``, runs of short sentences go on until they reach ``min_words``: the
shortest run of ``run`` sentences or more from each sentence on and the shortest
one up to each sentence are hashed, so every sentence of a repeated passage that
is long enough lies under a run inside the passage.  A text too short for any
run is hashed as a whole and meets equal texts only.

Defined results: null and empty texts have no sentences; a null text stays
null.  A null key sorts first.  Rows equal in key and text count as one text:
they do not remove each other.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import kernel as K
from vigil.llm.tokenfile import pieces as doc_ranges

TIE, GONE = "_vg_tie", "_vg_gone"
STEP_BYTES = 1 << 20
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True


def sentences(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first word, words, first byte, sentences per text)."""
    low = K.LOWER[buf]
    s, e, per = K.words(low, off)
    hashes = K.span_hashes(low, s, e)
    if not len(s):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z, np.zeros(len(per), np.int64)
    lines = np.concatenate(([0], np.cumsum(buf == 0x0A)))
    last = _END[buf[e - 1]]
    last[:-1] |= lines[s[1:]] > lines[e[:-1]]
    stop = np.cumsum(per)[per > 0] - 1
    last[stop] = True
    ends = np.flatnonzero(last) + 1
    first = np.concatenate(([0], ends[:-1]))
    return _fold(hashes, first, ends), first, ends - first, s[first], np.diff(np.searchsorted(s[first], off))


def _fold(hashes: np.ndarray, first: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of each run of consecutive word hashes."""
    with np.errstate(over="ignore"):
        n = np.arange(len(hashes), dtype=np.uint64)
        power = np.multiply.accumulate(np.where(n == 0, np.uint64(1), np.uint64(K._M)))
        back = np.multiply.accumulate(np.where(n == 0, np.uint64(1), np.uint64(K._INV)))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * power)))
        return K.mix((total[ends] - total[first]) * back[first] + (ends - first).astype(np.uint64))


def _runs(found, run: int, min_words: int, grow: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of every run that is long enough; a place is the first
    sentence in its text, and in the lower 32 bits the number of sentences."""
    hashes, _, words, _, per = found
    text = np.repeat(np.arange(len(per)), per)
    head, tail = np.repeat(np.cumsum(per) - per, per), np.repeat(np.cumsum(per), per)
    total, at = np.concatenate(([0], np.cumsum(words))), np.arange(len(words))
    stop = np.maximum(np.searchsorted(total, total[:-1] + min_words), at + run) if grow else at + run
    use = stop <= tail
    if not grow:
        use[use] = total[stop[use]] - total[at[use]] >= min_words
    first, ends = at[use], stop[use]
    if grow:
        begin = np.minimum(np.searchsorted(total, total[1:] - min_words, "right") - 1, at + 1 - run)
        back = begin >= head
        back[back] = stop[begin[back]] != at[back] + 1  # else the same run
        alone = np.flatnonzero((per > 0) & (np.bincount(text[first], minlength=len(per)) == 0))
        first = np.concatenate((first, begin[back], (np.cumsum(per) - per)[alone]))
        ends = np.concatenate((ends, at[back] + 1, np.cumsum(per)[alone]))
    return text[first], ((first - head[first]) << 32) + ends - first, _fold(hashes, first, ends)


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 2, min_words: int = 12,
             grow: bool = False) -> DataFrame:
    """(key, tie, gone): places of the runs to remove, per text that has any."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("tie"), F.col(f"`{text_col}`").alias("text"))
    kind = docs.schema[id_col].dataType

    def spans(batches):
        for b in batches:
            buf, off = K.text_bytes(b.column("text"))
            for lo, hi in doc_ranges(buf, off, STEP_BYTES):
                text, place, h = _runs(sentences(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]), run, min_words, grow)
                rows = pa.array(text + lo)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), b.column("id").take(rows), b.column("tie").take(rows),
                                                  pa.array(place, pa.int64())], ["h", "id", "tie", "i"])

    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("id", kind), T.StructField("tie", T.LongType()), T.StructField("i", T.LongType())])
    found = narrow.mapInArrow(spans, schema)
    first = (found.groupBy("h").agg(F.min(F.struct("id", "tie", "i")).alias("m"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").drop("n"))
    later = found.join(first, "h").filter(~F.struct("id", "tie", "i").eqNullSafe(F.col("m")))
    return later.groupBy("id", "tie").agg(F.collect_set("i").alias("gone"))  # places in one text


def strip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 2, min_words: int = 12,
          grow: bool = False) -> DataFrame:
    """``docs`` with the remaining text, n_sentences, n_removed and kept_sha256."""
    extra = T.StructType.fromDDL("n_sentences long, n_removed long, kept_sha256 string")
    names = [c for c in docs.columns if c not in extra.names]
    gone = removals(docs, id_col, text_col, run, min_words, grow).withColumnsRenamed({"id": "_vg_id", "tie": "_vg_t", "gone": GONE})
    base = docs.select(*[f"`{c}`" for c in names]).withColumn(TIE, F.xxhash64(f"`{text_col}`"))
    both = base.join(gone, (F.col(TIE) == F.col("_vg_t")) & F.col(f"`{id_col}`").eqNullSafe(F.col("_vg_id")), "left").drop(TIE, "_vg_t", "_vg_id")

    def cut(batches):
        for b in batches:
            buf, off = K.text_bytes(b.column(text_col))
            for lo, hi in doc_ranges(buf, off, STEP_BYTES):
                part, own, at = b.slice(lo, hi - lo), buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
                _, _, _, begin, per = sentences(own, at)
                head = np.cumsum(per) - per
                text, sha, removed = [], [], []
                for k, places in enumerate(part.column(GONE).to_pylist()):
                    keep = np.ones(at[k + 1] - at[k], bool)
                    drop = np.zeros(per[k], bool)
                    for p in places or ():
                        drop[p >> 32:(p >> 32) + (p & 0xFFFFFFFF)] = True
                    edge = np.append(begin[head[k]:head[k] + per[k]], at[k + 1]) - at[k]
                    for p in np.flatnonzero(drop):
                        keep[edge[p]:edge[p + 1]] = False
                    left = own[at[k]:at[k + 1]][keep].tobytes()
                    text.append(left.decode())
                    sha.append(hashlib.sha256(left).hexdigest())
                    removed.append(int(drop.sum()))
                mask = part.column(text_col).is_null()
                kept = pa.array(text, pa.string(), mask=mask.to_numpy(zero_copy_only=False))
                cols = [kept if c == text_col else part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(per, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha)], [*names, *extra.names])

    schema = T.StructType([*[docs.schema[c] for c in names], *extra.fields])
    return both.mapInArrow(cut, schema)
