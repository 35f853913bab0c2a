"""Packed requests and replies between text parts and key buckets.

Texts are dealt into parts of bounded size by a hash of the row.  A part sends
its distinct 64-bit keys, sorted and cut by their leading bits into buckets, as
one binary cell per bucket; a bucket sees every part's keys at once and answers
each request in its order.  Keys are made distinct inside the part first, so a
hot key reaches a bucket once per part however many rows hold it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.kernel import sorted_unique

PART = "_vg_part"
SIDE = f"{PART} long, kind int, bucket int, a long, b long, n long, blob binary"
REQUEST = f"{PART} long, bucket int, size long, keys binary, more binary"

PART_BYTES = 8 << 20
BUCKET_BYTES = 32 << 20


def part_of(docs: DataFrame, cols: list[str], parts: int):
    """Part number from a hash of the given columns; repeated rows share a part."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), F.lit(parts))


def deal(docs: DataFrame, text_col: str, part_bytes: int = PART_BYTES, keys: list[str] | None = None) -> tuple[DataFrame, int]:
    """``docs`` with a part number (by the text and ``keys``, default all other
    numbers and strings), and the total bytes of the texts."""
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")).cast("long"))).first()[0] or 0
    if keys is None:
        keys = [f.name for f in docs.schema.fields if f.name != text_col and f.dataType.typeName() in ("long", "integer", "string")]
    return docs.withColumn(PART, part_of(docs, [text_col, *keys], max(1, -(-total // part_bytes)))), total


def bits_for(n_bytes: float, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Leading bits that name a bucket when so many bytes of keys are expected."""
    k = 0
    while n_bytes > bucket_bytes << k and k < 24:
        k += 1
    return k


def cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bounds of the buckets in ascending ``keys``: ``2 ** bits + 1`` positions."""
    if not bits:
        return np.array([0, len(keys)])
    low = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate(([0], np.searchsorted(keys, low), [len(keys)]))


def request(part: int, keys: np.ndarray, more: np.ndarray, bits: int, kind: int = 0, short: bool = False) -> dict:
    """Columns of the requests for ascending distinct ``keys`` (``short``: as 40
    bits each); ``more`` is one value per key that travels along."""
    at = cuts(keys, bits)
    full = np.flatnonzero(np.diff(at))
    parts = [keys[at[b]:at[b + 1]] for b in full]
    return {PART: [part] * len(full), "bucket": (full + (kind << 24)).tolist(), "size": np.diff(at)[full].tolist(),
            "keys": [narrow(k, bits) if short else k.tobytes() for k in parts], "more": [more[at[b]:at[b + 1]].tobytes() for b in full]}


REQUEST_ARROW = pa.schema([(PART, pa.int64()), ("bucket", pa.int32()), ("size", pa.int64()), ("keys", pa.binary()), ("more", pa.binary())])
SIDE_ARROW = pa.schema([(PART, pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("a", pa.int64()), ("b", pa.int64()),
                        ("n", pa.int64()), ("blob", pa.binary())])


def replies(kind: int, parts, buckets, blobs) -> pa.Table:
    k = len(blobs)
    return pa.table({PART: parts, "kind": [kind] * k, "bucket": buckets, "a": [None] * k, "b": [None] * k,
                     "n": [None] * k, "blob": blobs}, schema=SIDE_ARROW)


def repeated(requests: DataFrame, kind: int, short: bool = False) -> DataFrame:
    """Replies one bit per key: does it occur more than once over all parts?
    ``more`` holds a byte per key, 1 where the part itself has it twice.
    ``short``: keys come in 40 bits, of which a clash counts as a repeat."""

    def answer(t: pa.Table) -> pa.Table:
        keys = [widen(x) if short else np.frombuffer(x, np.uint64) for x in t["keys"].to_pylist()]
        twice = [k[np.frombuffer(m, np.uint8) > 0] for k, m in zip(keys, t["more"].to_pylist())]
        every, n = sorted_unique(np.concatenate(keys))
        found = np.union1d(every[n > 1], np.concatenate(twice))
        out = []
        for k in keys:
            at = np.searchsorted(found, k)
            hit = np.zeros(len(k), bool)
            ok = at < len(found)
            hit[ok] = found[at[ok]] == k[ok]
            out.append(np.packbits(hit).tobytes())
        return replies(kind, t[PART], t["bucket"], out)

    return requests.groupBy("bucket").applyInArrow(answer, SIDE)


def answered(side: pa.Table, kind: int, keys: np.ndarray, bits: int) -> np.ndarray:
    """The part's ascending ``keys`` for which the replies of ``kind`` say yes."""
    at = cuts(keys, bits)
    hit = np.zeros(len(keys), bool)
    for k, b, blob in zip(side["kind"].to_pylist(), side["bucket"].to_pylist(), side["blob"].to_pylist()):
        if k == kind:
            lo, hi = at[b], at[b + 1]
            hit[lo:hi] = np.unpackbits(np.frombuffer(blob, np.uint8), count=hi - lo).astype(bool)
    return keys[hit]


def narrow(keys: np.ndarray, bits: int) -> bytes:
    """40 bits of each key below the bucket's.  A bucket holds about a million
    keys, so one key in a million shares its 40 bits with another; equal keys
    stay equal and in order."""
    return np.ascontiguousarray(((keys << np.uint64(bits)) >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def widen(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view(np.uint64).ravel()


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte per count, and eight more for each of 255 or above."""
    big = counts >= 255
    return np.where(big, 255, counts).astype(np.uint8).tobytes() + counts[big].astype("<u8").tobytes()


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<u8", -1, n)
    return out
