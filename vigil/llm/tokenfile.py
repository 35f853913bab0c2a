"""Token-ID files: patched frame-of-reference blocks.

Ids are cut into blocks of 128.  A block stores its minimum, packs the
differences at the width that holds a given percentile of them, and lists the
wider ones as exceptions (position, value).  A shard is one byte string: header,
document ids and lengths, an index of block starts, blocks.  Shards are rows of
Parquet files written through Spark, in ascending document order.

Shard layout (little endian): magic ``PFOR``, version u32, documents u64, ids
u64, blocks u64; document ids i64 with a validity byte each; document lengths
u64; block starts u64 (from the first block); blocks: minimum u32, width u8,
exceptions u8, packed words u64 x 2 x width, exception positions u8, exception
values u32.

Defined results: null and empty texts encode to the end id alone.  A null
document id sorts first.  Rows that share an id follow each other in the order
of a hash of their text.  An empty table gives no shards.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import kernel as K
from vigil.session import work_dir

BLOCK = 128
SHARD_IDS = 1 << 19
MAGIC = b"PFOR"
_VERSION = 1


# ---------------------------------------------------------------- blocks

def _width(x: np.ndarray) -> np.ndarray:
    """Bits of each value."""
    return np.where(x > 0, np.frexp(x.astype(np.float64))[1], 0)


def pack_blocks(ids: np.ndarray, percentile: float = 90.0) -> tuple[np.ndarray, bytes]:
    """(block starts, bytes) of the ids."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), b""
    grid = np.full(n * BLOCK, ids[-1], np.uint32)
    grid[:len(ids)] = ids
    grid = grid.reshape(n, BLOCK)
    low = grid.min(axis=1)
    diff = grid - low[:, None]
    rank = min(BLOCK - 1, max(0, int(np.ceil(percentile / 100 * BLOCK)) - 1))
    width = _width(np.partition(diff, rank, axis=1)[:, rank])
    wide = diff >> np.minimum(width, 31).astype(np.uint32)[:, None] > 0
    wide &= (width < 32)[:, None]
    patches = wide.sum(axis=1)
    size = 6 + 16 * width + 5 * patches
    starts = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.uint64)
    out = np.zeros(int(size.sum()), np.uint8)
    base = starts.astype(np.int64)
    out[base[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(n, 4)
    out[base + 4] = width
    out[base + 5] = patches
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        words = np.zeros((2 * w, len(rows)), np.uint64)
        values = (diff[rows] & np.uint32((1 << int(w)) - 1)).T.astype(np.uint64)
        for k in range(BLOCK):
            at, shift = divmod(k * int(w), 64)
            words[at] |= values[k] << np.uint64(shift)
            if shift + w > 64:
                words[at + 1] |= values[k] >> np.uint64(64 - shift)
        raw = np.ascontiguousarray(words.T).astype("<u8").view(np.uint8).reshape(len(rows), -1)
        out[(base[rows] + 6)[:, None] + np.arange(raw.shape[1])] = raw
    row, pos = np.nonzero(wide)
    nth = K.ragged(patches)
    first = base[row] + 6 + 16 * width[row]
    out[first + nth] = pos
    at = first + patches[row] + 4 * nth
    out[at[:, None] + np.arange(4)] = diff[row, pos].astype("<u4").view(np.uint8).reshape(-1, 4)
    return starts, out.tobytes()


def unpack_blocks(starts: np.ndarray, data: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of consecutive blocks; ``starts`` index into ``data`` (bytes)."""
    n = len(starts)
    base = starts.astype(np.int64)
    low = np.ascontiguousarray(data[base[:, None] + np.arange(4)]).view("<u4").reshape(n)
    width, patches = data[base + 4].astype(np.int64), data[base + 5].astype(np.int64)
    diff = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        raw = np.ascontiguousarray(data[(base[rows] + 6)[:, None] + np.arange(16 * w)])
        words = np.ascontiguousarray(raw.view("<u8").T)
        values = np.empty((BLOCK, len(rows)), np.uint32)
        for k in range(BLOCK):
            at, shift = divmod(k * int(w), 64)
            x = words[at] >> np.uint64(shift)
            if shift + w > 64:
                x = x | (words[at + 1] << np.uint64(64 - shift))
            values[k] = x & np.uint64((1 << int(w)) - 1)
        diff[rows] = values.T
    row = np.repeat(np.arange(n), patches)
    first = base[row] + 6 + 16 * width[row]
    nth = K.ragged(patches)
    at = first + patches[row] + 4 * nth
    if len(row):
        diff[row, data[first + nth]] = np.ascontiguousarray(data[at[:, None] + np.arange(4)]).view("<u4").reshape(-1)
    return (diff + low[:, None]).reshape(-1)[:n_ids]


def write_shard(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, percentile: float = 90.0) -> bytes:
    starts, blocks = pack_blocks(ids, percentile)
    head = MAGIC + np.array([_VERSION], "<u4").tobytes() + np.array([len(doc_ids), len(ids), len(starts)], "<u8").tobytes()
    known = np.array([x is not None for x in doc_ids], np.uint8)
    names = np.array([0 if x is None else x for x in doc_ids], "<i8")
    return b"".join((head, names.tobytes(), known.tobytes(), lengths.astype("<u8").tobytes(), starts.astype("<u8").tobytes(), blocks))


def read_shard(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, lengths, ids)."""
    if data[:4] != MAGIC or int(np.frombuffer(data, "<u4", 1, 4)[0]) != _VERSION:
        raise ValueError("not a token shard")
    docs, n, blocks = (int(x) for x in np.frombuffer(data, "<u8", 3, 8))
    names = np.frombuffer(data, "<i8", docs, 32)
    known = np.frombuffer(data, np.uint8, docs, 32 + 8 * docs)
    lengths = np.frombuffer(data, "<u8", docs, 32 + 9 * docs).astype(np.int64)
    at = 32 + 17 * docs
    starts = np.frombuffer(data, "<u8", blocks, at)
    ids = unpack_blocks(starts, np.frombuffer(data, np.uint8, -1, at + 8 * blocks), n)
    return [int(x) if ok else None for x, ok in zip(names, known)], lengths, ids


# ---------------------------------------------------------------- tokenizer

class Encoder:
    """Token ids of texts through the tokenizers library, one call per distinct chunk.

    A text is cut where the byte-level pre-tokenizer always breaks: before the
    first space of a run that follows a visible character, and after a single
    line break between visible characters.  Chunks are then independent of each
    other, and those met before come from a bounded cache."""

    def __init__(self, path: str, cached: int = 3_000_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        self._forget()

    def _forget(self):
        """Empties the cache: ascending chunk hashes, where their ids begin in ``flat``, and how many they are."""
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0

    def _learn(self, keys: np.ndarray, texts: list[str]):
        """Encodes new chunks, given with their ascending hashes."""
        size, ids = [], []
        for lo in range(0, len(texts), 50_000):
            got = self.tokenizer.encode_batch_fast(texts[lo:lo + 50_000], add_special_tokens=False)
            size += map(len, got)
            ids.append(np.fromiter(chain.from_iterable(e.ids for e in got), np.uint32))
        size, ids = np.array(size, np.int64), np.concatenate(ids)
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat[:self.used], np.zeros(max(len(self.flat), len(ids)), np.uint32)))
        self.flat[self.used:self.used + len(ids)] = ids
        at = self.used + np.cumsum(size) - size
        self.used += len(ids)
        order = np.argsort(np.concatenate((self.keys, keys)), kind="stable")
        self.keys = np.concatenate((self.keys, keys))[order]
        self.at, self.size = np.concatenate((self.at, at))[order], np.concatenate((self.size, size))[order]

    def cut(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Ascending chunk starts; every document with bytes starts one."""
        n = len(buf)
        space = ~K._WORD[buf]
        solid = ~space
        # the last byte of a character that could be white space beyond ASCII is no safe neighbour
        odd = np.zeros(n, bool)
        odd[1:] |= buf[:-1] == 0xC2
        odd[2:] |= (buf[:-2] >= 0xE1) & (buf[:-2] <= 0xE3)
        safe = solid & ~odd
        cut = np.zeros(n, bool)
        cut[1:] |= space[1:] & safe[:-1]
        cut[2:] |= solid[2:] & (buf[1:-1] == 0x0A) & safe[:-2]
        cut[off[:-1][off[:-1] < n]] = True
        return np.flatnonzero(cut)

    def encode(self, buf: np.ndarray, off: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, ids per document), the end id included."""
        starts = self.cut(buf, off)
        ends = np.append(starts[1:], len(buf))
        keys, first, inverse = np.unique(K.span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > self.cached:
            self._forget()
        new = np.flatnonzero(~K.member(self.keys, keys))
        if len(new):
            raw = buf.tobytes()
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            self._learn(keys[new], [raw[i:j].decode() for i, j in spans])
        mine = np.searchsorted(self.keys, keys)
        at, count = self.at[mine][inverse], self.size[mine][inverse]
        per = np.diff(np.concatenate(([0], np.cumsum(count)))[np.searchsorted(starts, off)])
        body = self.flat[np.repeat(at, count) + K.ragged(count)]
        lengths = per + 1
        out = np.full(len(body) + len(per), end, np.uint32)
        keep = np.ones(len(out), bool)
        keep[np.cumsum(lengths) - 1] = False
        out[keep] = body
        return out, lengths


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder; its cache lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---------------------------------------------------------------- jobs

def pieces(buf: np.ndarray, off: np.ndarray, limit: int):
    """Consecutive document ranges of about ``limit`` bytes, one document at least."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1))
        yield lo, hi
        lo = hi


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = 2,
          percentile: float = 90.0, shard_ids: int = SHARD_IDS) -> None:
    """Encodes ``docs`` and writes the shards under ``path``, ascending by id over (slot, before)."""
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    narrow = narrow.withColumn("tie", F.xxhash64("text"))
    ordered = narrow.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")

    def encode(batches):
        from pyspark import TaskContext

        slot, before = TaskContext.get().partitionId(), 0
        names, lengths, ids, held = [], [], [], 0
        for b in batches:
            buf, off = K.text_bytes(b.column("text"))
            doc = b.column("id").to_pylist()
            for lo, hi in pieces(buf, off, 1 << 21):
                got, per = encoder(tokenizer).encode(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], end)
                names += doc[lo:hi]
                lengths.append(per)
                ids.append(got)
                held += len(got)
                if held >= shard_ids:
                    yield _row(slot, before, names, lengths, ids, percentile)
                    before, names, lengths, ids, held = before + held, [], [], [], 0
        if names:
            yield _row(slot, before, names, lengths, ids, percentile)

    ordered.mapInArrow(encode, "slot int, before long, n_docs long, n_ids long, shard binary").write.parquet(path)


def _row(slot, before, names, lengths, ids, percentile) -> pa.RecordBatch:
    flat = np.concatenate(ids)
    data = write_shard(names, np.concatenate(lengths), flat, percentile)
    return pa.RecordBatch.from_pydict({"slot": [slot], "before": [before], "n_docs": [len(names)], "n_ids": [len(flat)], "shard": [data]},
                                      schema=pa.schema([("slot", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int64()),
                                                        ("n_ids", pa.int64()), ("shard", pa.binary())]))


def read(spark, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Documents of the shards under ``path``: id, start (ids before it),
    n_tokens, ids_crc32 and, if asked for, the ids."""
    shards = spark.read.parquet(path)
    slots = shards.groupBy("slot").agg(F.max(F.col("before") + F.col("n_ids")).alias("n")).collect()  # one row per written partition
    base, total = {}, 0
    for r in sorted(slots, key=lambda r: r["slot"]):
        base[r["slot"]] = total
        total += r["n"]
    extra = ", ids array<int>" if with_ids else ""

    def decode(batches):
        for b in batches:
            for slot, before, data in zip(b.column("slot").to_pylist(), b.column("before").to_pylist(), b.column("shard")):
                names, lengths, ids = read_shard(data.as_py())
                at = np.concatenate(([0], np.cumsum(lengths)))
                raw = ids.astype("<u4")
                cols = {id_col: pa.array(names, pa.int64()), "start": pa.array(base[slot] + before + at[:-1], pa.int64()),
                        "n_tokens": pa.array(lengths, pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(raw[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64())}
                if with_ids:
                    cols["ids"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(cols)

    out = shards.select("slot", "before", "shard").mapInArrow(decode, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long{extra}")
    return out


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    path = work_dir(docs.sparkSession, "tokens")
    write(docs, path, tokenizer, id_col, text_col, **options)
    return read(docs.sparkSession, path, id_col)
