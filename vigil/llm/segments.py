"""Seeded merge-dropout over a public SentencePiece BPE vocabulary.

A text becomes its characters (spaces as word marks, one more in front), and
neighbours are merged by the vocabulary: the best-ranked candidate first,
leftmost among equals.  A candidate is skipped for good if the hash of (seed,
text, place, piece) falls below the dropout rate, so a seed gives one
segmentation and another seed another; every segmentation decodes to the text.
Rate 0 is the vocabulary's own encoding.

No piece crosses from a character to a following word mark, so the stretches
between such borders (a run of marks and the characters up to the next run) are
independent.  All stretches of a batch merge together, one merge each per
round; stretches over 200 characters use an agenda each.

Characters outside the vocabulary, and a literal word mark, become byte pieces.

Defined results: null and empty texts have no pieces (a null text counts as
decoded losslessly to the empty text).  Repeated rows get equal pieces; an
empty table gives none.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vigil.llm import kernel as K
from vigil.llm.tokenfile import pieces as doc_ranges

MARK = "▁"
LONG = 200
STEP_BYTES = 1 << 20
_NONE = np.int64(1) << np.int64(62)


class Merges:
    """The vocabulary: characters, merge table (left, right) -> piece, ranks and bytes of pieces."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        normal = {sp.id_to_piece(k): k for k in range(n) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k) or sp.is_unused(k))}
        score = np.array([sp.get_score(k) for k in range(n)])
        order = np.unique(-score)
        self.rank = np.searchsorted(order, -score).astype(np.int64)
        self.byte = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.char = np.full(0x110000, -1, np.int32)
        for p, k in normal.items():
            if len(p) == 1:
                self.char[ord(p)] = k
        self.char[0x20], self.char[ord(MARK)] = self.char[ord(MARK)], -1
        pairs = {}
        for p, k in normal.items():
            for i in range(1, len(p)):
                a, b = normal.get(p[:i]), normal.get(p[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = k
        keys = np.array(sorted(pairs), np.uint64)
        self.bits = int(np.ceil(np.log2(len(keys)))) + 2
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.ids = np.full(1 << self.bits, -1, np.int32)
        for key in keys.tolist():
            at = int(K.mix(np.array([key], np.uint64))[0]) >> (64 - self.bits)
            while self.keys[at]:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.ids[at] = key, pairs[key]
        raw = [b""] * n
        for p, k in normal.items():
            raw[k] = p.replace(MARK, " ").encode()
        for b, k in enumerate(self.byte.tolist()):
            raw[k] = bytes([b])
        self.size = np.array([len(x) for x in raw], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece of each pair, or -1."""
        out = np.full(len(left), -1, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = (left[todo].astype(np.uint64) << np.uint64(32)) | right[todo].astype(np.uint64)
        at = (K.mix(key) >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(todo):
            have = self.keys[at]
            hit = have == key
            out[todo[hit]] = self.ids[at[hit]]
            on = ~hit & (have != 0)
            todo, key, at = todo[on], key[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def _dropped(key: np.ndarray, place: np.ndarray, piece: np.ndarray, limit: int) -> np.ndarray:
    """Whether each candidate merge (text key, place of its first character, piece) is skipped."""
    h = K.mix(key ^ K.mix((place.astype(np.uint64) << np.uint64(20)) ^ piece.astype(np.uint64)))
    return h < np.uint64(limit)


def _agenda(m: Merges, sym: np.ndarray, place: np.ndarray, key, limit: int) -> np.ndarray:
    """Pieces of one long stretch, -1 behind a merge; a heap holds the candidates."""
    n = len(sym)
    sym = sym.tolist()
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    size, heap = [1] * n, []

    def push(firsts):
        firsts = [i for i in firsts if i >= 0 and right[i] >= 0]
        piece = m.merged(np.array([sym[i] for i in firsts], np.int64), np.array([sym[right[i]] for i in firsts], np.int64))
        ok = piece >= 0
        if limit and ok.any():
            ok &= ~_dropped(np.full(len(firsts), key, np.uint64), place[firsts], piece, limit)
        for i, p in ((firsts[k], int(piece[k])) for k in np.flatnonzero(ok)):
            heapq.heappush(heap, (int(m.rank[p]), i, p, size[i], size[right[i]]))

    push(list(range(n - 1)))
    while heap:
        _, i, p, a, b = heapq.heappop(heap)
        k = right[i]
        if sym[i] == -2 or k < 0 or size[i] != a or size[k] != b:
            continue
        sym[i], sym[k] = p, -2
        size[i] += size[k]
        right[i] = right[k]
        if right[k] >= 0:
            left[right[k]] = i
        push([left[i], i])
    return np.array(sym, np.int64)


def encode(m: Merges, texts: list[str], keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, ids per text)."""
    limit = min(int(dropout * 2.0 ** 64), (1 << 64) - 1)
    flat = "".join(" " + t if t else "" for t in texts)
    cps = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
    per_text = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    if not len(cps):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    begin = np.cumsum(per_text) - per_text
    mark = cps == 0x20
    head = mark.copy()
    head[1:] &= ~mark[:-1]
    head[begin[per_text > 0]] = True
    heads = np.flatnonzero(head)
    sizes = np.diff(np.append(heads, len(cps)))
    text_of = np.repeat(np.arange(len(texts)), per_text)
    place = np.arange(len(cps)) - begin[text_of]  # of a character in its text
    out = m.char[cps].astype(np.int64)
    for i, n in zip(heads[sizes > LONG].tolist(), sizes[sizes > LONG].tolist()):
        out[i:i + n] = _agenda(m, out[i:i + n], place[i:i + n], keys[text_of[i]], limit)
    short = sizes <= LONG
    at = np.repeat(heads[short], sizes[short]) + K.ragged(sizes[short])
    _rounds(m, out, at, sizes[short], place, keys[text_of], limit)
    live = out != -2
    lost = np.flatnonzero(out == -1)  # characters outside the vocabulary, as byte pieces
    spelled = [chr(c).encode("utf-8", "surrogatepass") for c in cps[lost].tolist()]
    width = live.astype(np.int64)
    width[lost] = [len(s) for s in spelled]
    ids = np.repeat(np.where(live, out, 0), width)
    if len(lost):
        first = np.cumsum(width)[lost] - width[lost]
        ids[np.repeat(first, width[lost]) + K.ragged(width[lost])] = m.byte[np.frombuffer(b"".join(spelled), np.uint8)]
    total = np.concatenate(([0], np.cumsum(width)))
    edge = np.append(begin, len(cps))
    return ids.astype(np.int32), total[edge[1:]] - total[edge[:-1]]


def _rounds(m: Merges, out: np.ndarray, at: np.ndarray, sizes: np.ndarray, place: np.ndarray, key: np.ndarray, limit: int) -> None:
    """Merges all stretches at once; ``at`` are the places of their characters
    in ``out``, which gets each piece at its first character and -2 behind."""
    if not len(at):
        return
    sym = out[at]
    bounds = np.cumsum(sizes) - sizes
    piece, rank = np.full(len(at), -1, np.int64), np.full(len(at), _NONE)

    def look(i):
        """Candidates at positions i (with i + 1)."""
        got = m.merged(sym[i], sym[i + 1]).astype(np.int64)
        ok = got >= 0
        if limit:
            j = i[ok]
            ok[ok] = ~_dropped(key[at[j]], place[at[j]], got[ok], limit)
        piece[i] = got
        rank[i] = np.where(ok, (m.rank[got] << np.int64(32)) | i, _NONE)

    last = np.zeros(len(at), bool)
    last[np.append(bounds[1:], len(at)) - 1] = True
    look(np.flatnonzero(~last))
    while len(at):
        best = np.minimum.reduceat(rank, bounds)
        going = best < _NONE
        sizes_now = np.diff(np.append(bounds, len(at)))
        if not going.all():  # stretches without a candidate are done
            stay = np.repeat(going, sizes_now)
            done = ~stay
            out[at[done]] = sym[done]
            shift = np.cumsum(done)
            at, sym, piece, rank, last = at[stay], sym[stay], piece[stay], rank[stay], last[stay]
            rank = np.where(rank < _NONE, rank - shift[stay], rank)
            moved = shift[best[going] & np.int64(0xFFFFFFFF)] if going.any() else np.zeros(0, np.int64)
            best = best[going] - moved
            bounds = np.cumsum(sizes_now[going]) - sizes_now[going]
            sizes_now = sizes_now[going]
            if not len(at):
                break
        i = best & np.int64(0xFFFFFFFF)
        sym[i] = piece[i]
        last[i] = last[i + 1]
        out[at[i + 1]] = -2
        keep = np.ones(len(at), bool)
        keep[i + 1] = False
        shift = np.cumsum(~keep)
        at, sym, piece, rank, last = at[keep], sym[keep], piece[keep], rank[keep], last[keep]
        rank = np.where(rank < _NONE, rank - shift[keep], rank)
        i = i - shift[i]
        bounds = bounds - np.arange(len(bounds))
        rank[i] = _NONE
        first = np.zeros(len(at), bool)
        first[bounds] = True
        again = np.concatenate((i[~last[i]], i[~first[i]] - 1))
        look(again)


def decode(m: Merges, ids: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets); the mark in front of each text goes."""
    size = m.size[ids]
    flat = m.raw[np.repeat(m.start[ids], size) + K.ragged(size)]
    total = np.concatenate(([0], np.cumsum(size)))
    edge = np.concatenate(([0], np.cumsum(per_text)))
    at = total[edge]
    keep = np.ones(len(flat), bool)
    keep[at[:-1][per_text > 0]] = False
    n = np.diff(at) - (per_text > 0)
    return flat[keep], np.concatenate(([0], np.cumsum(n)))


def segment(docs: DataFrame, path: str, text_col: str = "text", dropout: float = 0.1, seed: int = 1, keep_text: bool = False) -> DataFrame:
    """``docs`` without the text (unless ``keep_text``), with n_pieces, ids and
    lossless (the ids, decoded, are the text)."""
    extra = T.StructType.fromDDL("n_pieces long, ids array<int>, lossless boolean")
    keep = [c for c in docs.columns if c not in extra.names and (keep_text or c != text_col)]
    read = keep if keep_text else [*keep, text_col]

    def run(batches):
        m = merges(path)
        for b in batches:
            buf, off = K.text_bytes(b.column(text_col))
            for lo, hi in doc_ranges(buf, off, STEP_BYTES):
                part = b.slice(lo, hi - lo)
                own, at = buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
                texts = [x or "" for x in part.column(text_col).to_pylist()]
                salt = np.uint64((seed * K._M) & 0xFFFFFFFFFFFFFFFF)
                keys = np.zeros(len(texts), np.uint64)
                full = np.flatnonzero(np.diff(at))
                keys[full] = K.mix(K.span_hashes(own, at[full], at[full + 1]) ^ salt)
                ids, per = encode(m, texts, keys, dropout)
                back, where = decode(m, ids, per)
                edge = np.concatenate(([0], np.cumsum(per)))
                lossless = [back[where[k]:where[k + 1]].tobytes() == own[at[k]:at[k + 1]].tobytes() for k in range(len(texts))]
                cols = [part.column(c) for c in keep] + [pa.array(per, pa.int64()), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids)),
                                                        pa.array(lossless)]
                yield pa.RecordBatch.from_arrays(cols, [*keep, *extra.names])

    schema = T.StructType([*[f for f in docs.schema.fields if f.name in keep], *extra.fields])
    return docs.select(*[f"`{c}`" for c in read]).mapInArrow(run, schema)
