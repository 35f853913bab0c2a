"""Alignment of two tokenizers over the same texts, by sparse incidence products.

Tokenizer A is a byte-level BPE of the tokenizers library, which encodes a space
and the text; B is a sentencepiece model, which puts that space in front by
itself.  Both sequences spell the same bytes.

* Token-byte incidence: row t of a matrix marks the bytes of token t.  The
  product A.B^T by rows (Gustavson: for each row of A, the rows of B^T that its
  entries name, added up by column) holds, for each pair of tokens that overlap,
  the number of bytes they share.  Where both tokens change from one link to the
  next, both sequences end at the same byte: that cuts the text into groups.
* Group incidence: rows (document, A id) by groups, and groups by B ids, with the
  number of tokens as values.  Their product holds for each document and id pair
  the number of token pairs that share a group, without listing the token pairs.

* Both tokenizers end a token before a space that follows a visible character, so
  a text is a row of chunks cut there, and each distinct chunk is encoded and
  aligned once per worker: (documents by chunks) times (chunks by id pairs) gives
  the links per document.  Tokenizers with other rules get whole texts as chunks.

The products run over a bounded number of terms at a time.  The matrices are
plain arrays (row bounds, columns, values), see :class:`Csr`.

A task cuts its rows into parts of bounded text.  A part is one written row: its
documents' figures, its distinct id pairs with the number of its documents that
hold each, and per document the places of its pairs in that list.  Counts over
all parts are a ``groupBy`` on the pair; each part asks for its distinct pairs
once, so a pair that every document holds is as many rows as there are parts.

Defined results: null and empty texts, and texts whose tokens spell other bytes
(B writes U+2581 as a space), have no tokens: zeros and ''.  Strings of special
tokens are plain text.  Every input row is a document of its own, repeated rows
and null ids included.  An empty table gives an empty result.  Only the id and
the text are read, so other columns cannot clash.  Texts are whole; a text
longer than a part is a part alone, its memory follows its length.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import kernel as K
from vigil.session import work_dir

CHUNK_BYTES = 1 << 19
PART_BYTES = 4 << 20
PARTS_PER_TASK = 2
TERMS = 1 << 21


# ---------------------------------------------------------------- matrices

class Csr(NamedTuple):
    """Row ``i`` has the columns ``cols[ptr[i]:ptr[i + 1]]`` with the values ``vals`` there."""
    ptr: np.ndarray
    cols: np.ndarray
    vals: np.ndarray


def collapsed(row: np.ndarray, col: np.ndarray, val: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order of (row, column), equal places added up."""
    key = row.astype(np.int64) * width + col
    if (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, val = key[order], val[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    total = np.add.reduceat(val, first) if len(key) else val
    return key[first] // width, key[first] % width, total


def matrix(row: np.ndarray, col: np.ndarray, rows: int, width: int) -> Csr:
    """Counts of the (row, column) places."""
    r, c, v = collapsed(row, col, np.ones(len(row), np.int64), width)
    return Csr(np.searchsorted(r, np.arange(rows + 1)), c, v)


def products(a: Csr, b: Csr, width: int, terms: int = TERMS):
    """Blocks of (row, column, value) of a.b, ascending; as many rows of ``a`` at
    a time as have ``terms`` terms, one row at least."""
    size = np.diff(b.ptr)[a.cols]
    upto = np.concatenate(([0], np.cumsum(size)))[a.ptr]
    lo, rows = 0, len(a.ptr) - 1
    while lo < rows:
        hi = min(rows, max(lo + 1, int(np.searchsorted(upto, upto[lo] + terms, "right")) - 1))
        i, j = a.ptr[lo], a.ptr[hi]
        n = size[i:j]
        at = np.repeat(b.ptr[a.cols[i:j]], n) + K.ragged(n)
        row = np.repeat(np.repeat(np.arange(lo, hi), np.diff(a.ptr[lo:hi + 1])), n)
        yield collapsed(row, b.cols[at], np.repeat(a.vals[i:j], n) * b.vals[at], width)
        lo = hi


# ---------------------------------------------------------------- tokenizers

def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 characters stand for themselves, the others for U+0100 onwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokens:
    """The bytes of every id: ``flat[at[i]:at[i] + size[i]]``, and its decimal digits."""

    def __init__(self, spelled: list[bytes]):
        self.n = len(spelled)
        self.size = np.array([len(x) for x in spelled], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        return self.flat[np.repeat(self.at[ids], size) + K.ragged(size)]


#: white space of the pre-tokenizer's pattern (Unicode's White_Space), without the space itself
OTHER_SPACE = "\\t-\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: from a space that follows a visible character (or begins the text) up to the next such space
CHUNK = re.compile(f" [ {OTHER_SPACE}]*[^ {OTHER_SPACE}]*(?:[{OTHER_SPACE}][ {OTHER_SPACE}]*[^ {OTHER_SPACE}]*)*")


class ByteLevel(Tokens):
    """A: byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        letters = byte_letters()
        names = {i: x for x, i in self.own.get_vocab(with_added_tokens=True).items()}
        super().__init__([bytes(letters.get(c, 0) for c in names.get(i, "")) for i in range(max(names) + 1)])
        rules = json.loads(self.own.to_str())
        pre = rules["pre_tokenizer"] or {}
        plain = not rules["normalizer"] and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.apart = plain

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces(Tokens):
    """B: sentencepiece model.  ``apart``: no piece has a space after another
    character and spaces are kept as they are, so words can be encoded apart."""

    def __init__(self, path: str):
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.own.id_to_piece(i) for i in range(self.own.get_piece_size())]
        super().__init__([bytes([int(x[3:-1], 16)]) if self.own.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)])
        space = self.own.piece_to_id("▁")
        self.space = space
        self.apart = (names[space] == "▁" and not any("▁" in x.lstrip("▁") for x in names)
                      and "".join(self.own.encode(" a  b ", out_type=str)) == "▁▁a▁▁b▁")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Texts begin with the space that the model puts itself; of a lone one nothing is left to encode."""
        found = self.own.encode([x[1:] for x in texts], num_threads=1)
        return [e if x != " " or not self.apart else [self.space] for x, e in zip(texts, found)]


@cache
def known_chunks(path_a: str, path_b: str) -> Chunks:
    """The worker's memory, which lives as long as the worker."""
    return Chunks(*tokenizers(path_a, path_b))


@cache
def tokenizers(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    """The worker's tokenizers."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    return ByteLevel(path_a), Pieces(path_b)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(chain.from_iterable(lists), np.int64), np.array([len(x) for x in lists], np.int64)


def _same(spelled: np.ndarray, per: np.ndarray, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Documents whose ``per`` bytes in ``spelled`` are their bytes in ``raw``."""
    ok = per == np.diff(off)
    begin = np.cumsum(per) - per
    n = per[ok]
    places = K.ragged(n)
    equal = spelled[np.repeat(begin[ok], n) + places] == raw[np.repeat(off[:-1][ok], n) + places]
    bad = np.concatenate(([0], np.cumsum(~equal)))
    ends = np.cumsum(n)
    ok[ok] = bad[ends] == bad[ends - n]
    return ok


class Aligned(NamedTuple):
    """Aligned texts: ids, groups and text numbers of the tokens of both sides; links per overlap."""
    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    doc_a: np.ndarray
    doc_b: np.ndarray
    overlaps: tuple[np.ndarray, np.ndarray, np.ndarray]  # A token, B token, shared bytes
    good: np.ndarray  # texts whose tokens spell them on both sides; the others have no tokens


def align(texts: list[str], a: Tokens, b: Tokens) -> Aligned:
    """Tokens, overlaps and groups of texts with the space in front; token
    numbers run over the texts in order."""
    raw = [x.encode() for x in texts]
    off = np.concatenate(([0], np.cumsum([len(x) for x in raw], dtype=np.int64)))
    buf = np.frombuffer(b"".join(raw), np.uint8)
    doc = np.arange(len(texts))
    (ids_a, n_a), (ids_b, n_b) = _flat(a.encode(texts)), _flat(b.encode(texts))
    good = np.ones(len(doc), bool)
    for side, ids, n in ((a, ids_a, n_a), (b, ids_b, n_b)):
        size = np.concatenate(([0], np.cumsum(side.size[ids])))
        good &= _same(side.spell(ids), np.diff(size[np.concatenate(([0], np.cumsum(n)))]), buf, off)
    ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
    doc_a, doc_b = np.repeat(doc[good], n_a[good]), np.repeat(doc[good], n_b[good])
    size_a, size_b = a.size[ids_a], b.size[ids_b]
    bytes_ = int(size_a.sum())
    one = np.ones(bytes_, np.int8)
    by_token = Csr(np.concatenate(([0], np.cumsum(size_a))), np.arange(bytes_), one)
    by_byte = Csr(np.arange(bytes_ + 1), np.repeat(np.arange(len(ids_b)), size_b), one.astype(np.int64))
    blocks = list(products(by_token, by_byte, max(1, len(ids_b))))
    row, col, shared = (np.concatenate(x) for x in zip(*blocks)) if blocks else (np.zeros(0, np.int64),) * 3
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) & (col[1:] != col[:-1])
    group = np.cumsum(new) - 1
    group_a, group_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    group_a[row], group_b[col] = group, group
    return Aligned(ids_a, ids_b, group_a, group_b, doc_a, doc_b, (row, col, shared), good)


def id_pairs(x: Aligned, a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, links): token pairs that share a group, per text and id pair
    (A id * B's size + B id), ascending."""
    groups = int(x.group_a[-1]) + 1 if len(x.group_a) else 0
    keys, _, row = K.distinct(x.doc_a * a.n + x.a)
    by_id = matrix(row, x.group_a, len(keys), max(1, groups))
    by_group = matrix(x.group_b, x.b, groups, b.n)
    blocks = list(products(by_id, by_group, b.n))
    if not blocks:
        return (np.zeros(0, np.int64),) * 3
    r, c, n = (np.concatenate(v) for v in zip(*blocks))
    return keys[r] // a.n, keys[r] % a.n * b.n + c, n


@cache
def _digits(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = [str(i).encode() for i in range(n)]
    size = np.array([len(w) for w in words], np.int64)
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size


def written(x: Aligned, texts: int) -> list[bytes]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
    groups = int(x.group_a[-1]) + 1 if len(x.group_a) else 0
    na, nb = np.bincount(x.group_a, minlength=groups), np.bincount(x.group_b, minlength=groups)
    begin = np.cumsum(na + nb) - na - nb
    total = int((na + nb).sum())
    ids, mark = np.zeros(total, np.int64), np.full(total, ord(","), np.uint8)
    at_a = np.repeat(begin, na) + K.ragged(na)
    at_b = np.repeat(begin + na, nb) + K.ragged(nb)
    ids[at_a], ids[at_b] = x.a, x.b
    mark[begin + na - 1], mark[begin + na + nb - 1] = ord("|"), ord(";")
    flat, first, size = _digits(int(ids.max()) + 1 if total else 1)
    long = size[ids] + 1
    ends = np.cumsum(long)
    out = np.zeros(int(ends[-1]) if total else 0, np.uint8)
    put = np.ones(len(out), bool)
    put[ends - 1] = False
    out[put] = flat[np.repeat(first[ids], size[ids]) + K.ragged(size[ids])]
    out[ends - 1] = mark
    per = np.bincount(x.doc_a, minlength=texts) + np.bincount(x.doc_b, minlength=texts)
    stop = np.concatenate(([0], ends))[np.cumsum(per)]
    start = np.concatenate(([0], stop[:-1]))
    data = out.tobytes()
    return [data[i:j - 1] for i, j in zip(start.tolist(), stop.tolist())]


class Chunks:
    """What a worker knows of the chunks it has met: figures, groups as written,
    and a row of id pairs each.  Starts anew beyond ``most`` characters."""

    def __init__(self, a: Tokens, b: Tokens, most: int = 2 << 20):
        self.a, self.b, self.most, self.apart = a, b, most, a.apart and b.apart
        self.forget()

    def forget(self):
        self.place: dict[str, int] = {}
        self.text: list[bytes] = []
        self.figures, self.good = np.zeros((0, 3), np.int64), np.zeros(0, bool)
        self.rows, self.chars = Csr(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)), 0

    def learn(self, new: list[str]):
        x, n = align(new, self.a, self.b), len(new)
        chunk, pair, links = id_pairs(x, self.a, self.b)
        first = np.concatenate(([True], x.group_a[1:] != x.group_a[:-1])) if len(x.group_a) else np.zeros(0, bool)
        count = lambda v: np.bincount(v, minlength=n)
        self.figures = np.concatenate((self.figures, np.stack((count(x.doc_a), count(x.doc_b), count(x.doc_a[first])), axis=1)))
        self.good = np.concatenate((self.good, x.good))
        self.text += written(x, n)
        old = self.rows
        self.rows = Csr(np.concatenate((old.ptr, len(old.cols) + np.cumsum(count(chunk)))), np.concatenate((old.cols, pair)),
                        np.concatenate((old.vals, links)))
        self.place.update(zip(new, range(len(self.place), len(self.place) + n)))
        self.chars += sum(map(len, new))

    def documents(self, texts: list[str | None]):
        """(figures (documents, 3), sha256 of the groups, (document, pair, links))."""
        lists = [(CHUNK.findall(" " + x) if self.apart else [" " + x]) if x else [] for x in texts]
        if self.chars > self.most:
            self.forget()
        chunks = list(chain.from_iterable(lists))
        new = list(set(chunks) - self.place.keys())
        for lo in range(0, len(new), 20_000):
            self.learn(new[lo:lo + 20_000])
        n, per = len(texts), np.array([len(x) for x in lists], np.int64)
        at = np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))
        doc = np.repeat(np.arange(n), per)
        good = np.bincount(doc[~self.good[at]], minlength=n) == 0
        if not good.all():
            at, doc, per = at[good[doc]], doc[good[doc]], np.where(good, per, 0)
        total = np.concatenate((np.zeros((1, 3), np.int64), np.cumsum(self.figures[at], axis=0)))
        ends = np.cumsum(per)
        figures = total[ends] - total[ends - per]
        words, sha = at.tolist(), []
        for i, j in zip((ends - per).tolist(), ends.tolist()):
            sha.append(hashlib.sha256(b";".join([self.text[k] for k in words[i:j]])).hexdigest() if j > i else "")
        blocks = list(products(matrix(doc, at, n, max(1, len(self.place))), self.rows, self.a.n * self.b.n))
        found = tuple(np.concatenate(v) for v in zip(*blocks)) if blocks else (np.zeros(0, np.int64),) * 3
        return figures, sha, found


# ---------------------------------------------------------------- jobs

FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
PART = pa.schema([("part", pa.int64()), ("ids", pa.list_(pa.int64())), *[(c, pa.list_(pa.int64())) for c in FIGURES],
                  ("sha", pa.list_(pa.string())), ("held", pa.binary()), ("at", pa.binary()), ("times", pa.binary()),
                  ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int32()))])
PART_DDL = ("part long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
            "sha array<string>, held binary, at binary, times binary, pairs array<long>, holders array<int>")


def _narrow(x: np.ndarray) -> bytes:
    """Non-negative numbers in the fewest bytes of 1, 2, 4 or 8 that hold all of them, behind that number."""
    size = next(s for s in (1, 2, 4, 8) if s == 8 or int(x.max(initial=0)) < 1 << 8 * s)
    return bytes([size]) + x.astype(f"<u{size}").tobytes()


def _wide(data: bytes) -> np.ndarray:
    """The numbers that :func:`_narrow` wrote."""
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


class _Part:
    """Documents gathered until they have enough text for a part."""

    def __init__(self):
        self.ids, self.sha, self.bytes = [], [], 0
        self.figures = {c: [] for c in FIGURES}
        self.held, self.pair, self.times = [], [], []

    def add(self, ids: list, texts: list, known: Chunks):
        n = len(ids)
        figures, sha, (doc, pair, links) = known.documents(texts)
        for c, v in zip(FIGURES, (*figures.T, _sums(doc, links, n))):
            self.figures[c].append(v)
        self.ids += ids
        self.sha += sha
        self.held.append(np.bincount(doc, minlength=n))
        self.pair.append(pair)
        self.times.append(links)

    def row(self, part: int) -> pa.RecordBatch:
        pair, _, at = K.distinct(np.concatenate(self.pair))
        holders = np.bincount(at, minlength=len(pair))
        cols = {"part": [part], "ids": [self.ids], **{c: [np.concatenate(v)] for c, v in self.figures.items()}, "sha": [self.sha],
                "held": [_narrow(np.concatenate(self.held))], "at": [_narrow(at)],
                "times": [_narrow(np.concatenate(self.times))], "pairs": [pair], "holders": [holders]}
        return pa.RecordBatch.from_pydict(cols, schema=PART)


def _sums(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of ``value`` per document (ascending in ``doc``)."""
    total = np.concatenate(([0], np.cumsum(value, dtype=np.int64)))
    return np.diff(total[np.searchsorted(doc, np.arange(n + 1))])


def _chunks(batches, limit: int):
    """(ids, texts, bytes) of consecutive rows with about ``limit`` bytes, one row at least."""
    for batch in batches:
        ids, column = batch.column(0).to_pylist(), batch.column(1)
        _, off = K.text_bytes(column)
        lo = 0
        while lo < len(ids):
            hi = min(len(ids), max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1))
            yield ids[lo:hi], column[lo:hi].to_pylist(), int(off[hi] - off[lo])
            lo = hi


def _two_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))


def parts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          part_bytes: int = PART_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per part, see ``PART``."""

    def run(batches):
        from pyspark import TaskContext

        known = known_chunks(path_a, path_b)
        part, mine = TaskContext.get().partitionId() << 32, _Part()
        for ids, texts, size in _chunks(batches, chunk_bytes):
            mine.add(ids, texts, known)
            mine.bytes += size + 64 * len(ids)
            if mine.bytes >= part_bytes:
                yield mine.row(part)
                part, mine = part + 1, _Part()
        if mine.ids:
            yield mine.row(part)

    return _two_columns(docs, id_col, text_col).mapInArrow(run, PART_DDL)


def pair_counts(table: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, best) over all parts: the documents that hold the pair, and
    whether no other pair of its A id has more."""
    counts = (table.select(F.explode(F.arrays_zip("pairs", "holders")).alias("x"))
              .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.holders").alias("n")))
    counts = counts.withColumn("a", F.expr(f"pair div {b_size}"))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def digest(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
           part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    path = work_dir(spark, "aligned")
    parts(docs, path_a, path_b, id_col, text_col, part_bytes).write.parquet(path)
    table = spark.read.parquet(path)
    counts = pair_counts(table.select("pairs", "holders"), Pieces(path_b).n)
    asked = spark.read.parquet(path).select(F.col("part").alias("asker"), F.posexplode("pairs").alias("pos", "pair"))
    told = asked.join(counts, "pair").select("asker", "pos", "n", "best")
    names = [id_col, *FIGURES, "n_best", "count_sum", "groups_sha256"]
    schema = pa.schema([*[(c, pa.int64()) for c in names[:-1]], (names[-1], pa.string())])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        pos = right["pos"].to_numpy()
        n, best = np.zeros(len(pos), np.int64), np.zeros(len(pos), bool)
        n[pos], best[pos] = right["n"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        row = {c: left[c][0] for c in left.column_names}
        held, at, times = (_wide(row[c].as_py()) for c in ("held", "at", "times"))
        doc = np.repeat(np.arange(len(held)), held)
        out = [row["ids"].values, *[row[c].values for c in FIGURES], pa.array(_sums(doc, times * best[at], len(held))),
               pa.array(_sums(doc, times * n[at], len(held))), row["sha"].values]
        return pa.Table.from_arrays(out, schema=schema)

    ddl = ", ".join(f"`{c}` long" for c in names[:-1]) + ", groups_sha256 string"
    # a task fetches and sorts whole parts, so their number per task must not grow with the table
    deal = math.ceil(table.count() / PARTS_PER_TASK)
    kept = table.drop("pairs", "holders")
    if deal > int(spark.conf.get("spark.sql.shuffle.partitions")):
        kept, told = kept.repartition(deal, "part"), told.repartition(deal, "asker")
    return kept.groupBy("part").cogroup(told.groupBy("asker")).applyInArrow(finish, ddl)


def overlaps(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
             chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The overlap links themselves: id, place and id of the A token, place and
    id of the B token (places within the document), bytes they share, and the
    number of their group within the document."""
    names = [id_col, "a_at", "a_id", "b_at", "b_id", "n_bytes", "group"]

    def run(batches):
        a, b = tokenizers(path_a, path_b)
        for ids, texts, _ in _chunks(batches, chunk_bytes):
            full = [i for i, t in enumerate(texts) if t]
            ids = [ids[i] for i in full]
            x = align([" " + texts[i] for i in full], a, b)
            row, col, shared = x.overlaps
            doc, n = x.doc_a[row], len(ids)
            first_a, first_b = np.searchsorted(x.doc_a, np.arange(n)), np.searchsorted(x.doc_b, np.arange(n))
            group = x.group_a[row]
            own = group - group[np.searchsorted(doc, doc)]
            cols = [pa.array(ids, pa.int64()).take(pa.array(doc)), *[pa.array(v, pa.int64()) for v in (
                row - first_a[doc], x.a[row], col - first_b[doc], x.b[col], shared, own)]]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return _two_columns(docs, id_col, text_col).mapInArrow(run, ", ".join(f"`{c}` long" for c in names))
