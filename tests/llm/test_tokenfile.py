import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from vigil.llm import kernel as K
from vigil.llm import tokenfile as X

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_blocks_round_trip():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 127, 128, 129, 5000):
        for top in (1, 7, 50_257, 1 << 31):
            ids = rnd.integers(0, top, n).astype(np.uint32)
            ids[::50] = rnd.integers(0, 1 << 32, len(ids[::50]))
            starts, data = X.pack_blocks(ids)
            assert (X.unpack_blocks(starts, np.frombuffer(data, np.uint8), n) == ids).all()
    ids = np.arange(1000, dtype=np.uint32) % 5 + 70_000
    assert len(X.pack_blocks(ids)[1]) < 1000 * 0.6


def test_shard_round_trip():
    names, lengths, ids = [None, 5, -7], np.array([1, 0, 4]), np.array([9, 1, 2, 3, 1 << 31], np.uint32)
    a, b, c = X.read_shard(X.write_shard(names, lengths, ids))
    assert a == names and b.tolist() == lengths.tolist() and c.tolist() == ids.tolist()


ODD = ["", " ", "\n", "a b", "a  b", " a\n\nb \n c", "x\n y", "x \ny", "it's  we'll\n'll", "é è   z", "a　 b  c  x",
       "tab\there\r\nend ", "漢字 かな", "  lead", "12 3a4 !! ..  ?", "a\u0085 b", "<|endoftext|> x", "A" * 3000, "\x1c \x1d x"]


def test_chunks_do_not_change_ids():
    tok = Tokenizer.from_file(PATH)
    raw = [t.encode() for t in ODD]
    buf, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    ids, per = X.Encoder(PATH).encode(buf, off, 2)
    at = np.cumsum(per)
    for t, hi, n in zip(ODD, at, per):
        assert ids[hi - n:hi].tolist() == tok.encode(t, add_special_tokens=False).ids + [2], t


def test_query_equals_plain_encoding(spark, sf):
    tok = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-5, None), (-4, ""), (None, "null id"), (10**9, "x y"), (10**9, "x z")] + list(enumerate(ODD, 10**6)),
                                  "doc_id long, text string")
    docs = docs.unionByName(extra).repartition(5)
    got = sorted(X.round_trip(docs, PATH, shard_ids=4000).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is not None, x or 0))
    want, start = {}, 0
    for r in docs.collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for r in got:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        start += r.n_tokens


def test_empty_table(spark):
    assert X.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_kernel_spans_cross_segments():
    rnd = np.random.default_rng(0)
    part = rnd.integers(0, 256, 1000).astype(np.uint8)
    buf = np.concatenate([rnd.integers(0, 256, K.SEGMENT - 300).astype(np.uint8), part, rnd.integers(0, 256, K.SEGMENT).astype(np.uint8), part])
    s = np.array([K.SEGMENT - 300, len(buf) - 1000])
    h = K.span_hashes(buf, s, s + 1000)
    assert h[0] == h[1] != K.span_hashes(buf, s[:1], s[:1] + 999)[0]
