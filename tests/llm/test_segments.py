import random

import numpy as np
import public_tokenizers
import sentencepiece

from vigil.llm import segments as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  ", "hello world", " lead  and   trail  ", "a\nb\tc", "éàü 漢字 かな 😀😀", "▁literal ▁mark", "<0x41> <s> </s>", "x" * 500,
         "the " * 200, "\x00\x01   　", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "A" * 150 + " " + "ab" * 150, "don't stop-me_now (1234567)"]


def encoded(texts, rate, seed=1):
    m = S.merges(PATH)
    keys = np.array([hash((seed, t)) & (2**64 - 1) for t in texts], np.uint64)
    ids, per = S.encode(m, texts, keys, rate)
    flat, at = S.decode(m, ids, per)
    assert [flat[i:j].tobytes().decode() for i, j in zip(at[:-1], at[1:])] == texts
    edge = np.concatenate(([0], np.cumsum(per)))
    return [ids[i:j].tolist() for i, j in zip(edge[:-1], edge[1:])]


def test_rate_zero_is_the_library_encoding(spark, sf):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [t for t in TEXTS if "▁" not in t] + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    assert encoded(texts, 0.0) == [sp.encode(t) for t in texts]


def test_rounds_equal_the_agenda(monkeypatch):
    rnd = random.Random(4)
    texts = TEXTS + ["".join(rnd.choice("abcdeé the ing") for _ in range(150)) for _ in range(60)]
    for rate in (0.0, 0.1, 0.5, 0.95):
        a = encoded(texts, rate)
        with monkeypatch.context() as mp:
            mp.setattr(S, "LONG", 0)
            assert encoded(texts, rate) == a


def test_dropout_varies_and_splits():
    a, b, none, all_ = (encoded(TEXTS, r, s) for r, s in ((0.2, 1), (0.2, 2), (0.0, 1), (1.0, 1)))
    assert a != b and encoded(TEXTS, 0.2, 1) == a
    assert sum(map(len, none)) < sum(map(len, a)) < sum(map(len, all_))
    assert len(all_[3]) == len("hello world") + 1


def test_job(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "one two", "x"), (4, "one two", "x"), (4, "one two", "x")] + [(10 + i, t, "y") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = S.segment(df, PATH).collect()
    assert len(out) == len(rows) and all(r.lossless for r in out)
    assert len({tuple(r.ids) for r in out if r.doc_id in (None, 4)}) == 1
    assert [r.n_pieces for r in out if r.doc_id in (1, 2)] == [0, 0]
    assert S.segment(df.limit(0), PATH).collect() == []
    assert S.segment(df, PATH, keep_text=True).columns == ["doc_id", "text", "n_pieces", "ids", "lossless"]
