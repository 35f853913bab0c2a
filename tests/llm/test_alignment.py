import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import sentencepiece
from tokenizers import Tokenizer

from vigil.llm import alignment as X

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "a b", "a  b", "\tx\n y ", "é漢字 かな", "▁x", "x▁", "<|endoftext|> <s> <unk> <0x41>",
       "x\x00y", "ﬁ　x", "the the the the", "A" * 700, " " * 300 + "b", "1234567 !!! ..", "naïve café naïve", "🙂🙂 x", "\r\n\r\n"]


def brute(texts):
    """Plain Python over byte offsets: figures per text in order."""
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    letters = X.byte_letters()
    docs = []
    for t in texts:
        a = tok.encode(" " + t, add_special_tokens=False) if t else None
        ids_a, ids_b = (a.ids, sp.encode(t)) if t else ([], [])
        by_a = [bytes(letters[c] for c in x) for x in (a.tokens if t else [])]
        by_b = [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not t or not (b"".join(by_a) == b"".join(by_b) == b" " + t.encode()):
            docs.append([])
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in by_a]).tolist(), np.cumsum([len(x) for x in by_b]).tolist()
        groups = []
        for cut in sorted(set(ends_a) & set(ends_b)):
            done_a, done_b = sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups)
            groups.append(([i for i, e in zip(ids_a, ends_a) if e <= cut][done_a:], [i for i, e in zip(ids_b, ends_b) if e <= cut][done_b:]))
        docs.append(groups)
    links = [Counter((x, y) for ga, gb in d for x in ga for y in gb) for d in docs]
    count = Counter(p for c in links for p in c)
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for d, c in zip(docs, links):
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in d)
        out.append((sum(len(g[0]) for g in d), sum(len(g[1]) for g in d), len(d), sum(c.values()),
                    sum(n for p, n in c.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if d else ""))
    return out


def test_whole_result_equals_brute_force(spark, sf):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect() if r.text and len(r.text) < 4000]
    texts += texts[:25]  # repeated rows
    want = dict(enumerate(brute(texts)))
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string, part int").repartition(3)
    for part_bytes in (2000, 1 << 23):
        got = X.digest(docs, A, B, part_bytes=part_bytes).collect()
        assert len(got) == len(texts)
        for r in got:
            assert tuple(r)[1:] == want[r.doc_id], (r.doc_id, texts[r.doc_id])


def test_special_strings_and_odd_spellings(spark):
    want = brute(ODD)
    assert want[ODD.index("▁x")][0] == 0 and want[ODD.index("<|endoftext|> <s> <unk> <0x41>")][0] > 5


def test_products_equal_dense():
    rnd = np.random.default_rng(1)
    a, b = rnd.integers(0, 3, (9, 7)), rnd.integers(0, 3, (7, 11))
    csr = lambda m: X.Csr(np.concatenate(([0], np.cumsum((m > 0).sum(1)))), np.nonzero(m)[1], m[np.nonzero(m)])
    for terms in (1, 5, 1000):
        dense = np.zeros((9, 11), int)
        for r, c, v in X.products(csr(a), csr(b), 11, terms):
            dense[r, c] += v
        assert (dense == a @ b).all()


def test_overlaps_cover_every_byte(spark):
    texts = [t for t in ODD if t and "▁" not in t]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = X.overlaps(docs, A, B).groupBy("doc_id").agg({"n_bytes": "sum", "group": "max"}).collect()
    assert {r[0]: r["sum(n_bytes)"] for r in got} == {i: len(t.encode()) + 1 for i, t in enumerate(texts)}
    assert {r[0]: r["max(group)"] + 1 for r in got} == {i: w[2] for i, w in enumerate(brute(texts))}


def test_long_unaligned_group_in_small_blocks(monkeypatch):
    a, b = X.tokenizers(A, B)
    x = X.align([" " + "ab" * 3000 + "c d"], a, b)
    whole = [v.tolist() for v in X.id_pairs(x, a, b)]
    monkeypatch.setattr(X.products, "__defaults__", (7,))
    assert [v.tolist() for v in X.id_pairs(x, a, b)] == whole


def test_empty_table(spark):
    assert X.digest(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_chunks_do_not_change_ids():
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    odd = ["\x1c!\x1c a\x1d", "!\x1c!", "a\u0085 b", " \u0085x", "x᠎y​z   q", "a\xa0 b\xa0\xa0c", "  \n word\n\nx \n y", "it's  we'll\n'll",
           "\r\n\r\n x", " ", "  ", "a ", "a  ", "\n", "x　 y　", "１２ ab", "é x", "  a b"]
    texts = [t for t in ODD + odd if t]
    rnd = np.random.default_rng(4)
    letters = list("ab1!' \n\t\x1c\u0085\xa0　é漢")
    texts += ["".join(rnd.choice(letters, 40)) for _ in range(400)]
    a, b = X.tokenizers(A, B)
    assert a.apart and b.apart
    for side, want in ((a, [e.ids for e in tok.encode_batch([" " + t for t in texts], add_special_tokens=False)]), (b, sp.encode(texts))):
        for text, ids in zip(texts, want):
            chunks = X.CHUNK.findall(" " + text)
            assert "".join(chunks) == " " + text
            assert sum(side.encode(chunks), []) == ids, text


def test_whole_texts_as_chunks_give_the_same(spark):
    a, b = X.tokenizers(A, B)
    texts = [t for t in ODD] + ["a b  c\n\n d", "x ▁ y"]
    one, two = X.Chunks(a, b), X.Chunks(a, b)
    two.apart = False
    for p, q in zip(one.documents(texts), two.documents(texts)):
        assert [np.asarray(v).tolist() for v in p] == [np.asarray(v).tolist() for v in q]


def test_memory_starts_anew():
    known = X.Chunks(*X.tokenizers(A, B), most=10)
    first = known.documents(["some words of a text", "more of it"])[1]
    known.documents(["other words"])
    assert "some" not in known.place and known.documents(["some words of a text", "more of it"])[1] == first
