import hashlib
import random
from collections import Counter

from vigil.llm import suffixes


def brute(texts, width):
    """(n_bytes, n_removed, n_spans, sha256) per text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + width] for b in raw for i in range(len(b) - width + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = b"\x01" * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows(df):
    return sorted(((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()))


def corpus(seed):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice("abcdé \n") for _ in range(n))
    shared = [text(n) for n in (29, 30, 45, 80, 300)]
    docs = [None, "", "x", text(30), text(30) * 3, "a" * 200, "a" * 31]
    for _ in range(30):
        docs.append(text(rnd.randrange(0, 90)) + rnd.choice(shared) + text(rnd.randrange(0, 400)) + rnd.choice(shared))
    docs += [docs[8]] * 5 + [docs[9] + "z", docs[10][:60]]
    return docs


def test_cover_covers():
    for width in (29, 40, 100, 400):
        cover, period = suffixes.difference_cover(width)
        assert width - period + 1 >= 16
        assert {(int(a) - int(b)) % period for a in cover for b in cover} == set(range(period))


def test_equals_brute_force(spark):
    for seed, width in ((1, 30), (2, 47)):
        docs = corpus(seed)
        df = spark.createDataFrame([(i if i % 7 else None, t, 5) for i, t in enumerate(docs)], "doc_id long, text string, n_bytes int")
        assert rows(suffixes.digest(df, width=width, part_bytes=3000)) == sorted(brute(docs, width))


def test_documents_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([r.text for r in df.collect()], 400)
    assert rows(suffixes.digest(df.select("doc_id", "text"), part_bytes=100_000)) == sorted(want)


def test_strip_keeps_characters_whole(spark):
    docs = ["é" * 10 + "abc" * 20, "è" + "é" * 9 + "abc" * 20 + "end", None, ""]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id long, text string, lang string")
    out = {r.doc_id: r.text for r in suffixes.strip(df, width=29).collect()}
    assert out[2] is None and out[3] == "" and out[1].startswith("è") and out[1].endswith("end")
    assert "abcabc" not in out[1]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.digest(df).collect() == [] and suffixes.strip(df).collect() == []
