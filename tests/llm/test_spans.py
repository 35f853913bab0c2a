import hashlib
import random
import re

from vigil.llm import spans


def split(text):
    """[(words, start byte)] by plain scanning."""
    raw, out, words, start, pos = (text or "").encode(), [], [], None, 0
    for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw):
        if words and (words[-1][-1:] in (b".", b"!", b"?") or b"\n" in raw[pos:m.start()]):
            out.append((words, start))
            words = []
        if not words:
            start = m.start()
        words.append(m[0])
        pos = m.end()
    if words:
        out.append((words, start))
    return [(tuple(re.sub(rb"[A-Z]", lambda x: x[0].lower(), w) for w in ws), s) for ws, s in out]


def brute(rows, run=2, min_words=12):
    seen, docs = {}, {}
    for key, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0])):
        s = split(text)
        for i in range(len(s) - run + 1):
            words = tuple(w for w, _ in s[i:i + run])
            if sum(map(len, words)) >= min_words:
                if words in seen:
                    docs.setdefault((key, text), set()).update(range(i, i + run))
                seen[words] = True
    out = []
    for key, text in rows:
        s, raw, gone = split(text), (text or "").encode(), docs.get((key, text), set())
        edge = [p for _, p in s] + [len(raw)]
        kept = bytearray(raw)
        for i in sorted(gone, reverse=True):
            del kept[edge[i]:edge[i + 1]]
        out.append((str(key), len(s), len(gone), hashlib.sha256(bytes(kept)).hexdigest()))
    return sorted(out)


def rows_of(df):
    return sorted((str(r.doc_id), r.n_sentences, r.n_removed, r.kept_sha256) for r in df.collect())


def test_equals_brute_force(spark):
    rnd = random.Random(3)
    sentence = lambda: " ".join(rnd.choice(["a", "Bb", "c", "dé", "e"]) for _ in range(rnd.randrange(1, 14))) + rnd.choice([".", "!", "?", "\n", ".\n"])
    shared = [" ".join(sentence() for _ in range(4)) for _ in range(5)]
    rows = [(None, None), (1, ""), (2, " \n "), (3, "one"), (None, shared[0])]
    for i in range(60):
        rows.append((10 + i, " ".join([sentence(), rnd.choice(shared), sentence(), rnd.choice(shared)] + [sentence()] * 3)))
    rows += [rows[10], rows[10], (500, "w " * 30000 + ". " + shared[1] + shared[1])]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, n_removed double").repartition(3)
    assert rows_of(spans.strip(df)) == brute(rows)
    assert {r.text is None for r in spans.strip(df).collect() if r.doc_id is None} == {True, False}
    assert spans.strip(df.limit(0)).collect() == []


def test_documents_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert rows_of(spans.strip(df)) == brute([(r.doc_id, r.text) for r in df.collect()])
