import random
import re
from itertools import combinations

from vigil.llm import jaccard


def shingle_set(text, k=4):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows, j=(85, 100)):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and j[1] * len(x & y) >= j[0] * len(x | y):
            root[find(a)] = find(b)
    comp = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            comp[find(i)] = min(comp.get(find(i), key), key)
    return sorted((str(k), len(s), str(comp.get(find(i)) if s else k)) for i, ((k, _), s) in enumerate(zip(rows, sets)))


def rows_of(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def corpus(seed, n):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "one", "One", "one two three", "a b c d", "A b c\td"]
    for _ in range(n):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([3, 5, 8, 11, 14, 20, 30, 60, 150]))]
        texts.append(" ".join(base))
        for _ in range(rnd.choice([0, 1, 3, 12])):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 4])):
                at = rnd.randrange(len(w))
                w[at:at + 1] = rnd.choice([[], [rnd.choice(vocab)], [w[at], rnd.choice(vocab)]])
            if rnd.random() < 0.3:
                w += "this very common line is in many texts of the table".split()
            texts.append(" ".join(w))
    rnd.shuffle(texts)
    return [(i if i % 11 else None, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3])]


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed, 60)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert rows_of(jaccard.join(df, part_bytes=5000)) == brute(rows)


def test_light_and_heavy_alone(spark, monkeypatch):
    rows = corpus(5, 40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for cut in (0, 16):
        monkeypatch.setattr(jaccard, "boundary", lambda histogram, j, cut=cut: cut)
        assert rows_of(jaccard.join(df, part_bytes=5000)) == brute(rows)


def test_documents_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert rows_of(jaccard.join(df, part_bytes=100_000)) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_keep_one(spark):
    rows = corpus(7, 20)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_shingles string")
    kept = [(r.doc_id, r.text) for r in jaccard.keep_one(df, part_bytes=5000).collect()]
    want = {c for _, n, c in brute(rows) if n and c != "None"}
    assert {str(k) for k, t in kept if shingle_set(t) and k is not None} == want
    assert sum(not shingle_set(t) for _, t in kept) == sum(not shingle_set(t) for _, t in rows)
    again = brute([(i, t) for i, (_, t) in enumerate(kept)])
    assert all(key == comp for key, _, comp in again)  # nothing that stays links with anything else that stays


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.join(df).collect() == [] and jaccard.keep_one(df).collect() == []
