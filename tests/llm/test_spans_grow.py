import random

from test_spans import rows_of, split

from vigil.llm import queries, spans


def runs(s, run=2, min_words=12):
    """(first, end) of the shortest long enough runs from and up to each sentence, or the whole of a shorter text."""
    size = [len(w) for w, _ in s]
    fit = lambda i, k: k - i >= run and sum(size[i:k]) >= min_words
    ahead = {(i, next((k for k in range(i + run, len(s) + 1) if fit(i, k)), None)) for i in range(len(s))}
    behind = {(next((i for i in range(k - run, -1, -1) if fit(i, k)), None), k) for k in range(1, len(s) + 1)}
    least = {(i, k) for i, k in ahead | behind if i is not None and k is not None}
    return sorted(least) or ([(0, len(s))] if s else [])


def gone(rows):
    """Places that go, by key; keys are distinct and not null."""
    seen, out = set(), {}
    for key, text in sorted(rows):
        s = split(text)
        out[key] = set()
        for i, k in runs(s):
            words = tuple(w for w, _ in s[i:k])
            if words in seen:
                out[key] |= set(range(i, k))
            seen.add(words)
    return out


def removed(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r.doc_id: r.n_removed for r in spans.strip(df, **how).collect()}


def passage(seed, words, size):
    rnd = random.Random(seed)
    w = [f"w{rnd.randrange(10 ** 6)}" for _ in range(words)]
    return " ".join(" ".join(w[i:i + size]) + "." for i in range(0, words, size))


def test_passage_of_short_sentences(spark):
    same = passage(1, 60, 3)
    rows = [(1, f"{passage(2, 40, 10)} {same} {passage(3, 40, 10)}"), (2, f"{passage(4, 20, 4)} {same} {passage(5, 20, 4)}")]
    assert removed(spark, rows, grow=True) == {1: 0, 2: 20}
    uneven = passage(6, 20, 20) + " One. Two three. Four."
    rows = [(1, f"{passage(7, 12, 3)} {uneven} {passage(8, 12, 3)}"), (2, f"{uneven} {passage(9, 12, 3)}"), (3, uneven)]
    assert removed(spark, rows, grow=True) == {1: 0, 2: 4, 3: 4}


def test_copies_of_short_texts(spark):
    one = passage(1, 30, 30)
    rows = [(1, one), (2, one), (3, "Just this."), (4, "just  This."), (5, "A b. C d."), (6, "A b. C d."), (7, "A b. C d. E."), (8, ""), (9, None)]
    assert removed(spark, rows, grow=True) == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0, 6: 2, 7: 0, 8: 0, 9: 0}


def test_grown_runs_equal_brute_force(spark):
    rnd = random.Random(5)
    sentence = lambda: " ".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 9))) + rnd.choice([".", "\n"])
    shared = [" ".join(sentence() for _ in range(6)) for _ in range(6)]
    rows = [(i, " ".join([sentence() for _ in range(rnd.randrange(4))] + rnd.choices(shared, k=rnd.randrange(3)))) for i in range(80)]
    assert removed(spark, rows, grow=True) == {k: len(v) for k, v in gone(rows).items()}


def test_query_leaves_nothing_of_copies(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    left = {r.doc_id: r.n_removed for r in queries.QUERIES["op2_substring_dedup"](spark, sf).collect()}
    assert left == {k: len(v) for k, v in gone(docs.items()).items()}
    first = {}
    for key in sorted(docs):
        if first.setdefault(docs[key], key) != key:
            assert left[key] == len(split(docs[key]))
