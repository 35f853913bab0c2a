import numpy as np
import public_tokenizers

from vigil.llm import language
from vigil.llm.lattice import Lattice, Vocabulary
from vigil.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


def splits(word, pieces):
    if not word:
        yield []
    for k, p in enumerate(pieces):
        if p and word.startswith(p):
            for rest in splits(word[len(p):], pieces):
                yield [k, *rest]


def test_forward_and_expected_equal_enumeration():
    pieces = [b"a", b"b", b"c", b"ab", b"abc", b"bc", b"ca"]
    prob = np.array([[.1, .3], [.2, .1], [.1, .1], [.2, .2], [.1, .1], [.2, .1], [.1, .1]])
    words = [b"abcab", b"c", b"abc", b"bcabca", b""]
    buf, off = np.frombuffer(b"".join(words), np.uint8), np.cumsum([0] + [len(w) for w in words])
    lat = Lattice(Vocabulary(pieces), buf, off)
    got = lat.forward(prob[lat.piece])[lat.last]
    post = lat.expected(prob[lat.piece][:, 0])
    for w, word in enumerate(words):
        every = list(splits(word, pieces))
        want = sum(np.prod(prob[s], axis=0) for s in every)
        assert np.allclose(got[w], want)
        n = np.zeros(len(pieces))
        for s in every:
            for k in s:
                n[k] += np.prod(prob[s, 0]) / want[0]
        assert np.allclose(np.bincount(lat.piece[lat.owner == w], post[lat.owner == w], len(pieces)), n)


def test_edge_cases(spark):
    train = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "de"), (4, "x", None)],
                                  "doc_id long, text string, lang string")
    model = language.fit(train, PATH, "text", "lang")
    assert model[0] == ["de", "en"]
    docs = spark.createDataFrame([(1, "the dog", "q"), (2, None, "q"), (None, "", "q"), (4, "12 !? \n", "q"), (4, "und die", "q"), (5, "—…", "q"),
                                  (6, "漢字" * 5000, "q"), (7, "the " * 50000, "q"), (8, "a" * 1000, "q")], "doc_id long, text string, score string")
    got = {(r.doc_id, r.lang_pred) for r in language.predict(docs, model, PATH).collect()}
    assert {(1, "en"), (2, "und"), (None, "und"), (4, "und"), (4, "de"), (5, "und"), (7, "en")} <= got
    assert all(0 <= r.score <= 1 for r in language.predict(docs, model, PATH).collect())
    none = language.fit(train.filter("lang is null"), PATH, "text", "lang")
    assert {r.lang_pred for r in language.predict(docs, none, PATH).collect()} == {"und"}
    assert language.predict(docs.limit(0), model, PATH).collect() == []


def test_held_out_accuracy(spark, sf):
    got = QUERIES["op10_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 200 and held and all(r.lang_pred == r.lang for r in held if len(r.text) > 30)


def _model(langs=2):
    vocab, start = language.vocabulary(PATH)
    rng = np.random.default_rng(3)
    prob = start[:, None] * rng.uniform(0.2, 5, (vocab.size, langs))
    return vocab, prob / prob.sum(axis=0)


def _plain(vocab, prob, raw):
    """Log of the forward sum of one word, place by place, in logarithms."""
    lat = Lattice(vocab, np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    log = np.full((len(raw) + 1, prob.shape[1]), -np.inf)
    log[0] = 0
    for s, e, k in sorted(zip(lat.start, lat.end, lat.piece), key=lambda x: x[1]):
        log[e] = np.logaddexp(log[e], log[s] + np.log(prob[k]))
    return log[-1]


def test_runs_of_any_length_equal_the_plain_sum():
    vocab, prob = _model()
    scorer = language.Scorer(PATH, prob)
    runs = [b"the", b"a" * 1000, "漢字かな交じり文".encode() * 40, b"donaudampfschifffahrt" * 4, b"q"]
    low = np.frombuffer(b" ".join(runs), np.uint8)
    e = np.cumsum([len(r) + 1 for r in runs]) - 1
    got = scorer.runs(low, e - [len(r) for r in runs], e)
    for r, x in zip(runs, got):
        assert np.allclose(x, _plain(vocab, prob, b" " + r), rtol=1e-9)
        for block in (70, 333):
            assert np.allclose(scorer._carried(np.frombuffer(b" " + r, np.uint8), block), x, rtol=1e-9)
    again, per = scorer.texts(low, np.array([0, len(low)]))
    assert per[0] == 5 and np.allclose(again[0], got.sum(axis=0))
    assert np.allclose(scorer.texts(low, np.array([0, len(low)]))[0], again) and len(scorer.keys) == 2


def test_windows_cover_every_byte_once():
    s, e = np.array([0, 10, 200]), np.array([9, 199, 248])
    run, lo, hi, head, first, last = language._windows(s, e, 7)
    seen = np.zeros(300, int)
    for r, a, h, f, t in zip(run, lo, head, first, last):
        for place in range(f, t):
            seen[a + place - h] += 1 if place >= h else 0
    assert seen.sum() == 9 + 189 + 48 and seen.max() == 1 and (hi <= e[run]).all()


def test_rounds_raise_the_likelihood_and_expected_counts_add_up(spark):
    rows = [(k, "the cat sat on the mat and the dog ran home", "en") for k in range(5)] + [(9, "漢字" * 300, "zh"), (8, "die katze " * 20, "de")]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    last = None
    for rounds in (1, 2, 4):
        langs, _, prob = language.fit(train, PATH, "text", "lang", smoothing=1e-6, rounds=rounds)
        assert np.allclose(prob.sum(axis=0), 1)
        x, _ = language.Scorer(PATH, prob).texts(*language.K.text_bytes(language.pa.array([r[1] for r in rows])))
        own = sum(x[i, langs.index(r[2])] for i, r in enumerate(rows))
        assert last is None or own > last
        last = own
