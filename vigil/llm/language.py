"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary have one probability per language.  A
word's probability is the sum over all its segmentations into pieces (forward
algorithm), a text's the product over its words; Bayes' rule gives the
language.  Probabilities come from expected piece counts of the training texts
by expectation-maximisation from a rank-based start.  The training words are
counted once per language and written to the shared folder; every round reads
that table and sends at most one number per language, piece and task.

Words are runs of letters (A-Z lower-cased, all bytes beyond ASCII), behind a
space as in the vocabulary.  Scores sum the segmentations of whole runs of any
length: alphas are rescaled on the way, and runs over ``BLOCK`` bytes carry the
alphas that later pieces can start from over the block's end.  Training counts the pieces
of long runs in stretches of 48 bytes, each seen with the longest piece's
length of text around it.  Bytes that no piece covers count as byte pieces.

Defined results: a null text or one without a letter is ``und`` with score 0.
Without training rows every prediction is ``und``.  A null id counts as
training, a null language does not.  Repeated rows keep one output row each; an
empty table gives none.  Input columns ``lang_pred`` and ``score`` are replaced.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import kernel as K
from vigil.llm.lattice import Lattice, Vocabulary
from vigil.llm.tokenfile import pieces as doc_ranges
from vigil.session import work_dir

SHORT = 48  # bytes of a stretch counted in training, and of the longest run whose score a worker remembers
BLOCK = 1 << 15  # bytes of a run scored at once
STEP_BYTES = 1 << 21
LATTICE_BYTES = 1 << 18
REMEMBERED = 400_000  # runs per worker
ROUNDS = 3

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[Vocabulary, np.ndarray]:
    """The model's pieces as byte strings (space for its word mark), all 256
    bytes among them, and the starting weights by rank."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out: dict[bytes, int] = {bytes([b]): 0 for b in range(256)}
    for k in range(sp.get_piece_size()):
        if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k)):
            out.setdefault(sp.id_to_piece(k).replace("▁", " ").encode(), k)
    rank = np.arange(len(out), dtype=float)
    rank[:256] = len(out)  # bytes last
    weight = 1 / (rank + 20)
    return Vocabulary(list(out)), weight / weight.sum()


def _slices(size: np.ndarray, limit: int):
    """Consecutive ranges of about ``limit`` bytes in all."""
    yield from doc_ranges(np.zeros(0, np.uint8), np.concatenate(([0], np.cumsum(size))), limit)


def _gather(low: np.ndarray, s: np.ndarray, e: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans as flat bytes and offsets, behind a space where ``space`` says so."""
    size, space = e - s, space.astype(np.int64)
    at = np.concatenate(([0], np.cumsum(size + space)))
    flat = np.full(at[-1], 0x20, np.uint8)
    flat[np.repeat(at[:-1] + space, size) + K.ragged(size)] = low[np.repeat(s, size) + K.ragged(size)]
    return flat, at


def _windows(s: np.ndarray, e: np.ndarray, margin: int):
    """Stretches of the runs with ``margin`` bytes around them: (run, start, end,
    whether the window starts the run, the stretch's first and last place in it)."""
    n = -(-(e - s) // SHORT)
    run = np.repeat(np.arange(len(s)), n)
    core = s[run] + K.ragged(n) * SHORT
    stop = np.minimum(core + SHORT, e[run])
    lo, hi = np.maximum(core - margin, s[run]), np.minimum(stop + margin, e[run])
    head = lo == s[run]
    return run, lo, hi, head, np.where(core == s[run], 0, core - lo + head), stop - lo + head


def _count_words(batches, path: str, langs: list[str]):
    """Distinct (window, language) of each slice with their occurrences."""
    margin = vocabulary(path)[0].longest - 1
    for b in batches:
        buf, off = K.text_bytes(b.column("text"))
        lang = pc.index_in(b.column("lang"), pa.array(langs)).to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi in doc_ranges(buf, off, 4 * STEP_BYTES):
            low, at = K.LOWER[buf[off[lo]:off[hi]]], off[lo:hi + 1] - off[lo]
            s, e, per = K.words(low, at, _LETTER)
            if not len(s):
                continue
            whose = np.repeat(lang[lo:hi], per).astype(np.uint64)
            run, ws, we, head, first, last = _windows(s, e, margin)
            with np.errstate(over="ignore"):
                tag = whose[run] << np.uint64(32) | (first << 16).astype(np.uint64) | (last << 1).astype(np.uint64) | head.astype(np.uint64)
                key = K.mix(K.span_hashes(low, ws, we) + K.mix(tag + np.uint64(1)))
            _, one, inverse = K.distinct(key)
            flat, at = _gather(low, ws[one], we[one], head[one])
            word = pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_pydict({
                "word": word, "lo": pa.array(first[one], pa.int32()), "hi": pa.array(last[one], pa.int32()),
                "g": pa.array(whose[run][one].astype(np.int32)), "n": pa.array(np.bincount(inverse, minlength=len(one)), pa.int64())})


def _expect(batches, path: str, prob: np.ndarray):
    """Expected piece counts per language over counted windows, one model per language."""
    vocab, _ = vocabulary(path)
    total = np.zeros((prob.shape[1], vocab.size))
    for b in batches:
        buf, off = K.text_bytes(b.column("word"))
        first, last, lang, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("lo", "hi", "g", "n"))
        for g in np.unique(lang):
            mine = np.flatnonzero(lang == g)
            for lo, hi in _slices(np.diff(off)[mine], LATTICE_BYTES):
                k = mine[lo:hi]
                flat, at = _gather(buf, off[k], off[k + 1], np.zeros(len(k), bool))
                lattice = Lattice(vocab, flat, at)
                weight = prob[lattice.piece, g]
                alpha, log = lattice.scaled_forward(weight[:, None])
                # a factor per byte changes no posterior; this one brings every word's sum to 1
                whole = np.log(np.maximum(alpha[lattice.last, 0], 1e-300)) + log[:, 0]
                weight = weight * np.exp(-(whole / np.maximum(lattice.size, 1))[lattice.owner] * lattice.length)
                place = lattice.start - lattice.first[lattice.owner]
                inside = (place >= first[k][lattice.owner]) & (place < last[k][lattice.owner])
                total[g] += np.bincount(lattice.piece, np.where(inside, lattice.expected(weight) * n[k][lattice.owner], 0.0), vocab.size)
    g, k = np.nonzero(total > 1e-9)
    yield pa.RecordBatch.from_pydict({"g": pa.array(g, pa.int32()), "k": pa.array(k, pa.int32()), "n": pa.array(total[g, k])})


def fit(train: DataFrame, path: str, text_col: str, lang_col: str, smoothing: float = 0.05,
        rounds: int = ROUNDS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log shares, piece probabilities) from rows with a language."""
    train = train.filter(F.col(f"`{lang_col}`").isNotNull()).select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    share = sorted((r["lang"], r["count"]) for r in train.groupBy("lang").count().collect())  # one row per language
    langs = [x for x, _ in share]
    if not langs:
        return [], np.zeros(0), np.zeros((0, 0))
    spark = train.sparkSession
    found = train.mapInArrow(lambda it: _count_words(it, path, langs), "word binary, lo int, hi int, g int, n long")
    where = work_dir(spark, "langwords")
    found.groupBy("word", "lo", "hi", "g").agg(F.sum("n").alias("n")).write.parquet(where)
    table = spark.read.parquet(where)
    vocab, start = vocabulary(path)
    prob = np.repeat(start[:, None], len(langs), axis=1)
    for _ in range(rounds):
        box = spark.sparkContext.broadcast(prob)  # languages x pieces of the fixed vocabulary
        rows = table.mapInArrow(lambda it: _expect(it, path, box.value), "g int, k int, n double").groupBy("g", "k").agg(F.sum("n").alias("n")).toPandas()
        prob = np.full((vocab.size, len(langs)), smoothing)
        prob[rows["k"], rows["g"]] += rows["n"]
        prob /= prob.sum(axis=0)
        box.unpersist()
    n = np.array([c for _, c in share], float)
    return langs, np.log(n / n.sum()), prob


class Scorer:
    """Log probabilities of runs per language; remembers those of short runs."""

    def __init__(self, path: str, prob: np.ndarray):
        self.vocab, self.prob = vocabulary(path)[0], prob
        self._forget()

    def _forget(self):
        self.keys, self.value = np.zeros(0, np.uint64), np.zeros((0, self.prob.shape[1]))

    def runs(self, low: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Log probability of each run behind a space, summed over all its segmentations."""
        out = np.empty((len(s), self.prob.shape[1]))
        order = np.argsort(e - s, kind="stable")
        fit = order[(e - s)[order] <= BLOCK]
        for lo, hi in _slices((e - s)[fit] + 1, LATTICE_BYTES):
            k = fit[lo:hi]
            lattice = Lattice(self.vocab, *_gather(low, s[k], e[k], np.ones(len(k), bool)))
            alpha, log = lattice.scaled_forward(self.prob[lattice.piece])
            out[k] = np.log(np.maximum(alpha[lattice.last], 1e-300)) + log
        for k in order[len(fit):]:
            out[k] = self._carried(np.concatenate((np.array([0x20], np.uint8), low[s[k]:e[k]])))
        return out

    def _carried(self, run: np.ndarray, block: int = BLOCK) -> np.ndarray:
        """A run of any length, a block at a time."""
        keep = self.vocab.longest - 1
        head, total = np.ones((1, self.prob.shape[1])), np.zeros(self.prob.shape[1])
        for b in range(0, len(run), block):
            part = run[b - len(head) + 1:b + block]
            lattice = Lattice(self.vocab, part, np.array([0, len(part)]))
            alpha, log = lattice.scaled_forward(self.prob[lattice.piece], head)
            head = alpha[-min(keep + 1, len(alpha)):]
            top = np.maximum(head.max(axis=0), 1e-300)
            head, total = head / top, total + log[0] + np.log(top)
        return total + np.log(np.maximum(head[-1], 1e-300))

    def texts(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log probability per language, runs) of each text."""
        low = K.LOWER[buf]
        s, e, per = K.words(low, off, _LETTER)
        keys, one, inverse = K.distinct(K.span_hashes(low, s, e))
        value = np.empty((len(keys), self.prob.shape[1]))
        known = K.member(self.keys, keys)
        value[known] = self.value[np.searchsorted(self.keys, keys[known])]
        new = np.flatnonzero(~known)
        value[new] = self.runs(low, s[one[new]], e[one[new]])
        small = new[(e - s)[one[new]] <= SHORT]
        if len(self.keys) + len(small) > REMEMBERED:
            self._forget()
        both = np.concatenate((self.keys, keys[small]))
        order = np.argsort(both, kind="stable")
        self.keys, self.value = both[order], np.concatenate((self.value, value[small]))[order]
        run = np.concatenate((np.zeros((1, self.prob.shape[1])), np.cumsum(value[inverse], axis=0)))
        edge = np.concatenate(([0], np.cumsum(per)))
        return run[edge[1:]] - run[edge[:-1]], per


def predict(docs: DataFrame, model, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with lang_pred and score (its posterior)."""
    langs, prior, prob = model
    keep = [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]
    box = docs.sparkSession.sparkContext.broadcast((prior, prob))  # languages x pieces of the fixed vocabulary

    def score(batches):
        prior, prob = box.value
        scorer = Scorer(path, prob)
        for b in batches:
            buf, off = K.text_bytes(b.column(text_col))
            ascii_letters = np.concatenate(([0], np.cumsum(_LETTER[buf] & (buf < 128), dtype=np.int64)))
            plain = np.diff(ascii_letters[off]) > 0
            best, value = [], []
            for lo, hi in doc_ranges(buf, off, STEP_BYTES):
                x, per = scorer.texts(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                x = np.exp(x + prior - (x + prior).max(axis=1, keepdims=True))
                x /= x.sum(axis=1, keepdims=True)
                text = b.column(text_col).slice(lo, hi - lo)
                for k in range(hi - lo):
                    ok = per[k] > 0 and (plain[lo + k] or _has_letter(text[k].as_py()))
                    g = int(x[k].argmax())
                    best.append(langs[g] if ok else "und")
                    value.append(float(x[k, g]) if ok else 0.0)
            out = [b.column(c) for c in keep] + [pa.array(best, pa.string()), pa.array(value, pa.float64())]
            yield pa.RecordBatch.from_arrays(out, [*keep, "lang_pred", "score"])

    schema = T.StructType([*[f for f in docs.schema.fields if f.name in keep],
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    if not langs:
        return docs.select(*[f"`{c}`" for c in keep], F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return docs.select(*[f"`{c}`" for c in keep], f"`{text_col}`").mapInArrow(score, schema)


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)
