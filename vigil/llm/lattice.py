"""Segmentation lattices of words over a fixed piece vocabulary, as flat arrays."""

from __future__ import annotations

import numpy as np

from vigil.llm import kernel as K

_U = np.uint64


class Vocabulary:
    """Byte strings with ids 0..n-1 and an open-addressing table of their prefixes."""

    def __init__(self, pieces: list[bytes]):
        self.size = len(pieces)
        self.longest = max(map(len, pieces))
        ids: dict[int, int] = {}
        for k, piece in enumerate(pieces):
            h = 0
            for i, b in enumerate(piece):
                h = int(self.step(np.array([h], np.uint64), np.array([b], np.uint8))[0])
                ids.setdefault(h, -1)
                if i == len(piece) - 1:
                    ids[h] = k
        self.bits = max(8, int(np.ceil(np.log2(len(ids)))) + 2)
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.ids = np.full(1 << self.bits, -1, np.int32)
        for h, k in ids.items():
            at = h >> (64 - self.bits)
            while self.keys[at]:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.ids[at] = h, k

    @staticmethod
    def step(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Hash of a prefix grown by a byte; never 0."""
        with np.errstate(over="ignore"):
            return K.mix(h * _U(K._M) + byte.astype(np.uint64) + _U(1)) | _U(1)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is a prefix of a piece, id of the piece or -1)."""
        known, ids = np.zeros(len(h), bool), np.full(len(h), -1, np.int32)
        todo = np.arange(len(h))
        at = (h >> _U(64 - self.bits)).astype(np.int64)
        while len(todo):
            key = self.keys[at]
            hit = key == h[todo]
            known[todo[hit]] = True
            ids[todo[hit]] = self.ids[at[hit]]
            on = ~hit & (key != 0)
            todo, at = todo[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return known, ids


class Lattice:
    """All pieces inside a list of words (flat bytes and offsets).  Node ``i`` of a
    word lies before its byte ``i``; edges are ordered by their end's place in
    the word, then by end node, so one pass per place runs all words at once."""

    def __init__(self, vocabulary: Vocabulary, buf: np.ndarray, off: np.ndarray):
        n = len(off) - 1
        size = np.diff(off)
        self.word = np.repeat(np.arange(n), size)
        place = K.ragged(size)
        stop = np.repeat(off[1:], size)
        at, h = np.arange(len(buf)), np.zeros(len(buf), np.uint64)
        starts, ends, ids = [], [], []
        for length in range(1, vocabulary.longest + 1):
            fit = at + length <= stop[at]
            at, h = at[fit], h[fit]
            if not len(at):
                break
            h = vocabulary.step(h, buf[at + length - 1])
            known, piece = vocabulary.find(h)
            here = piece >= 0
            starts.append(at[here])
            ends.append(at[here] + length)
            ids.append(piece[here])
            at, h = at[known], h[known]
        start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        end = np.concatenate(ends) if ends else start
        piece = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        length = end - start
        where = place[start] + length if len(start) else start
        order = np.argsort(where * (len(buf) + 1) + end, kind="stable")
        start, end, self.piece, self.length = start[order], end[order], piece[order], length[order]
        self.owner = self.word[start] if len(start) else start
        self.start, self.end = start + self.owner, end + self.owner  # as nodes: a word has one node more than bytes
        self.first, self.last = off[:-1] + np.arange(n), off[1:] + np.arange(n)
        self.nodes = len(buf) + n
        self.size, self.longest = size, vocabulary.longest
        self.cuts = np.searchsorted(where[order], np.arange(1, (int(size.max()) if n else 0) + 2))

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Sum over all segmentations up to each node of the products of the
        edges' weights (edges x models)."""
        alpha = np.zeros((self.nodes, weight.shape[1]))
        alpha[self.first] = 1.0
        for lo, hi in zip(self.cuts[:-1], self.cuts[1:]):
            if hi > lo:
                end = self.end[lo:hi]
                head = np.flatnonzero(np.concatenate(([True], end[1:] != end[:-1])))
                alpha[end[head]] = np.add.reduceat(alpha[self.start[lo:hi]] * weight[lo:hi], head)
        return alpha

    def scaled_forward(self, weight: np.ndarray, head: np.ndarray | None = None, every: int = 16) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`forward` for words of any length: (alphas, logarithms of the
        factors taken out of each word's last ones).  Every few places the alphas that a
        later edge can still start from are divided by their largest.  ``head``
        gives the first alphas of a single word; only edges beyond them count."""
        alpha = np.zeros((self.nodes, weight.shape[1]))
        log = np.zeros((len(self.first), weight.shape[1]))
        alpha[self.first] = 1.0
        if head is not None:
            alpha[:len(head)] = head
        skip = 0 if head is None else len(head) - 1
        for p in range(skip + 1, len(self.cuts)):
            lo, hi = self.cuts[p - 1], self.cuts[p]
            if hi > lo:
                end = self.end[lo:hi]
                new = np.flatnonzero(np.concatenate(([True], end[1:] != end[:-1])))
                alpha[end[new]] = np.add.reduceat(alpha[self.start[lo:hi]] * weight[lo:hi], new)
            if p % every == 0:
                on = np.flatnonzero(self.size >= p)
                near = self.first[on][:, None] + p - np.arange(min(self.longest, p + 1))
                part = alpha[near]
                top = part.max(axis=1)
                top[top <= 0] = 1.0
                alpha[near] = part / top[:, None, :]
                log[on] += np.log(top)
        return alpha, log

    def expected(self, weight: np.ndarray) -> np.ndarray:
        """Posterior probability of each edge under one model (forward and backward)."""
        alpha = self.forward(weight[:, None])[:, 0]
        beta = np.zeros(self.nodes)
        beta[self.last] = 1.0
        for lo, hi in zip(self.cuts[-2::-1], self.cuts[:0:-1]):
            if hi > lo:  # edges that start where these end have been done
                np.add.at(beta, self.start[lo:hi], beta[self.end[lo:hi]] * weight[lo:hi])
        total = alpha[self.last][self.owner]
        return alpha[self.start] * weight * beta[self.end] / np.where(total > 0, total, 1.0)
