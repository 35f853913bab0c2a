"""Many forests at once: folds, feature sets, sizes and trees in one job per level.

The rows are binned once and written.  All trees of all forests then grow
together, level by level: each task walks its rows down every tree and counts
class weights per (tree, node, feature, bin); one shuffle adds the counts of a
(tree, node, feature) and finds its best cut; the driver, which receives one row
per node and tried feature, takes the best feature.  A level costs one job
however many forests there are.

* Bagging is a Poisson(1) weight per row and tree from a keyed hash of the row's
  key, so it needs no pass of its own and does not depend on the partitioning.
  Counts are whole numbers: neither do the trees.
* A node's candidate features come from a keyed hash of (tree, node, feature).
* Nodes are split whatever the depth limit is, so a tree cut at a smaller depth,
  and the first n trees of a forest, are the trees that a smaller forest would
  have grown.  :func:`evaluate` scores any number of such views from one growth.

A forest may hold out a fold, and take a share of the other rows (nested by a
hash order inside each fold).  Cuts are at exact quantiles (``bins`` - 1 of
them at most); a null or NaN feature has a bin of its own below all others, and
a null label is left out.  A node of one class, or none of whose cuts leaves
``min_leaf`` on both sides, is a leaf.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.cache import fewer_tasks
from vigil.functions.ordering import bucket_of
from vigil.functions.selection import exact_quantiles
from vigil.operators.prep import class_rank
from vigil.operators.profile import c
from vigil.session import work_dir

CHUNK_ROWS = 1 << 18
HELD_BYTES = 16 << 20
HELD_ROWS = 1 << 20
GROUP_BYTES = 32 << 20
ROWS_PER_TASK = 1 << 20


class Forest(NamedTuple):
    """What to grow.  ``skip_fold``: held out; ``share``: of each other fold's
    rows; ``mtry``: features tried per node (None: the root of their number);
    ``bootstrap`` off and ``random_cuts`` on: extremely randomised trees."""
    features: tuple[str, ...]
    skip_fold: int | None = None
    share: float = 1.0
    trees: int = 100
    depth: int = 6
    mtry: int | None = None
    min_leaf: int = 1
    min_split: int = 2
    bootstrap: bool = True
    random_cuts: bool = False

    def tried(self) -> int:
        return min(len(self.features), max(1, self.mtry or math.isqrt(len(self.features))))


class Binned(NamedTuple):
    """The written table: ``_h`` (hash of the key), ``_y``, ``_fold``, ``_pos``
    (hash order inside the fold), ``_n`` (rows of the fold), ``_bins``, and the key."""
    path: str
    cols: tuple[str, ...]
    cuts: dict[str, list[float]]
    bins: int
    classes: int
    tasks: int
    ordered: bool = True

    def read(self, spark) -> DataFrame:
        return spark.read.parquet(self.path)


def bin_columns(cuts: dict[str, list[float]]):
    """Bins of the columns as one array expression: 0 for a missing value, else
    1 + the number of cuts below it."""
    one = lambda x: F.when(c(x).isNull() | F.isnan(c(x).cast("double")), 0).otherwise(
        1 + bucket_of([x], cuts[x]).cast("int"))
    return F.array(*[one(x).cast("short") for x in cuts])


def fit_cuts(df: DataFrame, cols: list[str], bins: int = 32) -> dict[str, list[float]]:
    """Cut values per column: the distinct ones among ``bins - 2`` evenly spaced exact quantiles."""
    probs = [i / (bins - 1) for i in range(1, bins - 1)]
    return {x: sorted({float(v) for v in q if v is not None}) for x, q in exact_quantiles(df, list(cols), probs).items()}


def bin_batch(batch: pa.RecordBatch, at: int, cuts: dict[str, list[float]]) -> np.ndarray:
    """Bins (rows, columns) of the double columns from number ``at`` on, as :func:`bin_columns` gives them."""
    out = np.zeros((batch.num_rows, len(cuts)), np.int16)
    for j, v in enumerate(cuts.values()):
        x = batch.column(at + j).to_numpy(zero_copy_only=False).astype(float)  # a null is NaN
        out[:, j] = np.where(np.isnan(x), 0, 1 + np.searchsorted(np.array(v), x, "left"))
    return out


def raw_columns(cuts: dict[str, list[float]]) -> list:
    return [c(x).cast("double").alias(f"_x{j}") for j, x in enumerate(cuts)]


def bin_table(df: DataFrame, cols: list[str], key: str, label: str, fold: str | None = "fold", bins: int = 32, real: bool = False,
              ordered: bool = True) -> Binned:
    """Bins, orders and writes the rows with a label.  ``fold`` None: one fold, 0;
    ``real``: the label is a number to predict, not a class; ``ordered`` off: no
    hash order, for forests that take whole folds."""
    spark = df.sparkSession
    n, top = df.agg(F.count(F.lit(1)), F.max(c(label).cast("int"))).first()
    df = fewer_tasks(df, n)
    cuts = fit_cuts(df, cols, bins)
    rows = df.where(c(label).isNotNull()).select(
        c(key).alias("_key"), c(label).cast("double" if real else "int").alias("_y"), (c(fold).cast("int") if fold else F.lit(0)).alias("_fold"),
        *raw_columns(cuts))
    first = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:3])

    def run(batches):
        for b in batches:
            found = bin_batch(b, 3, cuts)
            ends = pa.array(np.arange(0, len(cuts) * (b.num_rows + 1), len(cuts), dtype=np.int32) if cuts else np.zeros(b.num_rows + 1, np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.ListArray.from_arrays(ends, pa.array(found.ravel()))],
                                             names=["_key", "_y", "_fold", "_bins"])

    rows = rows.mapInArrow(run, f"{first}, _bins array<short>")
    if ordered:
        rows = class_rank(rows, "_fold", "_key", 7)
    none = F.lit(0).cast("long")
    rows = rows.select("_key", F.xxhash64("_key").alias("_h"), "_y", "_fold", *((F.col("_rank").alias("_pos"), "_n") if ordered else
                                                                                 (none.alias("_pos"), none.alias("_n"))), "_bins")
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(n / ROWS_PER_TASK))
    path = work_dir(spark, "binned")
    rows.repartition(tasks, "_h").write.parquet(path)
    width = max(2, 2 + max((len(v) for v in cuts.values()), default=0))
    return Binned(path, tuple(cols), cuts, width, 0 if real else int(top or 0) + 1, tasks, ordered)


# ---------------------------------------------------------------- keyed hashes

_U = np.uint64
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix generator."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def uniform(seed: int, *parts) -> np.ndarray:
    """Uniform [0, 1) values of the (broadcast) integer parts."""
    x = _U(seed)
    with np.errstate(over="ignore"):
        for p in parts:
            x = _mix(np.asarray(p).astype(np.int64).view(_U) + x * _U(0x9E3779B97F4A7C15) + _U(1))
    return (x >> _U(11)) * 2.0**-53


def _poisson_table() -> np.ndarray:
    """Weight by the first 16 bits of a uniform value; 255 where later bits decide."""
    low = np.searchsorted(_POISSON, np.arange(1 << 16) * 2.0**-16, "right")
    high = np.searchsorted(_POISSON, (np.arange(1 << 16) + 1) * 2.0**-16, "right")
    return np.where(low == high, low, 255).astype(np.uint8)


_WEIGHT = _poisson_table()
HASH_ROWS = 1 << 14


def poisson_weights(seed: int, tree: int, h: np.ndarray) -> np.ndarray:
    """``searchsorted`` of ``uniform(seed, tree, h)`` in the cumulated probabilities, block by block."""
    base = _U(seed)
    with np.errstate(over="ignore"):
        base = _mix(np.array([tree], np.int64).view(_U) + base * _U(0x9E3779B97F4A7C15) + _U(1))[0] * _U(0x9E3779B97F4A7C15) + _U(1)
        out, keys = np.empty(len(h), np.uint8), np.ascontiguousarray(h, np.int64).view(_U)
        x, y = np.empty(HASH_ROWS, _U), np.empty(HASH_ROWS, _U)
        for lo in range(0, len(h), HASH_ROWS):
            n = min(HASH_ROWS, len(h) - lo)
            a, b = x[:n], y[:n]
            np.add(keys[lo:lo + n], base, out=a)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                np.right_shift(a, _U(shift), out=b)
                np.bitwise_xor(a, b, out=a)
                np.multiply(a, _U(factor), out=a)
            np.right_shift(a, _U(31), out=b)
            np.bitwise_xor(a, b, out=a)
            np.right_shift(a, _U(48), out=b)
            w = _WEIGHT.take(b.view(np.int64), out=out[lo:lo + n], mode="clip")
            unsure = np.flatnonzero(w == 255)
            if len(unsure):
                w[unsure] = np.searchsorted(_POISSON, (a[unsure] >> _U(11)) * 2.0**-53, "right")
    return out


def node_features(forest: Forest, places: np.ndarray, seed: int, tree: int, nodes: np.ndarray) -> np.ndarray:
    """(nodes x tried) column numbers, ascending; ``places``: the forest's column numbers."""
    k = forest.tried()
    if k == len(places):
        return np.tile(np.sort(places), (len(nodes), 1))
    order = np.argsort(uniform(seed + 1, np.int64(tree), nodes[:, None], places[None, :]), axis=1, kind="stable")[:, :k]
    return np.sort(places[order], axis=1)


# ---------------------------------------------------------------- trees

class Trees:
    """Nodes of many trees in flat arrays; tree ``m`` has ``at[m]:at[m + 1]``, its
    root first.  ``feat`` -1: leaf; rows with a bin up to ``cut`` go to ``left``, others to the next node."""

    def __init__(self, n: int, classes: int):
        self.at = np.arange(n + 1)
        self.feat, self.cut, self.left = np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.gain, self.value = np.zeros(n), np.zeros((n, classes), np.int64)

    def tree(self, m: int):
        s = slice(self.at[m], self.at[m + 1])
        return self.feat[s], self.cut[s], self.left[s]

    def split(self, m: np.ndarray, node: np.ndarray, feat, cut, gain, low, high) -> np.ndarray:
        """Splits nodes (ordered by tree, then node) and appends their children to
        their trees; returns the number of each left child."""
        per = np.bincount(m, minlength=len(self.at) - 1)
        nth = np.arange(len(m)) - np.concatenate(([0], np.cumsum(per)))[m]
        first = np.diff(self.at)[m] + 2 * nth
        at = self.at[m] + node
        self.feat[at], self.cut[at], self.gain[at], self.left[at] = feat, cut, gain, first
        put = np.repeat(self.at[1:][m], 2)
        pairs = np.stack((low, high), axis=1).reshape(2 * len(m), self.value.shape[1])
        self.feat, self.cut, self.left = np.insert(self.feat, put, -1), np.insert(self.cut, put, 0), np.insert(self.left, put, 0)
        self.gain, self.value = np.insert(self.gain, put, 0.0), np.insert(self.value, put, pairs, axis=0)
        self.at = self.at + np.concatenate(([0], np.cumsum(2 * per)))
        return first


def walk(tree, bins: np.ndarray, rows: np.ndarray, steps: int, node: np.ndarray | None = None) -> np.ndarray:
    """Node of each row after at most ``steps`` splits from ``node`` (the root);
    ``bins`` is (columns, all rows), contiguous."""
    feat, cut, left = tree
    inner = feat >= 0
    first = np.maximum(feat, 0).astype(np.int64) * bins.shape[1]
    cut = np.where(inner, cut, np.iinfo(np.int32).max)  # a leaf leads to itself
    left = np.where(inner, left, np.arange(len(left)))
    flat = bins.reshape(-1)
    node = np.zeros(len(rows), np.int64) if node is None else node.astype(np.int64)
    for _ in range(steps):
        if not inner[node].any():
            break
        right = flat.take(first.take(node) + rows) > cut.take(node)
        node = left.take(node) + right
    return node


WALK_ROWS = 1 << 9


def groups(tree, bins: np.ndarray, rows: np.ndarray, steps: int) -> list[tuple[int, np.ndarray]]:
    """Rows by the node that they are in after at most ``steps`` splits, as (node, rows).

    Nodes are halved one by one, which reads a row once a split; below
    ``WALK_ROWS`` rows a node on average all rows walk together."""
    feat, cut, left = tree
    done, live = [], [(0, rows)]
    for k in range(steps):
        if not live:
            break
        if len(live) * WALK_ROWS > sum(len(r) for _, r in live):
            mine = np.concatenate([r for _, r in live])
            node = walk(tree, bins, mine, steps - k, np.repeat([n for n, _ in live], [len(r) for _, r in live]))
            order = np.argsort(node, kind="stable")
            names, first = np.unique(node[order], return_index=True)
            return done + list(zip(names.tolist(), np.split(mine[order], first[1:])))
        split, live = live, []
        for node, mine in split:
            f = int(feat[node])
            if f < 0:
                done.append((node, mine))
                continue
            right, next_ = bins[f].take(mine) > cut[node], int(left[node])
            live.append((next_ + 1, mine.compress(right)))
            live.append((next_, mine.compress(np.logical_not(right, out=right))))
    return done + live


def node_counts(code: np.ndarray, grouped: list[tuple[int, np.ndarray]], nodes: np.ndarray, feats: np.ndarray, weights: np.ndarray | None,
                cells: int) -> np.ndarray:
    """(nodes, tried, cells) weights of the rows of ``nodes``; ``code``: each column's cell of every row."""
    place = dict(zip(nodes.tolist(), range(len(nodes))))
    mine = [(place[node], rows) for node, rows in grouped if node in place and len(rows)]
    k, total = feats.shape[1], sum(len(rows) for _, rows in mine)
    if total >= len(mine) * WALK_ROWS:
        counts = np.zeros((len(nodes), k, cells), np.int64)
        for i, rows in mine:
            w = None if weights is None else weights.take(rows).astype(float)
            for j, f in enumerate(feats[i].tolist()):
                counts[i, j] = np.bincount(code[f].take(rows), w, cells)
        return counts
    rows = np.concatenate([r for _, r in mine]) if mine else np.zeros(0, np.int64)
    s = np.repeat([i for i, _ in mine], [len(r) for _, r in mine]) if mine else rows
    w, out = None if weights is None else weights.take(rows), np.zeros(len(nodes) * k * cells)
    for j in range(k):
        out += np.bincount((s * k + j) * cells + code[feats[s, j], rows], w, len(out))
    return out.astype(np.int64).reshape(len(nodes), k, cells)


def _gathered(batches):
    """Batches with ``CHUNK_ROWS`` rows or more together, the last with fewer."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= CHUNK_ROWS:
            yield held
            held, n = [], 0
    if n:
        yield held


def _chunks(batches, cols: int):
    """Rows as numpy: key hash, label, fold, position, fold size, bins (columns, rows)."""
    for held in _gathered(batches):
        yield _chunk(held, cols)


def _chunk(batches, cols: int):
    t = pa.Table.from_batches(batches)
    num = lambda x: t[x].to_numpy()
    bins = np.concatenate([b.column(t.schema.get_field_index("_bins")).flatten().to_numpy() for b in batches])
    kind = np.uint8 if bins.max(initial=0) < 256 else np.int16
    return num("_h"), num("_y"), num("_fold"), num("_pos"), num("_n"), np.ascontiguousarray(bins.reshape(-1, cols).T, kind)


def chunk_with(batches, cols: int, extra: str):
    """A chunk and one more column of it."""
    return _chunk(batches, cols), pa.Table.from_batches(batches)[extra].to_numpy()


def chunks_with(batches, cols: int, extra: str):
    for held in _gathered(batches):
        yield chunk_with(held, cols, extra)


def _used(forest: Forest, fold: np.ndarray, pos: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Training rows of the forest."""
    use = np.ones(len(fold), bool) if forest.skip_fold is None else fold != forest.skip_fold
    return use if forest.share >= 1 else use & (pos < np.floor(forest.share * n + 0.5))


class Grown(NamedTuple):
    table: Binned
    forests: list[Forest]
    first: list[int]  # number of each forest's first tree
    trees: Trees
    seed: int

    def importances(self, i: int) -> list[tuple[str, float]]:
        """Features of forest ``i`` by falling share of the impurity decrease: mean over its trees of each tree's shares."""
        total, grew = np.zeros(len(self.table.cols)), 0
        for m in range(self.first[i], self.first[i] + self.forests[i].trees):
            s = slice(self.trees.at[m], self.trees.at[m + 1])
            inner = self.trees.feat[s] >= 0
            g = np.bincount(self.trees.feat[s][inner], self.trees.gain[s][inner], minlength=len(total))
            if g.sum() > 0:
                total, grew = total + g / g.sum(), grew + 1
        share = dict(zip(self.table.cols, (total / max(grew, 1)).tolist()))
        return sorted(((f, share[f]) for f in self.forests[i].features), key=lambda t: (-t[1], t[0]))


HIST = "slot int, tree int, node int, feat int, counts binary"
BEST = "tree int, node int, feat int, cut int, gain double, low binary, high binary"


def count_level(table: DataFrame, per_chunk, cols: int, cells: int, slots: int, kind=np.int32, chunks=None) -> DataFrame:
    """Histogram rows: ``per_chunk(chunk)`` yields, tree by tree and in the same
    order for every chunk, the tree's number, its open nodes, their (nodes x tried)
    columns and the counts (nodes, tried, cells) over the chunk.  A task holds up to
    ``HELD_ROWS`` rows, adds each tree up over them and sends it.
    ``kind``: of the numbers sent, ``chunks``: how a task reads its rows."""
    chunks = chunks or _chunks

    def emit(held):
        tree, node, feat, data = [], [], [], []
        for m, nodes, feats, counts in held:
            flat = counts.reshape(-1, cells)
            some = flat.any(axis=1)
            data.append(flat[some].astype(kind))
            tree.append(np.full(len(data[-1]), m, np.int32))
            node.append(np.repeat(nodes, feats.shape[1])[some].astype(np.int32))
            feat.append(feats.ravel()[some].astype(np.int32))
        if not data or not sum(map(len, data)):
            return
        tree, node, feat, data = (np.concatenate(x) for x in (tree, node, feat, data))
        step = cells * data.itemsize
        blob = pa.Array.from_buffers(pa.binary(), len(node), [None, pa.py_buffer(np.arange(0, step * (len(node) + 1), step, dtype=np.int32)),
                                                              pa.py_buffer(data)])
        slot = (uniform(3, tree, node, feat) * slots).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(tree), pa.array(node), pa.array(feat), blob],
                                         names=["slot", "tree", "node", "feat", "counts"])

    def summed(some):
        held, size = [], 0
        for parts in zip(*map(per_chunk, some)):
            m, nodes, feats, counts = parts[0]
            for other in parts[1:]:
                counts = counts + other[3]
            held.append((m, nodes, feats, counts))
            size += counts.nbytes
            if size > HELD_BYTES:
                yield from emit(held)
                held, size = [], 0
        yield from emit(held)

    def run(batches):
        some, n = [], 0
        for chunk in chunks(batches, cols):
            some.append(chunk)
            n += len(chunk[0])
            if n >= HELD_ROWS:
                yield from summed(some)
                some, n = [], 0
        if some:
            yield from summed(some)

    return table.mapInArrow(run, HIST)


def _bytes_of(column: pa.ChunkedArray) -> bytes | memoryview:
    """The values of a binary column one after the other."""
    parts = [memoryview(x.buffers()[2])[(at := np.frombuffer(x.buffers()[1], np.int64 if pa.types.is_large_binary(x.type) else np.int32)
                                         [x.offset:x.offset + len(x) + 1])[0]:at[-1]] for x in column.chunks if len(x)]
    return parts[0] if len(parts) == 1 else b"".join(parts)


def merged(t: pa.Table, shape: tuple[int, int], kind, choose) -> pa.Table:
    """Histogram rows added up per (tree, node, feature) and cut where ``choose``
    says; ``choose(tree, node, feat, counts)`` returns the cut bin (-1: none) and its gain."""
    tree, node, feat = (t[x].to_numpy().astype(np.int64) for x in ("tree", "node", "feat"))
    data = np.frombuffer(_bytes_of(t["counts"]), kind).reshape(len(tree), *shape)
    order = np.lexsort((feat, node, tree))
    tree, node, feat = tree[order], node[order], feat[order]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(tree) != 0) | (np.diff(node) != 0) | (np.diff(feat) != 0)))[:len(tree)])
    counts = np.add.reduceat(data[order].astype(np.int64), new, axis=0) if len(new) else data.astype(np.int64)
    tree, node, feat = tree[new], node[new], feat[new]
    cut, gain = choose(tree, node, feat, counts)
    low = np.where((np.arange(shape[0]) <= cut[:, None])[:, :, None], counts, 0).sum(axis=1)
    high = counts.sum(axis=1) - low
    rows = lambda x: pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())
    return pa.table({"tree": pa.array(tree, pa.int32()), "node": pa.array(node, pa.int32()), "feat": pa.array(feat, pa.int32()),
                     "cut": pa.array(cut, pa.int32()), "gain": pa.array(gain, pa.float64()), "low": rows(low), "high": rows(high)})


def best_cuts(hist: DataFrame, slots: int, shape: tuple[int, int], kind, choose) -> pa.Table:
    """One row per (tree, node, feature) over all tasks; a slot of them per group."""
    found = hist.repartition(slots, "slot").groupBy("slot").applyInArrow(lambda t: merged(t, shape, kind, choose), BEST)
    return found.toArrow()


def winners(rows: pa.Table, channels: int) -> tuple:
    """Per (tree, node) in order: the row of the largest gain, of equal ones the
    lowest column and cut."""
    tree, node, feat, cut = (rows[x].to_numpy().astype(np.int64) for x in ("tree", "node", "feat", "cut"))
    gain = rows["gain"].to_numpy()
    low, high = (np.frombuffer(_bytes_of(rows[x]), np.int64).reshape(-1, channels) for x in ("low", "high"))
    order = np.lexsort((cut, feat, -gain, node, tree))
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(tree[order]) != 0) | (np.diff(node[order]) != 0)
    o = order[first]
    return tree[o], node[o], feat[o], cut[o], gain[o], low[o], high[o]


def gini_gain(counts: np.ndarray, min_leaf: np.ndarray) -> np.ndarray:
    """Weighted decrease of the Gini impurity of every cut (rows, bins - 1);
    -inf where a side has less than ``min_leaf``."""
    low = np.cumsum(counts, axis=1)[:, :-1].astype(float)
    every = counts.sum(axis=1)[:, None].astype(float)
    high = every - low
    score = lambda x: (x * x).sum(axis=-1) / np.maximum(x.sum(axis=-1), 1e-300)
    gain = score(low) + score(high) - score(every)
    ok = (low.sum(axis=-1) >= min_leaf[:, None]) & (high.sum(axis=-1) >= min_leaf[:, None])
    return np.where(ok, gain, -np.inf)


def grow(spark, table: Binned, forests: list[Forest], seed: int = 42) -> Grown:
    """All trees of all forests, one job per level."""
    if not table.ordered and any(f.share < 1 for f in forests):
        raise ValueError("a share of the rows needs an ordered table")
    first = np.concatenate(([0], np.cumsum([f.trees for f in forests]))).tolist()
    owner = np.repeat(np.arange(len(forests)), [f.trees for f in forests])
    number = np.concatenate([np.arange(f.trees) for f in forests]) if forests else np.zeros(0, np.int64)
    places = [np.array([table.cols.index(x) for x in f.features], np.int64) for f in forests]
    trees, classes, shape = Trees(len(owner), table.classes), table.classes, (table.bins, table.classes)
    open_tree, open_node = np.arange(len(owner)), np.zeros(len(owner), np.int64)
    min_leaf = np.array([f.min_leaf for f in forests], np.int64)
    rows, cells = table.read(spark), table.bins * table.classes

    for level in range(max((f.depth for f in forests), default=0)):
        live = np.array([forests[o].depth > level for o in owner])[open_tree]
        open_tree, open_node = open_tree[live], open_node[live]
        if not len(open_tree):
            break
        bounds = np.searchsorted(open_tree, np.arange(len(owner) + 1))
        tried = np.array([f.tried() for f in forests])[owner]
        size = int(tried[open_tree].sum()) * cells * 4 * table.tasks
        slots = max(spark.sparkContext.defaultParallelism, math.ceil(size / GROUP_BYTES))

        def per_chunk(chunk, trees=trees, open_node=open_node, bounds=bounds, level=level):
            h, y, fold, pos, n, bins = chunk
            code = bins * bins.dtype.type(classes) + y.astype(bins.dtype) if cells <= 256 else bins.astype(np.int64) * classes + y
            todo = np.flatnonzero(np.diff(bounds))
            known, used, weights, starts = None, {}, None, {}
            for m in todo[np.argsort(number[todo], kind="stable")].tolist():  # forests share the weights of their trees of a number
                forest, t = forests[owner[m]], int(number[m])
                if t != known:
                    known, weights, starts = t, None, {}
                part = (forest.skip_fold, forest.share)
                if part not in used:
                    used[part] = _used(forest, fold, pos, n)
                if forest.bootstrap and weights is None:
                    weights = poisson_weights(seed, t, h)
                if (*part, forest.bootstrap) not in starts:
                    starts[*part, forest.bootstrap] = np.flatnonzero(used[part] & (weights > 0) if forest.bootstrap else used[part])
                nodes = open_node[bounds[m]:bounds[m + 1]]
                feats = node_features(forest, places[owner[m]], seed, t, nodes)
                grouped = groups(trees.tree(m), bins, starts[*part, forest.bootstrap], level)
                yield m, nodes, feats, node_counts(code, grouped, nodes, feats, weights if forest.bootstrap else None, cells)

        def choose(tree, node, feat, counts):
            gain = gini_gain(counts, min_leaf[owner[tree]])
            drawn = np.array([f.random_cuts for f in forests])[owner[tree]]
            if drawn.any():
                some = counts.sum(axis=2) > 0
                lo, hi = some.argmax(axis=1), counts.shape[1] - 1 - some[:, ::-1].argmax(axis=1)
                u = uniform(seed + 2, number[tree], node, feat)
                cut = lo + np.floor(u * np.maximum(hi - lo, 1)).astype(np.int64)
                other = np.arange(gain.shape[1])[None, :] != cut[:, None]
                gain = np.where(drawn[:, None] & other, -np.inf, gain)
            best = gain.argmax(axis=1)
            top = gain[np.arange(len(gain)), best]
            none = ~(top > 1e-9)
            return np.where(none, -1, best), np.where(none, 0.0, top)

        hist = count_level(rows, per_chunk, len(table.cols), cells, slots)
        m, node, feat, cut, gain, low, high = winners(best_cuts(hist, slots, shape, np.int32, choose), classes)
        if level == 0:
            trees.value[trees.at[m]] = low + high
        good = cut >= 0
        m, node, low, high = m[good], node[good], low[good], high[good]
        left = trees.split(m, node, feat[good], cut[good], gain[good], low, high)
        child = np.stack((left, left + 1), axis=1).ravel()
        owned = np.repeat(m, 2)
        value = np.stack((low, high), axis=1).reshape(2 * len(m), classes)
        least = np.array([max(f.min_split, 2 * f.min_leaf) for f in forests])[owner[owned]]
        again = ((value > 0).sum(axis=1) > 1) & (value.sum(axis=1) >= least)
        open_tree, open_node = owned[again], child[again]
    return Grown(table, forests, first, trees, seed)


# ---------------------------------------------------------------- scores

class View(NamedTuple):
    """The first ``trees`` trees of a forest, cut at ``depth`` (None: as grown)."""
    forest: int
    trees: int | None = None
    depth: int | None = None


def _votes(grown: Grown, i: int, views: list[tuple[int, int]], bins: np.ndarray, rows: np.ndarray):
    """Yields (view, summed class shares of the rows) for the (trees, depth) views of forest ``i``."""
    depths, classes = sorted({d for _, d in views}), grown.table.classes
    last = {d: max(t for t, e in views if e == d) for d in depths}
    total = {d: np.zeros((classes, len(rows))) for d in depths}
    share = np.ascontiguousarray((grown.trees.value / np.maximum(grown.trees.value.sum(axis=1, keepdims=True), 1)).T)
    for k in range(max(last.values())):
        m = grown.first[i] + k
        tree, node, above = grown.trees.tree(m), None, 0
        mine = share[:, grown.trees.at[m]:grown.trees.at[m + 1]]
        for d in depths:
            if k >= last[d]:
                continue
            node, above = walk(tree, bins, rows, d - above, node), d
            for cls in range(classes):
                total[d][cls] += mine[cls].take(node)
        for v, (t, d) in enumerate(views):
            if t == k + 1:
                yield v, total[d].T


VOTE_ROWS = 1 << 15


def evaluate(spark, grown: Grown, views: list[View] | None = None, parts: tuple[str, ...] = ("train", "held")) -> dict[tuple[int, str], np.ndarray]:
    """Confusion counts (true class, predicted class) of every view on the forest's
    training rows ("train") and on its held-out fold ("held"); one job.  The
    class with the largest mean share is predicted, the lowest of equal ones."""
    views = views if views is not None else [View(i) for i in range(len(grown.forests))]
    classes, table = grown.table.classes, grown.table
    wanted: dict[int, list[tuple[int, int, int]]] = {}
    for v, (i, trees, depth) in enumerate(views):
        wanted.setdefault(i, []).append((v, trees or grown.forests[i].trees, min(depth or 99, grown.forests[i].depth)))

    def run(batches):
        cells = np.zeros((len(views), len(parts), classes * classes), np.int64)
        for _, y, fold, pos, n, bins in _chunks(batches, len(table.cols)):
            for i, mine in wanted.items():
                forest = grown.forests[i]
                member = {"train": _used(forest, fold, pos, n),
                          "held": fold == forest.skip_fold if forest.skip_fold is not None else np.zeros(len(fold), bool)}
                asked = np.flatnonzero(np.logical_or.reduce([member[p] for p in parts]))
                for lo in range(0, len(asked), VOTE_ROWS):
                    rows = asked[lo:lo + VOTE_ROWS]
                    for at, votes in _votes(grown, i, [(t, d) for _, t, d in mine], bins, rows):
                        cell = y[rows] * classes + votes.round(9).argmax(axis=1)
                        for k, p in enumerate(parts):
                            cells[mine[at][0], k] += np.bincount(cell[member[p][rows]], minlength=classes * classes)
        v, part, cell = np.nonzero(cells)
        yield pa.RecordBatch.from_pydict({"v": v, "part": part, "cell": cell, "n": cells[v, part, cell]})

    got = table.read(spark).mapInArrow(run, "v long, part long, cell long, n long").groupBy("v", "part", "cell").agg(F.sum("n").alias("n")).collect()
    out = {(v, p): np.zeros((classes, classes), np.int64) for v in range(len(views)) for p in parts}
    for r in got:
        out[r["v"], parts[r["part"]]].ravel()[r["cell"]] = r["n"]
    return out


def metrics(cells: np.ndarray) -> dict[str, float]:
    """accuracy, f1 (weighted by class) and f1_1 (class 1) of confusion counts; 0 where undefined."""
    n, hit = cells.sum(), np.diag(cells).astype(float)
    both = cells.sum(axis=0) + cells.sum(axis=1)
    f1 = np.divide(2 * hit, both, out=np.zeros(len(hit)), where=both > 0)
    return {"accuracy": float(hit.sum() / n) if n else 0.0, "f1": float((f1 * cells.sum(axis=1)).sum() / n) if n else 0.0,
            "f1_1": float(f1[1]) if len(f1) > 1 else 0.0}


def scores(spark, grown: Grown, i: int = 0) -> DataFrame:
    """``key, label, fold, p`` of every row of the binned table: the mean share of class 1 over forest ``i``'s trees."""
    forest, table = grown.forests[i], grown.table

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            _, _, _, _, _, bins = _chunk([b], len(table.cols))
            for _, votes in _votes(grown, i, [(forest.trees, forest.depth)], bins, np.arange(b.num_rows)):
                p = votes[:, 1] / forest.trees if table.classes > 1 else np.zeros(b.num_rows)
                yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(x)) for x in ("_key", "_y", "_fold")], pa.array(p)],
                                                 names=["key", "label", "fold", "p"])

    rows = table.read(spark)
    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, label int, fold int, p double")


# ---------------------------------------------------------------- loops over forests

class Candidate(NamedTuple):
    """A point of a search space."""
    trees: int
    depth: int
    min_split: int = 2
    min_leaf: int = 1
    mtry: int | None = None


def search(spark, table: Binned, features: list[str], candidates: list[Candidate], folds: int, metric: str = "f1",
           seed: int = 42) -> list[list[float]]:
    """T4, T5: held-out metric of every candidate in every fold.  Candidates that
    differ in the number of trees or the depth alone are views of the same forests."""
    grown_for = sorted({c[2:] for c in candidates}, key=str)
    top = {g: (max(c.trees for c in candidates if c[2:] == g), max(c.depth for c in candidates if c[2:] == g)) for g in grown_for}
    forests = [Forest(tuple(features), skip_fold=f, trees=top[g][0], depth=top[g][1], min_split=g[0], min_leaf=g[1], mtry=g[2])
               for g in grown_for for f in range(folds)]
    grown = grow(spark, table, forests, seed)
    views = [View(grown_for.index(c[2:]) * folds + f, c.trees, c.depth) for c in candidates for f in range(folds)]
    cells = evaluate(spark, grown, views, ("held",))
    return [[metrics(cells[i * folds + f, "held"])[metric] for f in range(folds)] for i in range(len(candidates))]


def fold_scores(spark, table: Binned, sets: list[tuple[str, ...]], folds: int, metric: str = "f1_1", seed: int = 42, **how) -> list[list[float]]:
    """Held-out metric per feature set and fold; all forests grow together."""
    grown = grow(spark, table, [Forest(tuple(s), skip_fold=f, **how) for s in sets for f in range(folds)], seed)
    cells = evaluate(spark, grown, parts=("held",))
    return [[metrics(cells[i * folds + f, "held"])[metric] for f in range(folds)] for i in range(len(sets))]


def _weakest(ranked: list[tuple[str, float]], n: int) -> list[str]:
    return [f for f, _ in sorted(ranked, key=lambda t: (t[1], t[0]))[:n]]


def eliminate(spark, table: Binned, starts: list[tuple[str, ...]], sizes: list[int], skips: list[int | None], step: int = 1,
              seed: int = 42, **how) -> list[list[tuple[tuple[str, ...], list[str], np.ndarray | None]]]:
    """Recursive elimination of several feature lists side by side: every round
    grows one forest per list that is still above its size.  Per list the rounds
    as (features, dropped after it, held-out counts)."""
    left = [tuple(s) for s in starts]
    out: list[list] = [[] for _ in starts]
    todo = list(range(len(starts)))
    while todo:
        grown = grow(spark, table, [Forest(left[i], skip_fold=skips[i], **how) for i in todo], seed)
        cells = evaluate(spark, grown, parts=("held",)) if any(skips[i] is not None for i in todo) else {}
        again = []
        for k, i in enumerate(todo):
            drop = _weakest(grown.importances(k), min(step, len(left[i]) - sizes[i])) if len(left[i]) > sizes[i] else []
            out[i].append((left[i], drop, cells.get((k, "held"))))
            left[i] = tuple(f for f in left[i] if f not in drop)
            if drop:
                again.append(i)
        todo = again
    return out


def rfe(spark, table: Binned, cols: list[str], n_select: int, step: int = 1, seed: int = 42, **how) -> list[tuple[str, int]]:
    """Forests on ever fewer features, the weakest dropped each time; ranking 1 = kept."""
    rounds = eliminate(spark, table, [tuple(cols)], [n_select], [None], step, seed, **how)[0] if len(cols) > n_select else []
    dropped = [d for _, d, _ in rounds if d]
    ranking = dict.fromkeys((f for f in cols if not any(f in d for d in dropped)), 1) | {f: r for r, d in enumerate(reversed(dropped), 2) for f in d}
    return sorted(ranking.items(), key=lambda t: (t[1], t[0]))


def rfecv(spark, table: Binned, lists: list[list[str]], folds: int, step: int = 1, min_features: int = 1, metric: str = "f1_1",
          seed: int = 42, **how) -> list[tuple[list[str], list[dict]]]:
    """L8 for several feature lists side by side: elimination inside each fold,
    every size scored on the held-out fold; the size with the best mean (the
    smallest of equal ones) is eliminated down to on all rows.  Per list the
    chosen features and a row per size."""
    starts = [tuple(x) for x in lists for _ in range(folds)] + [tuple(x) for x in lists]
    skips: list[int | None] = [f for _ in lists for f in range(folds)] + [None] * len(lists)
    rounds = eliminate(spark, table, starts, [min_features] * len(starts), skips, step, seed, **how)
    out = []
    for i in range(len(lists)):
        by_size: dict[int, list[float]] = {}
        for mine in rounds[i * folds:(i + 1) * folds]:
            for feats, _, cells in mine:
                by_size.setdefault(len(feats), []).append(metrics(cells)[metric])
        rows = [{"size": n, "f1": float(np.mean(v)), "f1_std": float(np.std(v))} for n, v in sorted(by_size.items())]
        best = max(rows, key=lambda r: (r["f1"], -r["size"]))["size"]
        out.append((sorted(next(f for f, _, _ in rounds[folds * len(lists) + i] if len(f) == best)), rows))
    return out
