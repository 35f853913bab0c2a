"""Size-aware heavy-light Jaccard join on sets of word shingles.

Texts with equal sets are one class (folded by 128-bit sums of shingle hashes).
Light classes (few shingles) enumerate fixed-size subsets: two sets of sizes s
and t link exactly if they share a subset of ``ceil(j (s + t) / (1 + j))``
shingles, so equal subsets are links without a look at the sets.  Heavy classes
are found by scanning inverted lists of their rarest shingles and verified on
the whole sets.  The boundary between the two minimises the rows both sides
write, estimated from the short texts' word counts.

Shingle frequencies over all classes come from packed requests; a shingle that
one class alone has joins no list and no subset, so a class without near
copies writes nothing.  In a list every class is first checked against one
pivot, in a few rounds with another pivot each; only classes that remain in
different components after that are paired.

Defined results: null texts and texts without words have an empty set, link
with nothing and are their own component.  Rows with equal sets belong to one
component whatever their keys; the component's name is its smallest key (nulls
aside).  Repeated rows keep one output row each; an empty table gives none.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import exchange as X
from vigil.llm import kernel as K
from vigil.llm.tokenfile import pieces as doc_ranges
from vigil.session import work_dir

F1, F2, SIZE = "_vg_f1", "_vg_f2", "_vg_size"
VERIFY_COST = 8  # rows of work that a list entry's check counts for
LONGEST_LIGHT = 24
STEP_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20
GROUP_BYTES, GROUP_PAIRS = 8 << 20, 1 << 18  # of sets that come to a part, and of pairs, checked at once
PIVOT_ROUNDS = 2
CENTRAL_UNIT, CENTRAL_JITTER = 1000, 400  # of a level; how far later rounds stray from the most central pivots


def _least(size, j):
    """Smallest overlap a set of ``size`` can have with a linked one."""
    return -(-size * j[0] // j[1])


def _overlap(s, t, j):
    return -(-j[0] * (s + t) // (j[0] + j[1]))


def subset_sizes(s: int, top: int, j) -> list[int]:
    """Subset sizes under which a set of ``s`` meets linked sets of up to ``top``."""
    return sorted({_overlap(s, t, j) for t in range(_least(s, j), min(top, s * j[1] // j[0]) + 1)})


def boundary(histogram: dict[int, int], j) -> int:
    """Largest light size: the cheapest cut for the given numbers of sets per size."""
    heavy = lambda s: (s - _least(s, j) + 1) * VERIFY_COST
    best = None
    for cut in range(LONGEST_LIGHT + 1):
        cost = sum(n * sum(comb(s, c) for c in subset_sizes(s, cut, j)) for s, n in histogram.items() if 0 < s <= cut)
        cost += sum(n * heavy(s) for s, n in histogram.items() if s >= _least(cut + 1, j))
        if best is None or cost < best[0]:
            best = (cost, cut)
    return best[1]


def signature(own: np.ndarray) -> np.ndarray:
    """Parity bits of a set: each element flips one of ``64 * len(SIGNS)`` bits, so
    two sets differ in at most as many bits as there are elements in only one of them."""
    bits = np.bincount((K.mix(own) >> np.uint64(56)).astype(np.int64), minlength=256)[:64 * len(SIGNS)] & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def centrality(levels: np.ndarray) -> int:
    """Mean frequency level of a set's shingles, in units of 1 / CENTRAL_UNIT.  In a family of
    copies that differ from a common text, the copy with the fewest changes has the highest."""
    return int(levels.sum(dtype=np.int64)) * CENTRAL_UNIT // len(levels)


def _signed(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


class _Sets:
    """Ascending distinct shingle hashes of each text, with set fingerprints; a megabyte of text at a time."""

    def __init__(self, column, words: int):
        buf, off = K.text_bytes(column)
        self.sets = []
        for lo, hi in doc_ranges(None, off, STEP_BYTES):
            low = K.LOWER[buf[off[lo]:off[hi]]]
            s, e, per = K.words(low, off[lo:hi + 1] - off[lo])
            sh, runs = K.shingles(K.span_hashes(low, s, e), per, words)
            at = np.concatenate(([0], np.cumsum(runs)))
            self.sets += [np.unique(sh[i:k]) for i, k in zip(at[:-1], at[1:])]
        self.size = np.array([len(x) for x in self.sets], np.int64)
        with np.errstate(over="ignore"):
            prints = [(K.mix(x).sum(), K.mix(x ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()) for x in self.sets]
        self.f1, self.f2 = (_signed(np.array([p[k] for p in prints], np.uint64)) for k in (0, 1))

    def leaders(self, side: pa.Table) -> list[int]:
        """First row of each class that this part leads."""
        rows = side.filter(pa.array(side["kind"].to_numpy() == 0))
        mine = set(zip(rows["a"].to_pylist(), rows["b"].to_pylist()))
        out = []
        for i, key in enumerate(zip(self.f1.tolist(), self.f2.tolist())):
            if key in mine:
                mine.discard(key)
                out.append(i)
        return out


def _frequencies(requests: DataFrame) -> DataFrame:
    """Replies a byte per key: 0 for one class only, else 1 + floor(log2(classes)).
    Keys come in 40 bits; a clash only makes a shingle look more frequent."""

    def answer(t: pa.Table) -> pa.Table:
        keys = [X.widen(x) for x in t["keys"].to_pylist()]
        every, _, inv = K.distinct(np.concatenate(keys))
        n = np.bincount(inv, np.concatenate([np.frombuffer(x, np.uint8) for x in t["more"].to_pylist()]), len(every))
        level = np.where(n > 1, np.frexp(n)[1], 0).astype(np.uint8)[inv]
        at = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
        return X.replies(1, t[X.PART], t["bucket"], [level[i:k].tobytes() for i, k in zip(at[:-1], at[1:])])

    return requests.groupBy("bucket").applyInArrow(answer, X.SIDE)


#: longs of a set's parity signature
SIGNS = [f"sign{k}" for k in range(4)]
ROWS = f"kind int, {X.PART} long, token long, cls long, size long, pos int, central int, data binary, " + ", ".join(f"{x} long" for x in SIGNS)
_ROWS = pa.schema([("kind", pa.int32()), (X.PART, pa.int64()), ("token", pa.int64()), ("cls", pa.int64()), ("size", pa.int64()),
                   ("pos", pa.int32()), ("central", pa.int32()), ("data", pa.binary()), *[(x, pa.int64()) for x in SIGNS]])
_LIST, _SUBSET, _SET = 1, 2, 3


def _candidates(dealt: DataFrame, total: int, classes: DataFrame, text_col: str, words: int, j, cut: int) -> DataFrame:
    """Rows for lists, subsets and sets of the classes."""
    lead = classes.select(F.col("lead").alias(X.PART), F.lit(0).alias("kind"), F.lit(0).alias("bucket"), F.col(F1).alias("a"),
                          F.col(F2).alias("b"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("binary").alias("blob"))
    bits = X.bits_for(total, BUCKET_BYTES)
    near = _least(cut + 1, j)

    def ask(key, left: pa.Table, right: pa.Table) -> pa.Table:
        x = _Sets(left[text_col], words)
        rows = [x.sets[i] for i in x.leaders(right)]
        keys, n = K.sorted_unique(np.concatenate(rows) if rows else np.zeros(0, np.uint64))
        at = X.cuts(keys, bits)
        full = np.flatnonzero(np.diff(at))
        n = np.minimum(n, 255).astype(np.uint8)
        return pa.table({X.PART: [key[0].as_py()] * len(full), "bucket": full, "size": np.diff(at)[full],
                         "keys": [X.narrow(keys[at[b]:at[b + 1]], bits) for b in full],
                         "more": [n[at[b]:at[b + 1]].tobytes() for b in full]}).cast(X.REQUEST_ARROW)

    def emit(key, left: pa.Table, right: pa.Table) -> pa.Table:
        part = key[0].as_py()
        x = _Sets(left[text_col], words)
        leaders = x.leaders(right)
        keys, _ = K.sorted_unique(np.concatenate([x.sets[i] for i in leaders]) if leaders else np.zeros(0, np.uint64))
        at = X.cuts(keys, bits)
        level = np.zeros(len(keys), np.uint8)
        for kind, b, blob in zip(right["kind"].to_pylist(), right["bucket"].to_pylist(), right["blob"].to_pylist()):
            if kind == 1:
                level[at[b]:at[b + 1]] = np.frombuffer(blob, np.uint8)
        out = {k: [] for k in _ROWS.names}

        def add(kind, token, cls, size, pos, central=None, data=None, sign=(None,) * len(SIGNS)):
            for k, v in zip(_ROWS.names, (kind, part, token, cls, size, pos, central, data, *sign)):
                out[k].append(v)

        for i in leaders:
            own, size, cls = x.sets[i], int(x.size[i]), int(x.f1[i])
            lv = level[np.searchsorted(keys, own)]
            shared = own[lv > 0]
            if size <= cut:
                mixed = K.mix(shared)
                for c in subset_sizes(size, cut, j):
                    if c <= len(shared):
                        picks = np.array(list(combinations(range(len(shared)), c)))
                        with np.errstate(over="ignore"):
                            subset = K.mix(mixed[picks].sum(axis=1) + np.uint64(c))
                        for token in _signed(subset).tolist():
                            add(_SUBSET, token, cls, size, c)
            if size >= near:
                prefix = size - _least(size, j) + 1
                order = np.lexsort((own, lv))[:prefix]
                use = np.flatnonzero(lv[order] > 0)
                for token, pos in zip(_signed(own[order[use]]).tolist(), use.tolist()):
                    add(_LIST, token, cls, size, pos)
                if len(use):
                    add(_SET, None, cls, size, None, centrality(lv), own.tobytes(), signature(own).tolist())
        return pa.table(out, schema=_ROWS)

    pair = lambda side: dealt.groupBy(X.PART).cogroup(side.groupBy(X.PART))
    levels = _frequencies(pair(lead).applyInArrow(ask, X.REQUEST))
    return pair(lead.unionByName(levels)).applyInArrow(emit, ROWS)


def _groups(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs and the sets they need, by the part of y and a salt of x.  A part
    that many xs ask for falls into as many groups as their bytes and pairs need;
    a set goes once to each group that needs it."""
    where = sets.select(F.col("cls").alias("y"), X.PART)
    sizes = sets.select(F.col("cls").alias("x"), "size")
    placed = _saved(pairs.select("x", "y").join(where, "y").join(sizes, "x"), "placed")
    need = placed.groupBy(X.PART, "x").agg(F.max("size").alias("s"), F.count(F.lit(1)).alias("n"))
    salts = need.groupBy(X.PART).agg(F.greatest(F.ceil(F.sum("s") * 8 / GROUP_BYTES), F.ceil(F.sum("n") / GROUP_PAIRS)).alias("k")).filter("k > 1")
    salt = F.pmod(F.xxhash64("x"), F.coalesce("k", F.lit(1))).alias("salt")
    dealt = placed.join(F.broadcast(salts), X.PART, "left").select(X.PART, salt, "x", "y")  # a row per part at most
    asked = dealt.select(X.PART, "salt", "x").unionByName(dealt.select(X.PART, "salt", F.col("y").alias("x"))).distinct()
    moved = asked.join(sets.select(F.col("cls").alias("x"), "data"), "x")
    return dealt.withColumn("data", F.lit(None).cast("binary")).unionByName(moved.withColumn("y", F.lit(0).cast("long")))


def _verified(pairs: DataFrame, sets: DataFrame, j) -> DataFrame:
    """The pairs (x, y) that link, checked group by group."""

    def check(t: pa.Table) -> pa.Table:
        held, todo = t.filter(t["data"].is_valid()), t.filter(t["data"].is_null())
        own = dict(zip(held["x"].to_pylist(), held["data"].to_pylist()))
        keep = []
        last, b = None, None
        for x, y in sorted(zip(todo["x"].to_pylist(), todo["y"].to_pylist()), key=lambda p: p[1]):
            if y != last:
                last, b = y, np.frombuffer(own[y], np.uint64)
            a = np.frombuffer(own[x], np.uint64)
            both = int(K.member(b, a).sum())
            if j[1] * both >= j[0] * (len(a) + len(b) - both):
                keep.append((x, y))
        return pa.table({"x": [p[0] for p in keep], "y": [p[1] for p in keep]}, schema=pa.schema([("x", pa.int64()), ("y", pa.int64())]))

    return _groups(pairs, sets).groupBy(X.PART, "salt").applyInArrow(check, "x long, y long")


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of the connected components, by alternating large and small
    stars; each round is written to the shared folder."""
    edges = edges.filter("x != y").select(F.greatest("x", "y").alias("v"), F.least("x", "y").alias("u")).distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.join(least, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.filter("u != v").distinct()  # now v > u
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")),
                                                             F.struct("v", F.col("m").alias("u")))).alias("e")).select("e.*")
        edges = _saved(small.filter("u != v").distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select("v", F.col("u").alias("root"))
        before = now


def _apart(member: DataFrame) -> DataFrame:
    """The entries of lists whose classes lie in more than one component."""
    mixed = member.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("token")
    return member.join(mixed, "token")


def _hook(comp: DataFrame, link: DataFrame) -> DataFrame:
    """Components after the links: each takes the least name at most two links away,
    so that all that link with one pivot take one name."""
    label = lambda v, c: comp.select(F.col("cls").alias(v), F.col("c").alias(c))
    ends = link.join(label("x", "cx"), "x").join(label("y", "cy"), "y").filter("cx != cy")
    both = ends.select(F.explode(F.array(F.struct(F.col("cx").alias("c"), F.col("cy").alias("to")),
                                         F.struct(F.col("cy").alias("c"), F.col("cx").alias("to")))).alias("e")).select("e.*").distinct()
    near = both.groupBy(F.col("c").alias("to")).agg(F.least(F.min("to"), F.col("c")).alias("least"))
    step = both.join(near, "to").groupBy("c").agg(F.min("least").alias("to"))
    return comp.join(step, "c", "left").select("cls", F.coalesce("to", "c").alias("c"), "central")


def links(docs: DataFrame, text_col: str, words: int, jaccard: tuple[int, int], part_bytes: int, keys: list[str] | None = None):
    """(rows with part, class and size; links between classes)."""
    dealt, total = X.deal(docs, text_col, part_bytes, keys)
    keep = [f for f in dealt.schema.fields if f.name not in (text_col, F1, F2, SIZE)]

    def describe(batches):
        for b in batches:
            _, off = K.text_bytes(b.column(text_col))
            for lo, hi in doc_ranges(None, off, STEP_BYTES):
                part = b.slice(lo, hi - lo)
                x = _Sets(part.column(text_col), words)
                cols = [part.column(f.name) for f in keep] + [pa.array(x.f1), pa.array(x.f2), pa.array(x.size)]
                yield pa.RecordBatch.from_arrays(cols, [f.name for f in keep] + [F1, F2, SIZE])

    long = lambda n: T.StructField(n, T.LongType())
    rows = _saved(dealt.select(*[f"`{f.name}`" for f in keep], f"`{text_col}`")
                  .mapInArrow(describe, T.StructType([*keep, long(F1), long(F2), long(SIZE)])), "sets")
    classes = rows.filter(F.col(SIZE) > 0).groupBy(F1, F2).agg(F.min(X.PART).alias("lead"))
    counts = (rows.filter((F.col(SIZE) > 0) & (F.col(SIZE) <= LONGEST_LIGHT * 2)).select(F1, F2, SIZE).distinct().groupBy(SIZE).count())
    cut = boundary({r[SIZE]: r["count"] for r in counts.collect()}, jaccard)  # one row per size, 48 at most
    found = _saved(_candidates(dealt.select(X.PART, f"`{text_col}`"), total, classes, text_col, words, jaccard, cut), "lists")
    j0, j1 = jaccard

    # light: in a group of one subset the smallest set links with all that the subset suffices for, or none does
    subset = found.filter(F.col("kind") == _SUBSET).select("token", "pos", "cls", "size")
    first = subset.groupBy("token", "pos").agg(F.min(F.struct("size", "cls")).alias("m"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    light = (subset.join(first, ["token", "pos"]).filter((F.col("cls") != F.col("m.cls")) & (j0 * (F.col("size") + F.col("m.size")) <= (j0 + j1) * F.col("pos")))
             .select(F.col("cls").alias("x"), F.col("m.cls").alias("y")).distinct())

    # heavy: rounds of one pivot a list; each class is checked against the pivot it meets most often
    # among those of other components.  The first pivots are the most central sets, which link with most
    # of their family, and later ones are drawn from the next in that order.
    entry = found.filter(F.col("kind") == _LIST).select("token", "cls", "size", "pos")
    sets = found.filter(F.col("kind") == _SET).select(X.PART, "cls", "size", "data")
    need = lambda s, t: F.ceil(F.lit(j0) * (s + t) / F.lit(j0 + j1))

    def possible(s, t, p, q):
        return ((F.greatest(s, t) > cut) & (s * j1 >= t * j0) & (t * j1 >= s * j0)
                & (F.least(s - p, t - q) >= need(s, t)))  # the shared shingle and all after it suffice

    comp = found.filter(F.col("kind") == _SET).select("cls", F.col("cls").alias("c"), "central")
    tried = star = None
    for turn in range(PIVOT_ROUNDS):
        member = _apart(entry.join(comp, "cls"))
        order = F.pmod(F.xxhash64("cls", F.lit(turn)), F.lit(turn * CENTRAL_JITTER + 1)) - F.col("central")
        pivot = member.groupBy("token").agg(F.min(F.struct(order.alias("o"), "cls", "size", "pos", "c")).alias("m"))
        met = (member.join(pivot, "token").filter(F.col("c") != F.col("m.c"))
               .filter(possible(F.col("size"), F.col("m.size"), F.col("pos"), F.col("m.pos")))
               .groupBy(F.col("cls").alias("x"), F.col("m.cls").alias("y")).agg(F.count(F.lit(1)).alias("n")))
        top = _saved(met.groupBy("x").agg(F.max(F.struct("n", "y")).alias("b")).select("x", F.col("b.y").alias("y")), "tried")
        link = _saved(_verified(top, sets, jaccard), "star")
        tried, star = (top, link) if tried is None else (tried.unionByName(top), star.unionByName(link))
        comp = _saved(_hook(comp, link), "hooked")

    # the rest: pairs of a list that are still apart (components that hooking has not met yet only add pairs)
    # and whose signatures differ in no more bits than linked sets have elements apart
    signs = found.filter(F.col("kind") == _SET).select("cls", *SIGNS)
    member = _apart(entry.join(comp.drop("central"), "cls")).join(signs, "cls")
    a = member.select("token", F.col("cls").alias("x"), F.col("size").alias("s"), F.col("pos").alias("p"), F.col("c").alias("cx"),
                      *[F.col(g).alias(f"a{g}") for g in SIGNS])
    b = member.select("token", F.col("cls").alias("y"), F.col("size").alias("t"), F.col("pos").alias("q"), F.col("c").alias("cy"),
                      *[F.col(g).alias(f"b{g}") for g in SIGNS])
    differ = sum((F.bit_count(F.col(f"a{g}").bitwiseXOR(F.col(f"b{g}"))) for g in SIGNS[1:]),
                 F.bit_count(F.col(f"a{SIGNS[0]}").bitwiseXOR(F.col(f"b{SIGNS[0]}"))))
    apart = (a.join(b, "token").filter((F.col("cx") != F.col("cy")) & (F.col("x") < F.col("y")))
             .filter(possible(F.col("s"), F.col("t"), F.col("p"), F.col("q")))
             .filter(differ <= F.col("s") + F.col("t") - 2 * need(F.col("s"), F.col("t"))).select("x", "y").distinct())
    done = tried.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    rest = _verified(_saved(apart.join(done, ["x", "y"], "left_anti"), "apart"), sets, jaccard)
    return rows, light.unionByName(star).unionByName(rest)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, jaccard: tuple[int, int] = (85, 100),
         part_bytes: int = X.PART_BYTES) -> DataFrame:
    """``docs`` without the text, with n_shingles and component_id."""
    out = _components(docs, id_col, text_col, words, jaccard, part_bytes)
    keep = [c for c in docs.columns if c not in (text_col, "n_shingles", "component_id")]
    return out.select(*[f"`{c}`" for c in keep], F.col(SIZE).alias("n_shingles"), F.col("_vg_comp").alias("component_id"))


def _components(docs, id_col, text_col, words, jaccard, part_bytes, keys=None) -> DataFrame:
    rows, edges = links(docs, text_col, words, jaccard, part_bytes, keys)
    root = components(edges)
    named = rows.filter(F.col(SIZE) > 0).groupBy(F1, F2).agg(F.min(id_col).alias("least"))
    named = named.join(root, F.col(F1) == F.col("v"), "left").withColumn("root", F.coalesce("root", F1))
    comp = named.groupBy("root").agg(F.min("least").alias("_vg_comp"))
    named = named.join(comp, "root").select(F.col(F1).alias("_vg_g1"), F.col(F2).alias("_vg_g2"), F.col("root").alias("_vg_root"), "_vg_comp")
    out = rows.join(named, (F.col(F1) == F.col("_vg_g1")) & (F.col(F2) == F.col("_vg_g2")) & (F.col(SIZE) > 0), "left")
    return out.withColumn("_vg_comp", F.when(F.col(SIZE) > 0, F.col("_vg_comp")).otherwise(F.col(f"`{id_col}`")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, jaccard: tuple[int, int] = (85, 100),
             part_bytes: int = X.PART_BYTES) -> DataFrame:
    """``docs`` with one row per component: the one with the smallest key, ties
    by part and set.  Texts without words all stay."""
    narrow = docs.select(f"`{id_col}`", f"`{text_col}`")
    out = _components(narrow, id_col, text_col, words, jaccard, part_bytes, [id_col])  # parts as below
    one = (out.filter(F.col(SIZE) > 0).groupBy("_vg_root")
           .agg(F.min(F.struct(F.col(f"`{id_col}`").isNull().alias("z"), F.col(f"`{id_col}`").alias("id"), X.PART, F1, F2)).alias("m"))
           .select("m.*"))
    right = one.select(F.col(X.PART).alias("_vg_to"), "id", F1, F2)
    whole, _ = X.deal(docs, text_col, part_bytes, [id_col])
    names = docs.columns

    def pick(key, left: pa.Table, right: pa.Table) -> pa.Table:
        x = _Sets(left[text_col], words)
        want = set(zip(right["id"].to_pylist(), right[F1].to_pylist(), right[F2].to_pylist()))
        keep = []
        for i, k in enumerate(zip(left[id_col].to_pylist(), x.f1.tolist(), x.f2.tolist())):
            if x.size[i] == 0 or k in want:
                want.discard(k)
                keep.append(i)
        return left.select(names).take(pa.array(keep, pa.int64()))

    return whole.groupBy(X.PART).cogroup(right.groupBy("_vg_to")).applyInArrow(pick, docs.schema)
