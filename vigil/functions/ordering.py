"""Order-preserving buckets and distributed prefix sums.

A global running sum or rank must not run as one window over all rows (one
task).  Instead the ordering values are cut into ``n`` contiguous buckets by
cut points computed once (a bounded sample, collected as literals, so every
later evaluation assigns the same bucket).  Running sums are then a window
inside each (group, bucket) plus the offset of the earlier buckets of the
group, taken from a small (groups x buckets) table.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from vigil.functions.cache import keep

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _key(cols: list[str]) -> Column:
    return F.col(cols[0]) if len(cols) == 1 else F.struct(*[F.col(c) for c in cols])


def bucket_cuts(df: DataFrame, order_cols: list[str], n_buckets: int | None = None, sample_rows: int = 20_000,
                seed: int = 7) -> list:
    """Sorted, distinct cut values (tuples for several columns).

    One numeric column: ``percentile_approx`` at n-1 evenly spaced ranks (one
    pass).  Otherwise a bounded sample (a count and a sampled collect)."""
    spark = df.sparkSession
    n_buckets = n_buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    if n_buckets <= 1:
        return []
    if len(order_cols) == 1 and isinstance(df.schema[order_cols[0]].dataType, NUMERIC):
        probs = [i / n_buckets for i in range(1, n_buckets)]
        cuts = df.agg(F.percentile_approx(F.col(order_cols[0]), probs, 10 * n_buckets)).first()[0]
        return sorted(set(c for c in (cuts or []) if c is not None))
    n = df.count()
    if n == 0 or n_buckets <= 1:
        return []
    frac = min(1.0, sample_rows / n)
    rows = df.select(*order_cols).na.drop().sample(False, frac, seed).collect()  # about sample_rows
    vals = sorted(tuple(r) if len(order_cols) > 1 else r[0] for r in rows)
    if not vals:
        return []
    step = max(1, len(vals) // n_buckets)
    return sorted(set(vals[step::step]))


def bucket_of(order_cols: list[str], cuts: list, descending: bool = False) -> Column:
    """Bucket index: number of cuts strictly below the row's key (monotone in
    the key); reversed for a descending order."""
    if not cuts:
        return F.lit(0)
    if len(order_cols) == 1:
        arr = F.array(*[F.lit(c) for c in cuts])
    else:
        arr = F.array(*[F.struct(*[F.lit(v).alias(f"c{i}") for i, v in enumerate(c)]) for c in cuts])
        key = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order_cols)])
    k = F.col(order_cols[0]) if len(order_cols) == 1 else key
    if len(cuts) <= 16:
        b = F.size(F.filter(arr, lambda q: q < k))
    else:  # two steps of about sqrt(n) comparisons: the block by its last cut, then inside the block
        step = math.isqrt(len(cuts) - 1) + 1
        lasts = F.array(*[F.element_at(arr, min(i + step, len(cuts))) for i in range(0, len(cuts), step)])
        block = F.size(F.filter(lasts, lambda q: q < k))
        b = block * step + F.size(F.filter(F.slice(arr, block * step + 1, F.lit(step)), lambda q: q < k))
        b = F.when(block < math.ceil(len(cuts) / step), b).otherwise(len(cuts))
    b = F.coalesce(b, F.lit(0))  # a null key is in the first bucket
    return (F.lit(len(cuts)) - b) if descending else b


def null_safe_join(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` in which nulls match, with the left side's columns."""
    r = right.withColumnsRenamed({x: f"_rk_{x}" for x in cols})
    on = functools.reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(f"_rk_{x}")) for x in cols])
    return left.join(r, on, how).drop(*[f"_rk_{x}" for x in cols])


def grouped_prefix(df: DataFrame, by: list[str], order_cols: list[str], cols: list[str], descending: bool = False,
                   suffix: str = "_before", n_buckets: int | None = None) -> DataFrame:
    """Adds ``<col>_before``: per group, the sum of ``cols`` over rows strictly
    earlier in the order (ties in the order are broken by the remaining
    ``order_cols``; give a unique order for exact running sums).

    The input (usually a small aggregate) is cached: it is read by the cut
    pass, the per-bucket totals and the final pass."""
    df = keep(df)
    cuts = bucket_cuts(df, order_cols, n_buckets)
    d = df.withColumn("_b", bucket_of(order_cols, cuts, descending))
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    w_in = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumns({f"_in_{x}": F.coalesce(F.sum(x).over(w_in), F.lit(0)) for x in cols})
    tot = df.withColumn("_b", bucket_of(order_cols, cuts, descending)).groupBy(*by, "_b").agg(
        *[F.sum(x).alias(f"_bt_{x}") for x in cols])
    w_off = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*by, "_b", *[F.coalesce(F.sum(f"_bt_{x}").over(w_off), F.lit(0)).alias(f"_off_{x}") for x in cols])
    # without groups the offsets are one row per bucket, a number fixed by the shuffle partitions
    j = null_safe_join(d, tot if by else F.broadcast(tot), [*by, "_b"])
    return j.withColumns({f"{x}{suffix}": F.col(f"_off_{x}") + F.col(f"_in_{x}") for x in cols}).drop(
        "_b", *[f"_in_{x}" for x in cols], *[f"_off_{x}" for x in cols])


def dense_rank0(df: DataFrame, order_cols: list[str], out: str = "code") -> DataFrame:
    """0-based position (bigint) of each row by ``order_cols`` (rows should be unique in that order)."""
    d = df.withColumn("_one", F.lit(1))
    r = grouped_prefix(d, [], order_cols, ["_one"])
    return r.withColumn(out, F.col("_one_before").cast("long")).drop("_one", "_one_before")


def exact_quantiles_distributed(df: DataFrame, col: str, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (the pandas / DuckDB rule) without
    holding all distinct values in one task.

    Distinct values are counted (partial aggregation), their running counts
    come from the bucketed prefix sums, and only the (at most two) distinct
    values covering ranks floor(q (n-1)) and ceil(q (n-1)) are kept.  Result:
    ``by..., prob, value`` (one row per group and probability)."""
    by = by or []
    d = keep(df.where(F.col(col).isNotNull()).groupBy(*by, F.col(col).cast("double").alias("_v")).agg(
        F.count(F.lit(1)).alias("_cnt")))
    pre = grouped_prefix(d, by, ["_v"], ["_cnt"])
    tot = d.groupBy(*by).agg(F.sum("_cnt").alias("_n"))
    j = null_safe_join(pre, tot, by) if by else pre.withColumn("_n", F.lit(tot.first()["_n"]))
    targets = F.array(*[F.struct(F.lit(float(q)).alias("prob"), (F.lit(float(q)) * (F.col("_n") - 1)).alias("pos"))
                        for q in probs])
    t = j.select(*by, "_v", "_cnt", "_cnt_before", F.explode(targets).alias("_t"))
    lo, hi = F.floor(F.col("_t.pos")), F.ceil(F.col("_t.pos"))
    covers = lambda r: (F.col("_cnt_before") <= r) & (r < F.col("_cnt_before") + F.col("_cnt"))
    t = t.where(covers(lo) | covers(hi))
    g = t.groupBy(*by, F.col("_t.prob").alias("prob")).agg(
        F.max(F.when(covers(lo), F.col("_v"))).alias("_lo"), F.max(F.when(covers(hi), F.col("_v"))).alias("_hi"),
        F.first(F.col("_t.pos") - lo).alias("_frac"))
    return g.select(*by, "prob", (F.col("_lo") + F.col("_frac") * (F.col("_hi") - F.col("_lo"))).alias("value"))


EXACT_SINGLE_PASS_DISTINCT = 200_000


def fit_quantiles(df: DataFrame, cols: list[str], probs: list[float], method: str = "exact") -> dict[str, list]:
    """Quantile parameters per column.

    exact: columns whose approximate distinct count is at most
    ``EXACT_SINGLE_PASS_DISTINCT`` use one ``percentile`` aggregate (its merge
    buffer holds one counter per distinct value, so it is bounded); larger
    columns use ``exact_quantiles_distributed``.  approx: ``percentile_approx``.
    """
    if not cols:
        return {}
    if method == "approx":
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, 10000).alias(c) for c in cols]).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in cols}
    if method not in ("exact", "distributed"):
        raise ValueError(f"unknown quantile method {method!r}")
    if method == "distributed":
        small, big = [], list(cols)
    else:
        nd = df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in cols]).first()
        small = [c for c in cols if (nd[c] or 0) <= EXACT_SINGLE_PASS_DISTINCT]
        big = [c for c in cols if c not in small]
    out = {}
    if small:
        row = df.agg(*[F.percentile(F.col(c).cast("double"), probs).alias(c) for c in small]).first()
        out.update({c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in small})
    for c in big:
        vals = {r["prob"]: r["value"] for r in exact_quantiles_distributed(df, c, probs).collect()}
        out[c] = [vals.get(float(q)) for q in probs]
    return out
