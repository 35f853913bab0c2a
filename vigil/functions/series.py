"""Skew-safe ordered operations within a series (machine).

A window ``partitionBy(machine)`` puts a whole machine in one task; if one
machine holds a third of the rows, that task sorts a third of the data.  Here
each series is cut into order-preserving chunks (global cut points on the
order columns, computed once), windows run inside (series, chunk), and what
crosses a chunk boundary travels through small per-(series, chunk) tables:

* carry of the last known value (forward fill),
* carry of the last / next known (position, value) (interpolation),
* carry of the last L values (sequence windows),
* per-chunk row counts (positions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vigil.functions.ordering import NUMERIC, bucket_cuts, bucket_of, null_safe_join


def with_chunks(df: DataFrame, order: list[str], n_chunks: int | None = None) -> DataFrame:
    """Adds ``_chunk``, monotone in the order.

    Cuts come from the leading order column (timestamps as epoch micros, one
    ``percentile_approx`` pass that reads that column only).  A leading value
    that fills several cuts (rows that tie on it) is cut again by the second
    order column where that is numeric, so ties do not stay in one chunk."""
    lead = order[0]
    micros = isinstance(df.schema[lead].dataType, (T.TimestampType, T.TimestampNTZType))
    d = df.withColumn("_lead", F.unix_micros(F.col(lead).cast("timestamp")) if micros else F.col(lead))
    n = n_chunks or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n <= 1 or not isinstance(d.schema["_lead"].dataType, NUMERIC):
        return d.withColumn("_chunk", bucket_of(["_lead"], bucket_cuts(d, ["_lead"], n))).drop("_lead")
    every = sorted(x for x in d.agg(F.percentile_approx("_lead", [i / n for i in range(1, n)], 10 * n)).first()[0] or [] if x is not None)
    cuts = sorted(set(every))
    tied = [x for x in cuts if every.count(x) > 2]
    if not tied or len(order) < 2 or not isinstance(d.schema[order[1]].dataType, NUMERIC):
        return d.withColumn("_chunk", bucket_of(["_lead"], cuts)).drop("_lead")
    k = max(every.count(x) for x in tied)
    inner = (d.where(F.col("_lead").isin(tied)).groupBy("_lead")
             .agg(F.percentile_approx(order[1], [i / k for i in range(1, k)], 10 * k).alias("q")).collect())  # one row per tied cut
    second = F.lit(0)
    for r in inner:
        second = F.when(F.col("_lead") == r["_lead"], bucket_of([order[1]], sorted(set(r["q"] or [])))).otherwise(second)
    return d.withColumn("_chunk", bucket_of(["_lead"], cuts) * k + second).drop("_lead")


def _ord(order: list[str]) -> list[Column]:
    return [F.col(c) for c in order]


def ffill(df: DataFrame, cols: list[str], series: str, order: list[str], n_chunks: int | None = None) -> DataFrame:
    """Last non-null value in order within each series (leading nulls stay)."""
    d = with_chunks(df, order, n_chunks)
    w_in = Window.partitionBy(series, "_chunk").orderBy(*_ord(order)).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({f"_loc_{x}": F.last(F.col(x), ignorenulls=True).over(w_in) for x in cols})
    key = F.struct(*_ord(order))
    last = d.groupBy(series, "_chunk").agg(*[F.max_by(F.col(x), F.when(F.col(x).isNotNull(), key)).alias(f"_last_{x}")
                                             for x in cols])
    w_c = Window.partitionBy(series).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(series, "_chunk", *[F.last(f"_last_{x}", ignorenulls=True).over(w_c).alias(f"_carry_{x}")
                                            for x in cols])
    j = null_safe_join(d, carry, [series, "_chunk"])
    j = j.withColumns({x: F.coalesce(F.col(f"_loc_{x}"), F.col(f"_carry_{x}")) for x in cols})
    return j.drop("_chunk", *[f"_loc_{x}" for x in cols], *[f"_carry_{x}" for x in cols])


def positions(df: DataFrame, series: str, order: list[str], n_chunks: int | None = None, out: str = "_pos") -> DataFrame:
    """1-based row position within each series (chunk-local row number + earlier chunks' counts)."""
    d = with_chunks(df, order, n_chunks)
    d = d.withColumn("_r", F.row_number().over(Window.partitionBy(series, "_chunk").orderBy(*_ord(order))))
    cnt = d.groupBy(series, "_chunk").agg(F.count(F.lit(1)).alias("_cc"))
    off = cnt.select(series, "_chunk", F.coalesce(F.sum("_cc").over(
        Window.partitionBy(series).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return null_safe_join(d, off, [series, "_chunk"]).withColumn(out, F.col("_off") + F.col("_r")).drop("_r", "_off")


def interpolate(df: DataFrame, cols: list[str], series: str, order: list[str], n_chunks: int | None = None) -> DataFrame:
    """Linear interpolation by row position within each series; leading nulls
    stay, trailing nulls take the last known value.

    One exchange by (series, chunk): positions and known neighbours are found
    inside the chunk; one small table per (series, chunk) carries the row
    counts and the neighbours of other chunks, at their global positions."""
    d = with_chunks(df, order, n_chunks)
    base = Window.partitionBy(series, "_chunk").orderBy(*_ord(order))
    back, fwd = base.rowsBetween(Window.unboundedPreceding, 0), base.rowsBetween(0, Window.unboundedFollowing)
    d = d.withColumn("_r", F.row_number().over(base).cast("long"))
    known = {x: F.when(F.col(x).isNotNull(), F.struct(F.col("_r").alias("p"), F.col(x).cast("double").alias("v"))) for x in cols}
    per = d.groupBy(series, "_chunk").agg(F.count(F.lit(1)).alias("_cc"), *[
        a for x in cols for a in (F.max(known[x]).alias(f"_cl_{x}"), F.min(known[x]).alias(f"_cf_{x}"))])  # by position (first field)
    w_c = Window.partitionBy(series).orderBy("_chunk")
    w_b, w_f = w_c.rowsBetween(Window.unboundedPreceding, -1), w_c.rowsBetween(1, Window.unboundedFollowing)
    per = per.withColumn("_off", F.coalesce(F.sum("_cc").over(w_b), F.lit(0)))
    moved = lambda k: F.when(F.col(k).isNotNull(), F.struct((F.col(k)["p"] + F.col("_off")).alias("p"), F.col(k)["v"].alias("v")))
    per = per.withColumns({k: moved(k) for x in cols for k in (f"_cl_{x}", f"_cf_{x}")})
    carry = per.select(series, "_chunk", "_off", *[a for x in cols for a in (
        F.last(f"_cl_{x}", ignorenulls=True).over(w_b).alias(f"_pc_{x}"),
        F.first(f"_cf_{x}", ignorenulls=True).over(w_f).alias(f"_nc_{x}"))])
    d = d.withColumns({k: f for x in cols for k, f in ((f"_pl_{x}", F.last(known[x], ignorenulls=True).over(back)),
                                                       (f"_nl_{x}", F.first(known[x], ignorenulls=True).over(fwd)))})
    d = null_safe_join(d, carry, [series, "_chunk"])
    pos = F.col("_r") + F.col("_off")
    fills = {}
    for x in cols:
        pv = F.coalesce(moved(f"_pl_{x}"), F.col(f"_pc_{x}"))
        nx = F.coalesce(moved(f"_nl_{x}"), F.col(f"_nc_{x}"))
        lerp = pv["v"] + (nx["v"] - pv["v"]) * (pos - pv["p"]) / (nx["p"] - pv["p"])
        fills[x] = (F.when(F.col(x).isNotNull(), F.col(x)).when(pv.isNotNull() & nx.isNotNull(), lerp)
                    .when(pv.isNotNull(), pv["v"]))
    d = d.withColumns(fills)
    return d.drop("_chunk", "_r", "_off", *[f"_{k}_{x}" for x in cols for k in ("pl", "nl", "pc", "nc")])


def previous_values(df: DataFrame, series: str, order: list[str], value: str, length: int,
                    n_chunks: int | None = None) -> DataFrame:
    """``seq``: the ``length`` previous values of each row in its series (current row
    excluded, oldest first); rows with fewer predecessors get a shorter list."""
    d = with_chunks(df, order, n_chunks)
    base = Window.partitionBy(series, "_chunk").orderBy(*_ord(order))
    d = d.withColumns({"_loc": F.collect_list(F.col(value)).over(base.rowsBetween(-length, -1)),
                       "_from_end": F.row_number().over(Window.partitionBy(series, "_chunk").orderBy(
                           *[F.col(c).desc() for c in order]))})
    # the last `length` values of every chunk (bounded per chunk), in order
    tail = d.where(F.col("_from_end") <= length).groupBy(series, "_chunk").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.struct(*_ord(order)).alias("o"), F.col(value).alias("v")))),
                    lambda s: s["v"]).alias("_tail"))
    w_b = Window.partitionBy(series).orderBy("_chunk").rowsBetween(-length, -1)
    carry = tail.select(series, "_chunk", F.flatten(F.collect_list("_tail").over(w_b)).alias("_prev"))
    # every chunk of the table has a value, so `length` chunks back are enough; collect_list over
    # an ordered frame keeps chunk order; keep only the last `length` values
    carry = carry.withColumn("_prev", F.when(F.size("_prev") > length,
                                             F.slice("_prev", F.size("_prev") - length + 1, length)).otherwise(F.col("_prev")))
    j = null_safe_join(d, carry, [series, "_chunk"], "left")
    need = F.lit(length) - F.size("_loc")
    prev = F.coalesce(F.col("_prev"), F.array().cast("array<double>"))
    head = F.when(need > 0, F.slice(prev, F.greatest(F.size(prev) - need + 1, F.lit(1)), F.least(need, F.size(prev))))
    seq = F.when(need > 0, F.concat(F.coalesce(head, F.array().cast("array<double>")), F.col("_loc"))).otherwise(F.col("_loc"))
    return j.withColumn("seq", seq).drop("_chunk", "_loc", "_from_end", "_prev")
