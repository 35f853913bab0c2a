"""Structured Streaming operators (ST1-ST4).

The scoring plan is the batch plan: ``score_plan`` is a pure DataFrame ->
DataFrame function applied to a ``readStream`` frame exactly as to a batch
frame.  Windows use event time with a watermark; per-machine alert
suppression keeps the emitted alert times in state keyed by machine group
(``applyInPandasWithState``).  Every query writes a table and its checkpoint
to one folder: a fresh one under the session's shared work folder, or the one
the caller names; a run with the same named folder resumes from its checkpoint.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from vigil.session import work_dir

WATERMARK = "10 minutes"
COOLDOWN_MINUTES = 30


def file_stream(spark: SparkSession, folder: str, pattern: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet files of ``folder`` matching ``pattern`` as a stream (bounded micro-batches)."""
    r = spark.readStream.schema(schema).option("basePath", folder)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(f"{folder}/{pattern}")


def run_available(sdf: DataFrame, name: str, mode: str = "append", keep: str | None = None) -> DataFrame:
    """Runs the stream over everything available (``availableNow``), sink and
    checkpoint in the shared work folder, and returns the sink as a batch frame."""
    spark = sdf.sparkSession
    base = keep or work_dir(spark, name)
    q = (sdf.writeStream.outputMode(mode).format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(sdf.schema).parquet(f"{base}/out")


def run_available_many(named: dict[str, DataFrame], mode: str = "append") -> dict[str, DataFrame]:
    """Starts several availableNow queries together (they share the cluster) and
    waits for all; returns each sink as a batch frame."""
    started = {}
    for name, sdf in named.items():
        base = work_dir(sdf.sparkSession, name)
        q = (sdf.writeStream.outputMode(mode).format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
        started[name] = (q, base, sdf)
    for q, _, _ in started.values():
        q.awaitTermination()
    return {n: sdf.sparkSession.read.schema(sdf.schema).parquet(f"{base}/out") for n, (q, base, sdf) in started.items()}


# ---------------------------------------------------------------- ST1
def stream_score(source: DataFrame, score_plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """ST1: the stateless batch scoring plan applied to the stream."""
    return score_plan(source)


# ---------------------------------------------------------------- ST2
GAP_US = COOLDOWN_MINUTES * 60_000_000
NO_TIME = np.iinfo(np.int64).min  # a missing time in microseconds
_FLAGS = ["no_machine", "no_key"]


def _kept(ts: list[int], emitted: list[int], gap: int) -> list[bool]:
    """Greedy in time order: an alert is kept if no kept alert, earlier or later,
    lies closer than ``gap``; ``emitted``, ascending, grows by the kept ones.  An
    alert without a time is kept if there is no kept one at all."""
    out = []
    untimed = False
    for t in ts:
        if t == NO_TIME:
            out.append(not emitted and not untimed)
            untimed = True
            continue
        i = bisect_left(emitted, t)
        ok = (i == 0 or t - emitted[i - 1] >= gap) and (i == len(emitted) or emitted[i] - t >= gap)
        out.append(ok)
        if ok:
            emitted.insert(i, t)
    return out


def _fold(pdf: pd.DataFrame, emitted: dict[tuple, list[int]]) -> pd.DataFrame:
    """The kept alerts of some machines, each machine's in event-time order;
    ``emitted`` holds the kept times by (no_machine, machine_id) and grows."""
    us = pdf["ts"].to_numpy("datetime64[us]").astype(np.int64)
    machine, none = pdf["machine_id"].to_numpy(), pdf["no_machine"].to_numpy(bool)
    order = np.lexsort((pdf["key"].to_numpy(), pdf["no_key"].to_numpy(bool), us, us == NO_TIME, machine, none))
    us, machine, none = us[order], machine[order], none[order]
    first = np.flatnonzero(np.r_[True, (machine[1:] != machine[:-1]) | (none[1:] != none[:-1])])
    keep = []
    for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(us)]):
        keep += _kept(us[lo:hi].tolist(), emitted.setdefault((bool(none[lo]), int(machine[lo])), []), GAP_US)
    out = pdf.iloc[order[np.array(keep, bool)]]
    longs = {c: pd.array(out[c].to_numpy(np.int64), "Int64") for c in ("machine_id", "key")}
    for (c, x), flag in zip(longs.items(), _FLAGS):
        x[out[flag].to_numpy(bool)] = pd.NA
    return pd.DataFrame({**longs, "ts": out["ts"].array, "value": out["value"].array})


def _suppress(key, pdfs, state):
    """Alerts of one group of machines.  The state holds the emitted times that a
    row not older than the watermark can still be close to, so a late alert is
    judged against its own neighbours; it expires once the watermark is a cooldown
    past the last of them."""
    if state.hasTimedOut:
        state.remove()
        return
    emitted: dict[tuple, list[int]] = {}
    if state.exists:
        for none, machine, us in zip(*state.get):
            emitted.setdefault((none, machine), []).append(us)
    frames = [p for p in pdfs if len(p)]
    if not frames:
        return
    out = _fold(pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0], emitted)
    mark = max(state.getCurrentWatermarkMs(), 0)
    left = [(none, machine, us) for (none, machine), times in emitted.items() for us in times if us + GAP_US > mark * 1000]
    if left:
        state.update(tuple(list(x) for x in zip(*left)))
        state.setTimeoutTimestamp(max((max(us for _, _, us in left) + GAP_US) // 1000, state.getCurrentWatermarkMs() + 1))
    elif state.exists:
        state.remove()
    yield out


def _machine_groups(alerts: DataFrame, groups: int) -> DataFrame:
    """The alerts in ``groups`` groups of whole machines; missing ids as 0 with a flag,
    so that the others stay integers in pandas."""
    known = [F.coalesce(c, F.lit(0).cast("long")).alias(n) for n, c in (("machine_id", F.col("machine_id").cast("long")), ("key", F.col("key").cast("long")))]
    return alerts.select(F.pmod(F.xxhash64("machine_id"), F.lit(groups)).alias("grp"), *known, F.col("machine_id").isNull().alias("no_machine"),
                         F.col("key").isNull().alias("no_key"), "ts", F.col("value").cast("double").alias("value"))


_ALERT = "machine_id long, key long, ts timestamp, value double"


def stream_alerts(alerts: DataFrame, watermark: str = WATERMARK, groups: int = 1024) -> DataFrame:
    """ST2: per machine, suppress alerts within the cooldown of an emitted one.
    Rows older than the watermark are dropped; state expires by event time.  The
    state is keyed by groups of machines, so a batch makes ``groups`` Python calls
    at most however many machines report; ``groups`` must stay with a checkpoint."""
    return _machine_groups(alerts.withWatermark("ts", watermark), groups).groupBy("grp").applyInPandasWithState(
        _suppress, outputStructType=_ALERT, stateStructType="no_machine array<boolean>, machine_id array<long>, emitted array<long>",
        outputMode="append", timeoutConf=GroupStateTimeout.EventTimeTimeout)


def suppress_batch(alerts: DataFrame, groups: int = 1024) -> DataFrame:
    """Batch twin of ST2 (same fold per machine, for checks on bounded inputs)."""
    return _machine_groups(alerts, groups).groupBy("grp").applyInPandas(lambda pdf: _fold(pdf, {}), _ALERT)


# ---------------------------------------------------------------- ST3 / ST4
def risk_windows(readings: DataFrame, kind: str, watermark: str = WATERMARK) -> DataFrame:
    """ST3: per machine counts, alerts and mean risk in tumbling (1 h), sliding
    (1 h every 15 min) or session (30 min gap) windows, event time + watermark."""
    w = {"tumbling": F.window("ts", "1 hour"), "sliding": F.window("ts", "1 hour", "15 minutes"),
         "session": F.session_window("ts", "30 minutes")}[kind]
    g = readings.withWatermark("ts", watermark).groupBy("machine_id", w.alias("w"))
    out = g.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p") >= 0.5).alias("alerts"), F.avg("p").alias("mean_p"))
    return out.select(F.lit(kind).alias("kind"), "machine_id", F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), "n", "alerts", "mean_p")
