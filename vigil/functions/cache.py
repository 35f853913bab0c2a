"""Bounded caching of small intermediate frames.

Operators cache the small aggregates they read several times (per-score
counts, distinct-value counts, chunked inputs).  Results are lazy, so a cache
cannot be released when an operator returns; instead the most recent
``LIMIT`` cached frames are kept per process and older ones are unpersisted
(a later use of an evicted frame simply recomputes it from its lineage).
"""

from __future__ import annotations

from collections import deque

from pyspark import StorageLevel
from pyspark.sql import DataFrame

LIMIT = 24
_KEPT: deque = deque()


ROWS_PER_TASK = 1 << 18


def fewer_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more partitions than its rows need: a Python task over a handful of rows costs as much as one over thousands."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK)))


def keep(df: DataFrame) -> DataFrame:
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(out)
    while len(_KEPT) > LIMIT:
        _KEPT.popleft().unpersist(blocking=False)
    return out


def release_all() -> None:
    while _KEPT:
        _KEPT.popleft().unpersist(blocking=False)
