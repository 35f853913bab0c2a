"""Sequence windows over ordered readings (W1, W2) and their summary features.

Rows are ordered by (ts, key) within a series (machine); a series is split
into chunks so one hot machine does not become one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def sequences(df: DataFrame, series: str, order: list[str], value: str, length: int = 10,
              label: Column | None = None) -> DataFrame:
    """The ``length`` previous values (current row excluded) of each row
    that has a full window; W2: the row's own label pairs with that window.
    Skew-safe: windows run inside order-preserving chunks of each series and
    the last ``length`` values of earlier chunks are carried over."""
    from vigil.functions.series import previous_values

    out = previous_values(df, series, order, value, length).where(F.size("seq") == length)
    if label is not None:
        out = out.withColumn("label", label)
    return out


def sequence_summary(seq: Column, length: int) -> dict[str, Column]:
    """Per-window mean, population std and least-squares slope over positions 0..L-1."""
    n = float(length)
    mean = F.aggregate(seq, F.lit(0.0), lambda a, v: a + v) / n
    sq = F.aggregate(seq, F.lit(0.0), lambda a, v: a + v * v) / n
    xbar = (n - 1) / 2
    sxx = sum((i - xbar) ** 2 for i in range(length))
    sxy = F.aggregate(F.transform(seq, lambda v, i: (i - xbar) * v), F.lit(0.0), lambda a, v: a + v)
    return {"seq_mean": mean, "seq_std": F.sqrt(F.greatest(sq - mean * mean, F.lit(0.0))), "seq_slope": sxy / sxx}


def flatten(seq: Column, length: int, prefix: str = "lag") -> dict[str, Column]:
    """Window positions as columns lag_L .. lag_1 (oldest first)."""
    return {f"{prefix}_{length - i}": seq[i] for i in range(length)}
