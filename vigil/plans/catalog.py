"""Registry of named queries (``queries()``) and their DuckDB oracle SQL.

Query modules register callables ``fn(spark, sf_dir) -> DataFrame`` with
``@query(key, sql=...)``.  Keys without SQL are iterative or seeded jobs
(model fits, resampling, streams) checked by row count only.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_MODULES = ["q_scoring", "q_features", "q_profile", "q_prep", "q_stats", "q_eval", "q_models", "q_series", "q_io"]


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(f"vigil.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"vigil.plans.{m}":
                raise


def r6(expr: str) -> str:
    """SQL: round a float result to 6 places (the Spark side uses F.round(x, 6))."""
    return f"round({expr}, 6)"


def round_doubles(df: DataFrame, nd: int = 6) -> DataFrame:
    """Rounds every double / float column to the comparable output form
    (``canonical``): 9 decimals, then ``nd`` decimals half away from zero.

    Two projections: the first scales the pre-rounded value once per column,
    the second rounds that plain column, so a column's (possibly long)
    defining expression is not repeated by the rounding."""
    from pyspark.sql import functions as F

    from vigil.functions.numeric import round_rint

    dbl = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    if not dbl:
        return df
    m = float(10 ** nd)
    c = lambda n: F.col(f"`{n}`")
    scaled = df.select(*[(round_rint(c(n).cast("double"), 9) * m).alias(n) if n in dbl else c(n) for n in df.columns])
    out = []
    for n in df.columns:
        if n in dbl:
            y, r = c(n), F.rint(c(n))
            out.append((F.when(F.abs(y - r) == 0.5, y + F.signum(y) * 0.5).otherwise(r) / m + F.lit(0.0)).alias(n))
        else:
            out.append(c(n))
    return scaled.select(*out)


def rnd(col, nd: int = 6):
    """Output rounding comparable with the oracle's ``round(x, nd)``."""
    from pyspark.sql import functions as F

    from vigil.functions.numeric import canonical, round_rint

    x = F.col(col) if isinstance(col, str) else col
    return canonical(x, nd) if nd == 6 else round_rint(x, nd)


def rsig_sql(expr: str, digits: int = 10) -> str:
    """SQL twin of ``round_sig``."""
    return (f"CASE WHEN ({expr}) = 0 OR ({expr}) IS NULL OR isnan({expr}) OR isinf({expr}) THEN ({expr}) "
            f"ELSE round({expr}, CAST({digits - 1} - floor(log10(abs({expr}))) AS INTEGER)) END")


def _close_paren(s: str, i: int) -> int:
    depth, q = 0, None
    while i < len(s):
        ch = s[i]
        if q:
            if ch == q:
                q = None
        elif ch in "'\"":
            q = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0:
                return i
        i += 1
    raise ValueError("unbalanced parentheses")


def _split_last_arg(body: str):
    depth, q, cut = 0, None, -1
    for i, ch in enumerate(body):
        if q:
            if ch == q:
                q = None
        elif ch in "'\"":
            q = ch
        elif ch == "(" or ch == "[":
            depth += 1
        elif ch == ")" or ch == "]":
            depth -= 1
        elif ch == "," and depth == 0:
            cut = i
    return (body[:cut], body[cut + 1:].strip()) if cut >= 0 else (body, None)


def canonical_sql(sql: str, sig: int = 10) -> str:
    """Rewrites every ``round(e, 6)`` into the SQL twin of ``canonical``:
    9 decimals, then 6 decimals, -0.0 folded to 0.0."""
    out, i = [], 0
    low = sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            break
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        k = _close_paren(sql, j + 5)
        inner = sql[j + 6:k]
        expr, nd = _split_last_arg(inner)
        if nd != "6":
            out.append(sql[i:j] + "round(" + canonical_sql(inner, sig) + ")")
            i = k + 1
            continue
        e = canonical_sql(expr, sig)
        out.append(sql[i:j])
        out.append(f"(round(round(CAST(({e}) AS DOUBLE), 9), 6) + 0.0)")
        i = k + 1
    return "".join(out)
