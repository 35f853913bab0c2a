"""Quality scores from a sparse ensemble of rules.

1. Statistics of each whole text (DataFrame functions): shares of words, letters,
   lines and signs, no vocabulary and no language.
2. A forest of shallow trees on the labelled rows' statistics.  Every path from a
   root to a node is a conjunction of bounds on statistics: a rule.
3. A logistic regression with an L1 penalty over the rules' 0/1 values keeps a few
   and weighs them.
4. The kept rules become one column expression over the statistics.

Forest and regression are Spark ML fits over all labelled rows.

Defined results: a null text counts as empty; an empty text has statistics of
zero and gets a score like any other.  Rows with the same id share its labels;
an id with both labels trains with both, as often as each was given; labels that
are null or neither 0 nor 1, and labels or rows without an id, train nothing.
Without labels every score is 0.5; with one class only, every score is its
smoothed share.  Repeated rows keep one output row each.  Columns of the input
other than the text and those asked for are not read; statistics are named
``_vg_s_*``.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import reduce
from math import log
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.session import work_dir

SIGNS = "#*$%&|<>"
PREFIX = "_vg_s_"
STATS = ["words", "mean_word", "short_words", "long_words", "capital_words", "sign_words", "signs", "bars", "bangs", "digits",
         "commas", "stops", "distinct_words", "stutter", "lines", "equal_lines", "words_a_line", "ended_lines"]


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the statistics (doubles, never null).

    words: log(1 + words); mean_word: code points a word; short_words, long_words:
    share of words of at most 2, over 20 code points; capital_words: share of words
    without a small but with a capital letter; sign_words: share of words ending in
    a sign; signs, bars, bangs, digits, commas, stops: such characters a word;
    distinct_words: distinct words over words; stutter: share of words equal to
    the one before; lines: log(1 + lines with a word); equal_lines: share of
    lines equal to an earlier one; words_a_line; ended_lines: share of lines
    whose last character is one of ``.!?:;``."""
    flat = reduce(lambda t, ch: F.replace(t, F.lit(ch), F.lit(" ")), "\t\n\x0b\x0c\r", F.col("_vg_t"))
    one = lambda ch: F.octet_length("_vg_t") - F.octet_length(F.replace("_vg_t", F.lit(ch), F.lit("")))
    lost = lambda chars: reduce(lambda a, b: a + b, map(one, chars))
    base = docs.withColumn("_vg_t", F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).withColumns({
        "_vg_w": F.filter(F.split(flat, " "), lambda x: x != ""),
        "_vg_l": F.filter(F.split("_vg_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "_vg_c_signs": lost(SIGNS), "_vg_c_bars": lost("|"), "_vg_c_bangs": lost("!"), "_vg_c_digits": lost("0123456789"),
        "_vg_c_commas": lost(","), "_vg_c_stops": lost("."),
    }).drop("_vg_t")
    size = F.transform("_vg_w", lambda x: F.length(x))
    many = lambda name, test: F.size(F.filter(name, test))
    base = base.withColumns({
        "_vg_n": F.size("_vg_w"), "_vg_m": F.size("_vg_l"), "_vg_z": size,
        "_vg_c_capital_words": many("_vg_w", lambda x: (x == F.upper(x)) & (x != F.lower(x))),
        "_vg_c_sign_words": many("_vg_w", lambda x: F.right(x, F.lit(1)).isin(*SIGNS)),
        "_vg_c_distinct_words": F.size(F.array_distinct("_vg_w")),
        "_vg_c_stutter": many(F.zip_with("_vg_w", F.slice("_vg_w", F.lit(2), F.size("_vg_w")), lambda a, b: F.coalesce(a == b, F.lit(False))),
                              lambda x: x),
        "_vg_c_equal_lines": F.size("_vg_l") - F.size(F.array_distinct("_vg_l")),
        "_vg_c_ended_lines": many("_vg_l", lambda x: F.right(x, F.lit(1)).isin(*".!?:;")),
    }).drop("_vg_w", "_vg_l")
    base = base.withColumns({
        "_vg_c_mean_word": F.aggregate("_vg_z", F.lit(0).cast("long"), lambda a, x: a + x),
        "_vg_c_short_words": many("_vg_z", lambda x: x <= 2), "_vg_c_long_words": many("_vg_z", lambda x: x > 20),
    }).drop("_vg_z")
    per_line = {"equal_lines", "ended_lines"}
    stat = {"words": F.log1p("_vg_n"), "lines": F.log1p("_vg_m"), "words_a_line": F.try_divide("_vg_n", "_vg_m")}
    stat |= {s: F.try_divide(f"_vg_c_{s}", "_vg_m" if s in per_line else "_vg_n") for s in STATS if s not in stat}
    out = base.withColumns({PREFIX + s: F.coalesce(stat[s].cast("double"), F.lit(0.0)) for s in STATS})
    return out.drop("_vg_n", "_vg_m", *[c for c in out.columns if c.startswith("_vg_c_")])


# ---------------------------------------------------------------- rules

#: (statistic, "<=" or ">", bound), sorted: holds where all of them hold.
Rule = tuple[tuple[str, str, float], ...]

_LINE = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def paths(debug: str, names: list[str]) -> list[Rule]:
    """Every path from a root to a node in the printed trees, each once, with the
    tightest bounds of each statistic; in order of first appearance."""
    found: dict[Rule, None] = {}
    stack: list[tuple[int, tuple[str, str, float]]] = []
    for line in debug.splitlines():
        m = _LINE.match(line)
        if not m:
            if line.strip().startswith("Tree "):
                stack = []
            continue
        deep = len(m[1])
        while stack and stack[-1][0] >= deep:
            stack.pop()
        stack.append((deep, (names[int(m[2])], m[3], float(m[4]))))
        tight: dict[tuple[str, str], float] = {}
        for _, (name, side, bound) in stack:
            old = tight.get((name, side), bound)
            tight[name, side] = min(old, bound) if side == "<=" else max(old, bound)
        found.setdefault(tuple(sorted((n, s, b) for (n, s), b in tight.items())))
    return list(found)


def holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n) <= b if s == "<=" else F.col(n) > b for n, s, b in rule])


class RuleSet(NamedTuple):
    base: float
    weights: dict[Rule, float]

    def score(self) -> Column:
        """Probability of label 1 as one expression over the statistics."""
        odds = reduce(lambda a, b: a + b, [F.when(holds(r), F.lit(w)).otherwise(0.0) for r, w in self.weights.items()], F.lit(self.base))
        return 1 / (1 + F.exp(-odds))


def train(labelled: DataFrame, trees: int = 24, depth: int = 3, penalty: float = 0.001, seed: int = 7,
          label: str = "y", weight: str = "w") -> RuleSet:
    """Fits on rows of statistics with a 0/1 label and a weight."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector

    names = [PREFIX + s for s in STATS]
    n = labelled.agg(*[F.coalesce(F.sum(F.when(F.col(label) == k, F.col(weight))), F.lit(0.0)).alias(f"n{k}") for k in (0, 1)]).first()
    if not n["n0"] or not n["n1"]:
        return RuleSet(log((n["n1"] + 1) / (n["n0"] + 1)), {})
    rows = VectorAssembler(inputCols=names, outputCol="_vg_f").transform(labelled)
    forest = RandomForestClassifier(featuresCol="_vg_f", labelCol=label, weightCol=weight, numTrees=trees, maxDepth=depth, maxBins=64,
                                    subsamplingRate=0.7, featureSubsetStrategy="onethird", seed=seed).fit(rows)
    rules = paths(forest.toDebugString, names)
    values = array_to_vector(F.array(*[holds(r).cast("double") for r in rules]))
    fit = LogisticRegression(featuresCol="_vg_f", labelCol=label, weightCol=weight, elasticNetParam=1.0, regParam=penalty,
                             maxIter=100).fit(labelled.select(label, weight, values.alias("_vg_f")))
    return RuleSet(float(fit.intercept), {r: float(w) for r, w in zip(rules, fit.coefficients.toArray()) if w})


def judge(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          keep: list[str] | None = None, threshold: float = 0.3, **options) -> DataFrame:
    """``docs`` (the id and the columns ``keep``) with ``score`` and ``predicted``.
    Labels count where ``learn`` holds on the row (an expression over ``docs``).
    The statistics are written once; the fit and the scores read that table."""
    spark, stats, path = docs.sparkSession, [PREFIX + s for s in STATS], work_dir(docs.sparkSession, "statistics")
    keep = [id_col, *[c for c in keep or [] if c != id_col]]
    inner = docs.select(F.col(f"`{text_col}`").alias("_vg_text"), F.coalesce(learn, F.lit(False)).alias("_vg_learn"),
                        *[F.col(f"`{c}`").alias(f"_vg_k{i}") for i, c in enumerate(keep)])
    statistics(inner, "_vg_text").drop("_vg_text").write.parquet(path)
    table = spark.read.parquet(path)
    given = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
             .filter("id is not null and y in (0, 1)").groupBy("id", "y").agg(F.count("*").cast("double").alias("w")))
    path = work_dir(spark, "labelled")
    (table.filter("_vg_learn").join(given, F.col("_vg_k0") == F.col("id")).select(F.col("y").cast("double").alias("y"), "w", *stats)
     .repartition(spark.sparkContext.defaultParallelism).write.parquet(path))
    model = train(spark.read.parquet(path), **options)
    out = table.withColumn("_vg_score", model.score())
    return out.select(*[F.col(f"_vg_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_vg_score").alias("score"),
                      (F.col("_vg_score") >= threshold).cast("int").alias("predicted"))
