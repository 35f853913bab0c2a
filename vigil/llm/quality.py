"""Quality rules under weak supervision (DataFrame and SQL functions only).

Rules look at counters of a text and vote good (1), bad (-1) or abstain (0).
Expectation-maximisation over the table of vote patterns estimates, per rule,
how often its votes (where it does not abstain) are bad on good and on bad
documents, and the share of good documents.  The posterior probability of "good" given a document's votes
decides, instead of demanding that every rule passes: one weak bad vote is
outvoted by good ones, two of them reject.  Which class is "good" follows from a prior
that rules are better than chance: each rule's two rates are averaged with
``PRIOR``, which weighs ``PRIOR_SHARE`` times the votes cast, at every size of the input.

Defined results: a null or empty text has no words, so ``base_failed`` is true
and ``kept`` false.  Repeated rows and null keys keep one output row each.  An
empty table gives an empty result.  Input columns other than the text are
untouched; the counters replace input columns of the same name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.session import work_dir

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: rule -> (counter, per counter, good if at most, bad if above); between the two bounds, and where the
#: ratio does not exist, the rule abstains.  Without a bad bound it never votes bad.
RULES = {
    "symbols": ("n_symbols", "n_words", 0.03, 0.15),
    "letters": ("n_other", "word_chars", 0.08, 0.12),
    "odd_words": ("n_odd_words", "n_words", 0.03, 0.15),
    "symbol_runs": ("n_symbol_runs", "n_words", 0.01, 0.1),
    "long_words": ("word_chars", "n_words", 10.0, 16.0),
    "short_words": ("n_words", "word_chars", 0.36, 0.55),
    "dup_lines": ("n_dup_lines", "n_lines", 0.05, 0.3),
    "repeats": ("n_repeat_words", "n_words", 0.1, 0.25),
    "stutter": ("n_stutter", "n_words", 0.08, 0.2),
    "variety": ("n_words", "n_distinct_sq", 0.06, 0.2),
    "shouting": ("n_shouts", "n_words", 0.02, 0.2),
    "capitals": ("n_capitals", "word_chars", 0.15, 0.5),
    "marks": ("n_marks", "n_words", 0.35, 0.8),
    "digits": ("n_digits", "word_chars", 0.1, 0.3),
    "stop_words": ("n_words", "n_stop", 25.0, None),
    "line_ends": ("n_open_lines", "n_lines", 0.3, None),
    "bullets": ("n_bullets", "n_lines", 0.3, 0.9),
    "ellipses": ("n_ellipses", "n_lines", 0.1, 0.3),
    "line_words": ("n_lines", "n_words", 0.2, 0.6),
}
# fixed values: frequent function words of English, German, Spanish and French
STOP = ("the of and to in is that it for was on with as are this "
        "der die das und in zu den von mit sich ist nicht ein eine auf "
        "de la que el en y los del se las por un para con una no "
        "le les et des du est dans qui pas sur au par plus ne").split()
COUNTERS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
INNER = ["n_lines", "n_shouts", "n_stutter", "n_other", "n_distinct_sq", "n_capitals", "n_marks", "n_digits", "n_stop",
         "n_open_lines", "n_bullets", "n_ellipses", "n_odd_words", "n_symbol_runs"]
#: prior shares of bad votes among those cast, on good and on bad documents, and its weight
PRIOR = (0.02, 0.3)
PRIOR_SHARE = 0.1


def counters(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the counters.  ``n_repeat_words`` counts the words inside windows of
    8 words that the text holds twice or more: window hashes (three doublings of
    the word hashes) are compared inside the row, and only rows with an equal
    pair sort theirs."""
    flat = F.col("_vg_t")
    for ch in "\t\n\x0b\x0c\r":
        flat = F.replace(flat, F.lit(ch), F.lit(" "))
    lost = lambda s: F.octet_length("_vg_t") - F.octet_length(F.replace("_vg_t", F.lit(s), F.lit("")))
    base = docs.withColumn("_vg_t", F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).withColumns({
        "_vg_w": F.filter(F.split(flat, " "), lambda x: x != ""),
        "_vg_l": F.filter(F.split("_vg_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "n_symbols": reduce(lambda a, b: a + b, map(lost, SYMBOLS)).cast("long"),
        "n_shouts": (lost("!!") / 2).cast("long"),
        "n_marks": (lost("!") + lost("?") + lost(".") + lost(":") + lost(";")).cast("long"),
        "n_capitals": F.length(F.regexp_replace("_vg_t", "[^A-Z]+", "")).cast("long"),
        "n_digits": F.length(F.regexp_replace("_vg_t", "[^0-9]+", "")).cast("long"),
        "n_odd_words": F.regexp_count("_vg_t", F.lit(rf"[{SYMBOLS}]\S*")).cast("long"),
        "n_symbol_runs": F.regexp_count("_vg_t", F.lit(rf"([{SYMBOLS}~=_])\1\1+")).cast("long"),
        "n_other": F.length(F.regexp_replace("_vg_t", r"[A-Za-z0-9 \t\n\x0B\f\r\x80-\x{10FFFF}]+", "")).cast("long"),
    }).drop("_vg_t")
    base = base.withColumns({
        "n_words": F.size("_vg_w").cast("long"),
        "word_chars": F.aggregate("_vg_w", F.lit(0).cast("long"), lambda a, x: a + F.length(x)),
        "n_lines": F.size("_vg_l").cast("long"),
        "n_dup_lines": (F.size("_vg_l") - F.size(F.array_distinct("_vg_l"))).cast("long"),
        "n_open_lines": F.size(F.filter("_vg_l", lambda x: ~x.rlike(r"[.!?:;\x{2026}\x{3002}]\W*$"))).cast("long"),
        "n_bullets": F.size(F.filter("_vg_l", lambda x: x.rlike(r"^\s*[-*\x{2022}]"))).cast("long"),
        "n_ellipses": F.size(F.filter("_vg_l", lambda x: x.rlike(r"(\.\.\.|\x{2026})\s*$"))).cast("long"),
        "n_stop": F.size(F.array_intersect("_vg_w", F.array(*map(F.lit, dict.fromkeys(STOP))))).cast("long"),
        "_vg_x": F.transform("_vg_w", lambda x: F.xxhash64(x)),
    }).drop("_vg_l", "_vg_w")
    distinct = F.size(F.array_distinct("_vg_x")).cast("long")
    base = base.withColumns({
        "n_stutter": F.size(F.filter("_vg_x", lambda x, k: F.when(k > 0, F.get(F.col("_vg_x"), k - 1)) == x)).cast("long"),
        "n_distinct_sq": distinct * distinct,
        "_vg_x": F.when(F.col("n_words") >= WINDOW, F.col("_vg_x")),
    })
    for step in (1, 2, 4):  # hashes of 2, 4 and 8 words
        n = F.size("_vg_x") - step
        base = base.withColumn("_vg_x", F.zip_with(F.slice("_vg_x", F.lit(1), n), F.slice("_vg_x", F.lit(step + 1), n),
                                                   lambda a, b: F.xxhash64(a, b)))
    base = base.withColumn(
        "_vg_s", F.when(F.size(F.array_distinct("_vg_x")) < F.size("_vg_x"),
                        F.sort_array(F.transform("_vg_x", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("_vg_x")
    same = lambda k: F.coalesce(F.get(F.col("_vg_s"), k)["h"], F.lit(None))
    base = base.withColumn(
        "_vg_p", F.sort_array(F.transform(
            F.filter("_vg_s", lambda x, k: (F.when(k > 0, same(k - 1)).eqNullSafe(x["h"])) | same(k + 1).eqNullSafe(x["h"])),
            lambda x: x["i"]))).drop("_vg_s")
    covered = F.aggregate(
        F.transform("_vg_p", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_vg_p"), k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    return base.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_vg_p")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def votes(rules: dict = RULES) -> dict[str, Column]:
    out = {}
    for name, (counter, per, good, bad) in rules.items():
        x = F.try_divide(counter, per)  # null without words: abstains
        vote = F.when(x <= good, 1)
        out[f"_vg_v_{name}"] = (vote if bad is None else vote.when(x > bad, -1)).otherwise(0)
    return out


def fit(patterns: DataFrame, rules: dict = RULES, rounds: int = 40, prior_share: float = PRIOR_SHARE) -> tuple[float, dict]:
    """EM on the pattern table (at most ``3 ** len(rules)`` rows), from the prior
    rates; each round is one aggregate over the patterns.  Returns the share of good documents and
    {rule: {vote: (P(vote | good, cast), P(vote | bad, cast))}}."""
    names = [f"_vg_v_{r}" for r in rules]
    path = work_dir(patterns.sparkSession, "votes")
    patterns.coalesce(1).write.parquet(path)
    table = patterns.sparkSession.read.parquet(path)
    start = {1: (1 - PRIOR[0], 1 - PRIOR[1]), -1: PRIOR}
    prior, conf = 0.8, {v: start for v in names}
    for _ in range(rounds):
        p = table.withColumn("_vg_g", posterior(prior, conf) * F.col("count")).withColumn("_vg_b", F.col("count") - F.col("_vg_g"))
        row = p.agg(F.sum("_vg_g").alias("g"), F.sum("_vg_b").alias("b"),
                    *[F.sum(F.when(F.col(v) == s, F.col(c)).otherwise(0.0)).alias(f"{v}|{s}|{c}")
                      for v in names for s in (1, -1) for c in ("_vg_g", "_vg_b")]).first()
        g, b = row["g"] or 0.0, row["b"] or 0.0
        if not g + b:
            return prior, {}
        before, prior = prior, (g + 1) / (g + b + 2)

        def bad_share(v: str, c: str, expected: float) -> float:
            bad, cast = row[f"{v}|-1|{c}"] or 0.0, sum(row[f"{v}|{s}|{c}"] or 0.0 for s in (1, -1))
            return (bad + (prior_share * cast + 1) * expected) / (cast + prior_share * cast + 1)

        conf = {v: {-1: (x, y), 1: (1 - x, 1 - y)} for v in names
                for x, y in [(bad_share(v, "_vg_g", PRIOR[0]), bad_share(v, "_vg_b", PRIOR[1]))]}
        if abs(before - prior) < 1e-5:
            break
    return prior, conf


def posterior(prior: float, conf: dict) -> Column:
    """P(good | votes) as one expression over the vote columns; abstaining is no evidence."""
    from math import log

    odds = F.lit(log(prior / (1 - prior)))
    for v, table in conf.items():
        lr = {s: log(a / b) for s, (a, b) in table.items()}
        odds = odds + F.when(F.col(v) == 1, lr[1]).when(F.col(v) == -1, lr[-1]).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, rules: dict = RULES,
          threshold: float = 0.5) -> DataFrame:
    """``docs`` (the columns ``keep``, default all) with the counters,
    ``base_failed``, ``p_good`` and ``kept``.  The counters are computed once and
    written to the shared work folder; the fit and the verdicts read that table."""
    path = work_dir(docs.sparkSession, "quality")
    keep = docs.columns if keep is None else keep
    keep = [c for c in keep if c not in COUNTERS + INNER]
    counters(docs, text_col).select(*[f"`{c}`" for c in keep], *COUNTERS, *INNER).write.parquet(path)
    table = docs.sparkSession.read.parquet(path).withColumns(votes(rules))
    prior, conf = fit(table.groupBy(*[f"_vg_v_{r}" for r in rules]).count(), rules)
    out = table.withColumns({"base_failed": base_failed(), "p_good": posterior(prior, conf) if conf else F.lit(0.0)})
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
    return out.drop(*[f"_vg_v_{r}" for r in rules], *INNER)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with their own columns."""
    clash = {c: f"_vg_own_{c}" for c in docs.columns if c in [*COUNTERS, *INNER, "base_failed", "p_good", "kept"]}
    inner = docs.withColumnsRenamed(clash)
    out = judge(inner, clash.get(text_col, text_col)).filter("kept").select(*[f"`{c}`" for c in inner.columns])
    return out.withColumnsRenamed({v: k for k, v in clash.items()})
