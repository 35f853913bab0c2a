"""URL filter: host rules, else naive Bayes over segmented host words and path tokens.

Host labels such as ``cheappills`` are split into words by the most probable
segmentation under unigram word counts (Viterbi).  The counts come from the
text of the pages.  A multinomial naive Bayes then scores a url's host words
and path tokens; its classes are learned from the urls that the rules decide.

Everything that grows with the data stays in joins on words, host labels, hosts
and paths; each host and each path is scored once, however many urls share it.

Defined results: a null url or one without ``://`` has an empty host and path,
fits no rule and gets the verdict of the class shares alone.  Null keys and
repeated rows keep one output row each.  Without any url under a rule every
verdict of the method is "allow".
"""

from __future__ import annotations

import math
import string

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: (verdict, host/path), longest wins
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
MAX_WORD = 20  # longest dictionary word, in letters


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): A-Z of the host lower-cased; both empty without ``://``."""
    take = lambda k: F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(take(1), string.ascii_uppercase, string.ascii_lowercase), take(2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        h, p = rule[:rule.index("/")], rule[rule.index("/"):]
        found = F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.lit(rule)).otherwise(found)
    return found


def labels(host: Column) -> Column:
    """Runs of letters of a host."""
    return F.filter(F.split(host, r"[^\p{Ll}]+"), lambda x: x != "")


def path_tokens(path: Column) -> Column:
    """Lower-case words of a path; runs of digits count as one token."""
    low = F.regexp_replace(F.lower(path), r"[0-9]+", " #num ")
    return F.transform(F.filter(F.split(low, r"[^\p{L}#]+"), lambda x: x != ""), lambda x: F.concat(F.lit("/"), x))


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(word, n) over the visible text of all pages, words of up to 20 letters."""
    text = F.lower(F.regexp_replace(F.regexp_replace(F.col(f"`{html_col}`"), r"(?is)<(script|style)\b.*?</\1>", " "), r"<[^>]*>", " "))
    word = pages.select(F.explode(F.split(text, r"[^\p{Ll}]+")).alias("word"))
    return word.filter((word.word != "") & (F.length("word") <= MAX_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def viterbi(label: str, cost: dict[str, float], unknown: float) -> list[str]:
    """Cheapest split of ``label``; words outside ``cost`` pay ``unknown`` plus log 10 per letter."""
    n = len(label)
    best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
    for j in range(1, n + 1):
        for i in range(max(0, j - MAX_WORD), j):
            w = label[i:j]
            c = best[i] + cost.get(w, unknown + math.log(10) * len(w))
            if c < best[j]:
                best[j], back[j] = c, i
    out = []
    while n:
        out.append(label[back[n]:n])
        n = back[n]
    return out[::-1]


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) for the distinct ``label`` column of ``names``: dictionary
    words inside each label come by a join, then each label is split by itself."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    unknown = math.log(total) - math.log(10)
    end = F.least(F.length("label"), F.col("i") + MAX_WORD - 1)
    inside = (names.select("label", F.explode(F.sequence(F.lit(1), F.length("label"))).alias("i"))
              .select("label", "i", F.explode(F.sequence(F.col("i"), end)).alias("j"))
              .select("label", F.expr("substring(label, i, j - i + 1)").alias("word")).distinct())
    known = (inside.join(counts, "word").groupBy("label")
             .agg(F.collect_list(F.struct("word", "n")).alias("known")))  # at most 20 words per letter of the label

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(label: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([viterbi(a, {x["word"]: math.log(total / x["n"]) for x in ([] if k is None else k)}, unknown)
                          for a, k in zip(label, known)])

    return names.join(known, "label", "left").select("label", split("label", "known").alias("words"))


def judge(pages: DataFrame, url_col: str = "url", html_col: str = "html", rules=RULES, smoothing: float = 1.0) -> DataFrame:
    """``pages`` without the html, with host, path, rule, verdict and log_odds (of allow, by the method)."""
    host, path = parts(F.col(f"`{url_col}`"))
    new = ["host", "path", "rule", "verdict", "log_odds"]
    keep = [c for c in pages.columns if c not in [*new, html_col]]
    base = pages.select(*[f"`{c}`" for c in keep], host.alias("_vg_host"), path.alias("_vg_path"))
    base = base.withColumn("_vg_rule", rule_of(F.col("_vg_host"), F.col("_vg_path"), rules))
    blocked = [r for v, r in rules if v == "block"]
    seen = base.groupBy("_vg_host", "_vg_path").agg(
        F.count(F.lit(1)).alias("n"), F.first("_vg_rule").alias("rule"))  # the rule depends on host and path alone
    # host words
    hosts = seen.groupBy(F.col("_vg_host").alias("host")).agg(
        F.sum(F.when(F.col("rule").isNotNull() & ~F.col("rule").isin(blocked), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("rule").isin(blocked), F.col("n")).otherwise(0)).alias("bad"))
    label = hosts.select("host", "good", "bad", F.explode(labels(F.col("host"))).alias("label"))
    words = segment(label.select("label").distinct(), word_counts(pages, html_col))
    host_tokens = label.join(words, "label").select("host", "good", "bad", F.explode("words").alias("token"))
    # path tokens
    paths = seen.groupBy(F.col("_vg_path").alias("path")).agg(
        F.sum(F.when(F.col("rule").isNotNull() & ~F.col("rule").isin(blocked), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("rule").isin(blocked), F.col("n")).otherwise(0)).alias("bad"))
    way = paths.select("path", "good", "bad", F.explode(path_tokens(F.col("path"))).alias("token"))
    every = host_tokens.select("token", "good", "bad").unionByName(way.select("token", "good", "bad"))
    counts = every.groupBy("token").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    size = counts.agg(F.sum("good"), F.sum("bad"), F.count(F.lit(1))).first()
    share = hosts.agg(F.sum("good"), F.sum("bad")).first()
    g, b, v = (size[0] or 0), (size[1] or 0), size[2] or 1
    prior = math.log(((share[0] or 0) + 1) / ((share[1] or 0) + 1)) if (share[0] or share[1]) else 0.0
    weight = counts.select("token", (F.log((F.col("good") + smoothing) / (g + smoothing * v))
                                     - F.log((F.col("bad") + smoothing) / (b + smoothing * v))).alias("w"))
    by_host = host_tokens.join(weight, "token").groupBy(F.col("host").alias("_vg_host")).agg(F.sum("w").alias("_vg_a"))
    by_path = way.join(weight, "token").groupBy(F.col("path").alias("_vg_path")).agg(F.sum("w").alias("_vg_b"))
    odds = F.coalesce("_vg_a", F.lit(0.0)) + F.coalesce("_vg_b", F.lit(0.0)) + F.lit(prior)
    out = base.join(by_host, "_vg_host", "left").join(by_path, "_vg_path", "left").withColumn("log_odds", F.round(odds, 9))
    verdict = F.when(F.col("_vg_rule").isin(blocked), "block").when(F.col("_vg_rule").isNotNull(), "allow")
    verdict = verdict.when(F.col("log_odds") >= 0, "allow").otherwise("block")
    return out.select(*[f"`{c}`" for c in keep], F.col("_vg_host").alias("host"), F.col("_vg_path").alias("path"),
                      F.col("_vg_rule").alias("rule"), verdict.alias("verdict"), "log_odds")
