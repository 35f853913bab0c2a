"""Registered queries of the corpus operators; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_quality_rules(spark, sf_dir):
    """Counters, base verdict and weak-supervision verdict of every document."""
    from vigil.llm import quality

    out = quality.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "p_good")


@query
def op1_suffix_array_dedup(spark, sf_dir):
    """Removes every byte under a 400-byte string that also starts elsewhere."""
    from vigil.llm import suffixes

    return suffixes.digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_url_filters(spark, sf_dir):
    """Rule or naive Bayes verdict of every page's url."""
    from vigil.llm import urls

    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "log_odds")


@query
def op7_token_file(spark, sf_dir):
    """Writes every document's token ids as patched blocks and reads them back."""
    import public_tokenizers

    from vigil.llm import tokenfile

    return tokenfile.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_language_id(spark, sf_dir):
    """Learns from four fifths of the documents, predicts all."""
    import public_tokenizers

    from vigil.llm import language

    path = public_tokenizers.path("piece_bpe_32k.model")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(1))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold == 0).alias("held_out"))
    model = language.fit(docs.filter("not held_out"), path, "text", "lang")
    return language.predict(docs.select("doc_id", "held_out", "text"), model, path)


@query
def op9_lm_scoring(spark, sf_dir):
    """Deleted-interpolation score of every document, learned from six sevenths."""
    from vigil.llm import lm

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out"))
    return lm.score(docs, ~F.col("held_out"))


@query
def op4_ngram_jaccard_join(spark, sf_dir):
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    from vigil.llm import jaccard

    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_benchmark_decontamination(spark, sf_dir):
    """Documents that hold a benchmark item, with the item and the overlaps."""
    from vigil.llm import decontaminate

    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find(docs.select("doc_id", "text"), items)


@query
def op2_substring_dedup(spark, sf_dir):
    """Sentences under non-first repeats of runs of two sentences or more, and what remains."""
    from vigil.llm import spans

    return spans.strip(table(spark, sf_dir, "documents").select("doc_id", "text"), grow=True).drop("text")


@query
def op3_merge_dropout(spark, sf_dir):
    """Pieces of every document under seeded merge-dropout, decoded again."""
    import public_tokenizers

    from vigil.llm import segments

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return segments.segment(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_cross_tokenizer_alignment(spark, sf_dir):
    """Groups, links and corpus-wide link counts of two tokenizers over every document."""
    import public_tokenizers as P

    from vigil.llm import alignment

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.digest(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


@query
def op11_embedding_whitening(spark, sf_dir):
    """Every vector on the eight largest components of the polarisation covariance."""
    from vigil.llm import whitening

    out = whitening.components(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op12_quality_classifier(spark, sf_dir):
    """Learns rules from four fifths of the labelled documents, scores all."""
    from vigil.llm import ruleset

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out"))
    return ruleset.judge(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), ~F.col("held_out"), keep=["held_out"])
