"""Corpus preparation as five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``.  All but the last
return the columns of ``documents``.  ``n_chars`` follows the text.

1. quality_rules: documents that the rules' posterior rejects go.
2. ngram_jaccard_join: one document of each component stays (5-word shingles,
   similarity 0.8 or more), the one with the smallest doc_id.
3. suffix_array_dedup: bytes under 290-byte strings that start elsewhere too go
   (a passage of just over 50 words has 300 bytes or more); a document of which
   less than a character remains goes with them.
4. benchmark_decontamination: documents that hold a verified benchmark item go.
5. merge_dropout: the remaining documents with their pieces.

Null texts and texts under 20 words end in the first stage.  An empty table
passes all stages and gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import decontaminate, jaccard, quality, segments, suffixes
from vigil.session import work_dir


#: repeated strings of so many bytes go: just under the shortest passage of over 50 words
REPEAT_BYTES = 290


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, words=5, jaccard=(80, 100))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = suffixes.strip(docs, width=REPEAT_BYTES).filter((F.octet_length("text") > 0) | F.col("text").isNull())
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def segmented(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return segments.segment(docs, public_tokenizers.path("piece_bpe_32k.model"), keep_text=True)


STAGES = [
    ("quality_rules", good_documents),
    ("ngram_jaccard_join", one_of_each_group),
    ("suffix_array_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmark),
    ("merge_dropout", segmented),
]

#: Components, suffixes and segmentation have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table, each written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
