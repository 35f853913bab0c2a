import corpus_pipeline


def test_one_edit_in_fifty_words_is_a_near_copy(spark, sf):
    w = [f"w{i}" for i in range(50)]
    edited = [*w[:25], "other", *w[26:]]  # similarity 41/51 of five-word shingles, 43/51 of four-word ones
    docs = spark.createDataFrame([(1, " ".join(w), "en", "x", 1), (2, " ".join(edited), "en", "x", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs, sf).collect()] == [1]
