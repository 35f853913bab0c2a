import numpy as np
import public_tokenizers as P

from vigil.llm import alignment as X

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def test_parts_are_dealt_to_as_many_tasks_as_they_need(spark):
    docs = spark.createDataFrame([(i, f"text {i} of many small ones") for i in range(60)], "doc_id long, text string").repartition(60)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    few, many = X.digest(docs.coalesce(1), A, B), X.digest(docs, A, B)
    assert few.rdd.getNumPartitions() <= tasks
    assert many.rdd.getNumPartitions() >= 15 > tasks
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_links_take_the_bytes_they_need(spark):
    docs = spark.createDataFrame([(i, "a b c d e f") for i in range(50)], "doc_id long, text string").coalesce(1)
    row = X.parts(docs, A, B).first()
    assert len(row["times"]) == len(row["at"]) and len(row["at"]) < 50 * 10 + 2
    for top in (0, 255, 256, 65535, 65536, 1 << 32, 1 << 62):
        x = np.array([0, 1, top], np.int64)
        assert X._wide(X._narrow(x)).tolist() == x.tolist()
    assert X._wide(X._narrow(np.zeros(0, np.int64))).tolist() == []
