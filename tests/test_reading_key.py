import datetime as dt

import pytest
from pyspark.sql import functions as F

from vigil.sources import fixtures as X

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


def _line(order, part=5, supp=3, line=2, day=10):
    return (order, part, supp, line, 20.0, 30000.0, 0.05, 0.02, "NRA"[order % 3], "O", dt.datetime(1992, 1, 1) + dt.timedelta(days=day))


def _exact(order, part=5, supp=3, line=2, day=10):
    return (((order * 1000003 + part) * 1009 + supp) * 11 + line) * 4096 + day


def test_keys_within_a_long_stay_and_larger_ones_wrap(spark):
    orders = [0, 1, 149_999, 202_880, 202_881, 202_890, 900_000, 54_000_000, 9_000_000_000]
    got = sorted(r["key"] for r in X.sensor_from(spark.createDataFrame([_line(o) for o in orders], LINE)).select("key").collect())
    assert got == sorted(k if k < 2 ** 63 else k % 2 ** 63 for k in map(_exact, orders))
    assert len(set(got)) == len(orders) and any(_exact(o) >= 2 ** 63 for o in orders)


def test_every_part_may_be_large(spark):
    big = [(900_000, 2 ** 40 + 7, 2 ** 50 + 3, 2 ** 31 - 1, 5000), (2 ** 62, 2 ** 61 + 1, 2 ** 60 + 9, -4, -3), (-(2 ** 63), 1, 1, 1, 1)]
    df = spark.createDataFrame(big, "o long, p long, s long, l int, d int")
    got = [r["k"] for r in df.select(X.reading_key(*[F.col(c) for c in "opsld"]).alias("k")).collect()]
    assert got == [_exact(*x) % 2 ** 63 for x in big]


def test_null_and_negative_parts_of_a_key(spark):
    rows = [_line(-1), (None, *_line(1)[1:]), (*_line(900_000)[:10], None)]
    got = [r["key"] for r in X.sensor_from(spark.createDataFrame(rows, LINE)).select("key").collect()]
    assert got == [_exact(-1), None, None]


@pytest.mark.parametrize("name", ["action", "confidence", "align_target", "clip_outliers", "ensure_numeric", "feat_energy",
                                  "feat_interaction", "completeness", "describe_categorical", "encode_onehot"])
def test_queries_over_large_order_keys(spark, tmp_path, name):
    from vigil.plans import catalog

    rows = [_line(o, line=i % 7, day=i) for i, o in enumerate(range(890_000, 890_060))]
    spark.createDataFrame(rows, LINE).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    catalog.load_all()
    out = catalog.QUERIES[name](spark, str(tmp_path))
    assert out.agg(F.count(F.lit(1))).first()[0] >= 1
    assert len(out.collect()) >= 1


@pytest.mark.parametrize("name", ["alerts", "align_to_model", "anomaly_reconstruction", "binned_target", "concat_columns", "custom_features",
                                  "encode_latent", "feat_all_sets", "feat_baseline", "feat_extended", "feat_failure_agg"])
def test_only_the_key_depends_on_the_size_of_order_keys(spark, tmp_path, name):
    from vigil.plans import catalog

    catalog.load_all()
    found = []
    for first in (2_000, 890_000):  # apart by a multiple of 3, 20 and 1000: same types, gates and modes
        rows = [(o, 5 + 7 * i, 3, i % 7, 50.0 if i % 2 else 20.0, 30000.0 + 90 * i, 0.1 if i % 2 else 0.05, 0.0 if i % 2 else 0.02, "NRA"[o % 3], "O",
                 dt.datetime(1992, 1, 1) + dt.timedelta(days=i)) for i, o in enumerate(range(first, first + 60))]
        at = tmp_path / str(first)
        spark.createDataFrame(rows, LINE).coalesce(1).write.parquet(str(at / "lineitem.parquet"))
        got = catalog.QUERIES[name](spark, str(at)).collect()  # with its key
        found.append(sorted(repr([v for k, v in r.asDict().items() if k != "key"]) for r in got))
    assert found[0] == found[1] and len(found[0]) >= 1
