import duckdb
import pytest

import __spark_entry__ as E

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

FAST = ["risk_by_type", "report_summary", "describe", "crosstab", "impute_auto", "split_stratified", "encode_label",
        "corr_spearman", "roc_auc", "best_threshold", "evaluate_many", "rank_models", "sequences", "scan_csv",
        "class_metrics", "boxplot_stats", "select_mutual_info", "model_gaussian_nb"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 12 and set(df.columns) == {"type", "risk_level", "count", "percentage"}


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 190


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("key", FAST)
def test_query_matches_oracle(spark, sf, duck, key):
    df = E.queries()[key](spark, sf)
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm(df.columns, [tuple(r) for r in df.collect()]) == _norm(dcols, cur.fetchall())
