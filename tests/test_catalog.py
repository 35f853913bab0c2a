import duckdb
from pyspark.sql import functions as F

from vigil.plans.catalog import canonical_sql, round_doubles
from vigil.session import work_dir


def test_canonical_sql_rewrites_only_six_place_rounds():
    sql = "SELECT round(avg(x), 6) AS a, round(x, 4) AS b, round(round(x, 6) * 2, 6) AS c FROM t"
    out = canonical_sql(sql)
    assert "round(x, 4)" in out and out.count("round(round(CAST") == 3
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (VALUES (0.0640625), (-1e-17)) v(x)")
    rows = con.execute(canonical_sql("SELECT round(x, 6) AS r FROM t ORDER BY x")).fetchall()
    assert [r[0] for r in rows] == [0.0, 0.064062]


def test_round_doubles_matches_sql_form(spark):
    vals = [0.0640625, -1e-17, 19.23288749999999, 19.2328875, -2.5e-7, 123456.7890125]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in round_doubles(df).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    want = [r[0] for r in con.execute(canonical_sql("SELECT round(x, 6) FROM t ORDER BY i")).fetchall()]
    assert got == want and got[1] == 0.0


def test_work_dir_lives_under_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b
