import math

from pyspark.sql import functions as F

from vigil.functions import features as FX
from vigil.functions.numeric import canonical, round_half_away


def test_family_sizes_match_catalog(spark):
    df = spark.createDataFrame([(300.0, 310.0, 1500.0, 40.0, 120.0)], "air_temp double, proc_temp double, speed double, torque double, wear double")
    params = FX.fit_extended(df)
    for fam, n in FX.FAMILY_SIZES.items():
        assert len(FX.family_cols(fam, params)) == n
    ext = FX.feature_set(df, "extended")
    assert len(ext.columns) == 5 + 52 and len(set(ext.columns)) == len(ext.columns)


def test_formulas_on_reading_line(spark):
    # the reading line "300,310,1500,40,120"
    df = spark.createDataFrame([(300.0, 310.0, 1500.0, 40.0, 120.0)], "air_temp double, proc_temp double, speed double, torque double, wear double")
    r = df.select(*[v.alias(k) for k, v in {**FX.temperature_cols(), **FX.power_cols(), **FX.wear_cols(),
                                            **FX.interaction_cols()}.items()]).first()
    assert r["temp_difference"] == 10.0
    assert abs(r["mechanical_power"] - 40 * 1500 * 2 * math.pi / 60) < 1e-9
    assert (r["wear_low"], r["wear_medium"], r["wear_high"]) == (0, 1, 0)
    assert abs(r["wear_log"] - math.log1p(120)) < 1e-12
    assert abs(r["speed_torque_ratio"] - 1500 / (40 + 1e-6)) < 1e-9


def test_log_and_sqrt_guards(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (-2.0,), (3.0,)], "x double")
    out = df.select(FX.log1p_guarded(F.col("x")).alias("l"), FX.sqrt_signed(F.col("x")).alias("s")).collect()
    assert out[0]["l"] == 0.0 and out[1]["l"] is None and out[2]["l"] is None
    assert out[2]["s"] == -math.sqrt(2.0) and out[3]["s"] == math.sqrt(3.0)
    shift = FX.fit_log_shift(df, ["x"])
    assert abs(shift["x"] - (2.0 + 1e-6)) < 1e-12  # min <= 0: abs(min) + c


def test_extended_fill_and_unknown_set(spark):
    df = spark.createDataFrame([(300.0, 310.0, 1500.0, 40.0, -1.0)], "air_temp double, proc_temp double, speed double, torque double, wear double")
    out = FX.feature_set(df, "engineered_only").first()
    assert out["wear_log"] == 0.0  # undefined -> 0
    assert FX.feature_set(df, "no_such_set").columns == ["air_temp", "proc_temp", "speed", "torque", "wear"]


def test_polynomial_terms_order_and_names():
    terms = FX.polynomial_terms(["a", "b"], 2)
    assert [t[0] for t in terms] == ["a", "b", "a^2", "a b", "b^2"]
    assert [t[0] for t in FX.polynomial_terms(["a", "b", "c"], 2, interaction_only=True)] == ["a", "b", "c", "a b", "a c", "b c"]


def test_output_rounding_is_binary_half_away(spark):
    df = spark.createDataFrame([(0.0640625,), (-0.0640625,), (-1e-17,), (19.232887499999998,)], "x double")
    r = [x[0] for x in df.select(round_half_away(F.col("x"), 6)).collect()]
    assert r[0] == 0.064062 and r[1] == -0.064062
    c = [x[0] for x in df.select(canonical(F.col("x"))).collect()]
    assert c[2] == 0.0 and math.copysign(1, c[2]) == 1.0 and c[3] == 19.232888
