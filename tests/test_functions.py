import math

from pyspark.sql import functions as F

from flightlake.functions import (blank_to_null, coalesce_alias, deg_dist_sq, flag, flight_phase, norm_key,
                                  num, safe_ratio)


def test_num_edge_cases(spark):
    df = spark.createDataFrame([("",), ("abc",), (" 2 ",), ("1e3",), ("NaN",), ("inf",), (None,)], "s string")
    got = [r.x for r in df.select(num("s").alias("x")).collect()]
    assert got[:2] == [None, None]
    assert got[2] == 2.0 and got[3] == 1000.0
    assert got[4] is None, "NaN must become NULL (NaN > 4000 is true in Spark)"
    assert math.isinf(got[5]) and got[6] is None


def test_flag_and_keys(spark):
    df = spark.createDataFrame([("True", " AbC\t"), ("true", "  "), ("False", None), (None, "x")], "f string, k string")
    r = df.select(flag("f").alias("s"), flag("f", strict=False).alias("l"), norm_key("k").alias("n"),
                  blank_to_null("k").alias("b")).collect()
    assert [x.s for x in r] == [True, False, False, False]
    assert [x.l for x in r] == [True, True, False, False]
    assert r[0].n == "abc" and r[1].n == "" and r[2].n is None
    assert r[1].b is None and r[0].b == " AbC\t"


def test_distance_ratio_phase(spark):
    df = spark.createDataFrame([(60.0, 10.0, 60.1, 10.2, 3, 0, 1.0)], "a double, b double, c double, d double, n int, z int, r double")
    row = df.select(deg_dist_sq("a", "b", "c", "d").alias("d2"), safe_ratio("n", "z").alias("q0"),
                    safe_ratio("n", F.lit(2)).alias("q"), flight_phase("r").alias("p")).first()
    exp = 0.1 ** 2 + (0.2 * math.cos(math.radians(60.0))) ** 2
    assert abs(row.d2 - exp) < 1e-12
    assert row.q0 == 0.0 and row.q == 1.5 and row.p == "climb"
    ph = spark.createDataFrame([(0.5,), (-0.5,), (-0.6,), (None,)], "r double").select(flight_phase("r").alias("p"))
    assert [x.p for x in ph.collect()] == ["cruise", "cruise", "descent", None]


def test_coalesce_alias(spark):
    df = spark.createDataFrame([(None, 1.5, True, None), ("2", 3.0, False, 7.0)],
                               "lat string, latitude double, onground boolean, altitude double")
    out = coalesce_alias(df, ["lat", "onground", "geoaltitude", "spi"]).collect()
    assert tuple(out[0]) == ("1.5", "True", "", "")
    assert tuple(out[1]) == ("2", "False", "7.0", "")
