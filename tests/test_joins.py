from pyspark.sql import functions as F

from flightlake.operators import joins as J
from flightlake.operators import quality as Q


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


FEED = [("ABC ", 1.0), ("def", 2.0), (None, 3.0)]


def pairs(df):
    return sorted((r.icao24 or "", r.model or "") for r in df.collect())


def test_enrich_dedupes_and_normalises(spark):
    feed = spark.createDataFrame(FEED, "icao24 string, v double")
    dim = spark.createDataFrame([(" abc", "M1"), ("ABC", "M0"), ("xyz", "M2")], "icao24 string, model string")
    assert pairs(J.enrich(feed, dim)) == [("", ""), ("abc", "M0"), ("def", "")]   # one row per feed row


def test_known_master_row_beats_an_empty_one(spark):
    feed = spark.createDataFrame(FEED, "icao24 string, v double")
    dim = spark.createDataFrame([("abc123", None, None), ("ABC123 ", "Airbus", "A320")],
                                "icao24 string, manufacturerName string, model string")
    hit = J.enrich(feed.limit(1).withColumn("icao24", F.lit("abc123")), dim).first()
    assert (hit.manufacturerName, hit.model) == ("Airbus", "A320")
    first = spark.createDataFrame([("abc", "second", 2), ("ABC", "first", 1)], "icao24 string, model string, _pos long")
    out = J.enrich(feed, first)
    assert pairs(out) == [("", ""), ("abc", "first"), ("def", "")] and "_pos" not in out.columns


def test_raw_keys_stay_raw(spark):
    feed = spark.createDataFrame([("ABC", 1.0), ("abc", 2.0)], "icao24 string, v double")
    dim = spark.createDataFrame([("ABC", "M")], "icao24 string, model string")
    assert pairs(J.enrich(feed, dim, normalize=False)) == [("ABC", "M"), ("abc", "")]


def test_null_safe_keys_match(spark):
    feed = spark.createDataFrame(FEED, "icao24 string, v double")
    dim = spark.createDataFrame([(None, "N"), ("def", "D")], "icao24 string, model string")
    for dedupe in (True, False):
        assert pairs(J.enrich(feed, dim, dedupe=dedupe, null_safe=True)) == [("", "N"), ("abc", ""), ("def", "D")]
    assert pairs(J.enrich(feed, dim)) == [("", ""), ("abc", ""), ("def", "D")]


def test_no_forced_broadcast(spark):
    feed = spark.range(1000).selectExpr("lower(hex(id)) AS icao24")
    dim = spark.range(500).selectExpr("lower(hex(id)) AS icao24", "'m' AS model")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "rightHint" not in J.enrich(feed, dim)._jdf.queryExecution().analyzed().toString()
        assert "BroadcastHashJoin" not in _plan(J.enrich(feed, dim))
        assert "BroadcastHashJoin" in _plan(J.enrich(feed, dim, broadcast_limit=1 << 40))
        assert "BroadcastHashJoin" not in _plan(J.enrich(feed, dim, broadcast_limit=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_known_unknown(spark):
    feed = spark.createDataFrame([("a",), ("B ",), ("c",)], "icao24 string")
    dim = spark.createDataFrame([("A",), ("b",), ("z",)], "icao24 string")
    assert sorted(r.icao24 for r in J.known_aircraft(dim, feed).collect()) == ["a", "b"]
    assert [r.icao24 for r in J.unknown_aircraft(feed, dim).collect()] == ["c"]


def test_validation_skips_rules_without_columns(spark):
    df = spark.createDataFrame([("a", "10")], "icao24 string, lat string")
    assert [r.rule for r in Q.validate(df).collect()] == ["PK Exists", "Lat Range"]
