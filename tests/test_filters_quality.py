from flightlake.operators import filters as Fl
from flightlake.operators import quality as Q

COLS = "icao24 string, lat string, lon string, velocity string, geoaltitude string, vertrate string, onground string, baroaltitude string"


def _df(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_ground_predicate_boundaries(spark):
    rows = [
        ("a", "1", "1", "13.86", "499.9", "0.5", "False", "1"),    # 49.896 km/h, level, low -> ground
        ("b", "1", "1", "13.8889", "499.9", "0.5", "False", "1"),  # 50.0004 km/h -> not
        ("c", "1", "1", "1", "500", "0", "False", "1"),            # 500 m -> not
        ("d", "1", "1", "1", "10", "-0.51", "False", "1"),         # climbing -> not
        ("e", "1", "1", "", "", "", "True", "1"),                  # reported -> ground
        ("f", None, "1", "1", "10", "0", "True", "1"),             # no position -> not
        ("g", "1", "1", "bad", "10", "0", "False", "1"),           # NULL speed -> not
    ]
    got = sorted(r.icao24 for r in Fl.on_ground_points(_df(spark, rows)).collect())
    assert got == ["a", "e"]


def test_phase_and_airborne(spark):
    rows = [("a", "1", "1", "100", "1000", "25", "False", "1000"),   # 90 km/h inclusive
            ("b", "1", "1", "100", "1000", "25.01", "False", "1000"),
            ("c", "1", "1", "100", "", "-25", "False", "")]
    assert sorted(r.vertrate_kmh for r in Fl.phase_points(_df(spark, rows)).collect()) == [90.0]
    air = Fl.airborne(_df(spark, rows)).collect()
    assert sorted(r.icao24 for r in air) == ["a", "b"] and air[0].velocity_kmh == 360.0


def _status(spark, n_bad, n=1000):
    rows = [("x", "1", "1", "1", "1", "0", "True", "4000.1" if i < n_bad else "4000") for i in range(n)]
    rep = {r.rule: r for r in Q.validate(_df(spark, rows)).collect()}
    return rep["Ground Logic"].status, rep["Ground Logic"].failed_rows


def test_validation_status(spark):
    assert _status(spark, 0) == ("PASS", 0)
    assert _status(spark, 99) == ("WARN", 99)
    assert _status(spark, 100)[0] == "FAIL"      # exactly 90 % pass is not > 90
    assert _status(spark, 500)[0] == "FAIL"


def test_lat_lon_rules_and_missing(spark):
    rows = [("a", "90", "180", "1", "1", "0", "False", "1"), ("", "90.01", "-180.01", "", "1", "0", "False", "1"),
            (None, None, "x", "1", "1", "0", "False", "1")]
    rep = {r.rule: r.failed_rows for r in Q.validate(_df(spark, rows)).collect()}
    assert rep == {"PK Exists": 2, "Lat Range": 1, "Lon Range": 1, "Ground Logic": 0}
    miss = {r.column_name: r.missing for r in Q.missing_report(_df(spark, rows), only_missing=True).collect()}
    assert miss == {"icao24": 1, "lat": 1}
    miss = {r.column_name: r.missing for r in Q.missing_report(_df(spark, rows), blank_is_null=True,
                                                              only_missing=True).collect()}
    assert miss["icao24"] == 2 and miss["velocity"] == 1
