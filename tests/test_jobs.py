"""End-to-end job chains and plan properties on stored runs."""

from pyspark.sql import functions as F

from flightlake.operators import filters as Fl
from flightlake.operators.ingest import clean_states
from flightlake.plans import jobs, views
from flightlake.sources import files as S
from flightlake.sources.archives import write_state_archives

SF = "/root/testdata/sf0.001"


def test_ingest_to_airports_chain(spark, tmp_path):
    states = views.states(spark, SF).drop("event_id")
    archives = [r.path for r in write_state_archives(states, root=str(tmp_path / "archives"), num_archives=3).collect()]
    assert len(archives) == 3
    keys = S.select_archives(S.list_files(spark, str(tmp_path / "archives")), year_pattern=None)
    runs = str(tmp_path / "processed")
    jobs.ingest_states(spark, keys, runs, 1000)
    jobs.ingest_states(spark, archives[:1], runs, 900)                  # an older, smaller run
    latest = S.latest_run(S.list_files(spark, runs, glob="*.parquet")).first()
    assert latest.epoch == 1000
    n, _ = S.verify_run(spark, latest.run_dir)
    expected = clean_states(states.filter("time RLIKE '^[0-9]+$'"))  # bad times are not accepted
    assert n == expected.count()
    got = [tuple(r) for r in jobs.detect_airports(S.read_run(spark, latest.run_dir)).collect()]
    want = [tuple(r) for r in jobs.detect_airports(expected).collect()]
    assert got == want and len(got) > 0


def test_filter_reaches_parquet_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    run = S.write_run(clean_states(views.states(spark, SF)), str(tmp_path), 1)
    plan = Fl.airborne(S.read_run(spark, run))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(onground,False)" in plan and "IsNotNull(velocity)" in plan
    pruned = Fl.airborne(S.read_run(spark, run)).select("velocity_kmh")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<velocity:double,onground:string,baroaltitude:string>" in pruned


def test_ingest_of_nothing(spark, tmp_path):
    runs = str(tmp_path / "runs")
    assert jobs.ingest_states(spark, [], runs, 1) is None
    unusable = views.states(spark, SF).drop("event_id").withColumn("velocity", F.lit(None).cast("string"))
    paths = [r.path for r in write_state_archives(unusable, root=str(tmp_path / "a"), num_archives=1).collect()]
    assert jobs.ingest_states(spark, paths, runs, 2) is None
    assert not (tmp_path / "runs" / "run_2").exists()


def test_points_are_all_rows_unless_asked(spark):
    st = views.states(spark, SF)
    every = jobs.speed_altitude_points(st)
    assert every.count() == Fl.airborne(st).count()
    a = jobs.speed_altitude_points(st, row_cap=100).collect()
    b = jobs.speed_altitude_points(st.repartition(5), row_cap=100).collect()
    assert len(a) == 100 and sorted(a) == sorted(b)


def test_aircraft_ingest_returns_what_is_stored(spark, tmp_path):
    first, second = tmp_path / "a.csv", tmp_path / "b.csv"
    first.write_text("icao24,model\nabc,old\n")
    second.write_text("icao24,model\nabc,new\n")
    out = str(tmp_path / "aircraft")
    assert jobs.ingest_aircraft(spark, str(first), out).first().model == "old"
    assert jobs.ingest_aircraft(spark, str(second), out).first().model == "old"
