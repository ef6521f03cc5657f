import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from flightlake.operators import windows as W


def _tele(spark, stages):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(seconds=0.5 * i + (7200 if i > 5 else 0)), s, float(i), float(i), 1.0, 0.0, 2.0,
             (i * i) * 1024 * 1024) for i, s in enumerate(stages)]
    return spark.createDataFrame(rows, "sample_id long, timestamp timestamp_ntz, stage string, cpu_percent double, "
                                 "ram_percent double, ram_gb double, net_sent_mb double, net_recv_mb double, bytes_recv long")


def test_stage_intervals_reappearing_and_single(spark):
    tele = _tele(spark, ["Init", "Init", "Load", "Init", "Write", "Load", "Load", "Done"])
    iv = {r.stage: r for r in W.stage_intervals(tele).collect()}
    assert iv["Init"].end == iv["Load"].start           # first appearance only
    assert iv["Done"].duration_s == 0.0                  # single sample, last stage
    summ = {r.stage: r for r in W.stage_summary(tele).collect()}
    assert summ["Init"].duration_s == 1.5 and summ["Load"].net_recv_mb_sum == 6.0


def test_counter_delta_across_ranges(spark):
    tele = _tele(spark, ["a"] * 12)
    got = W.counter_delta(tele, "timestamp", ["bytes_recv"], seq="sample_id", ranges=4).orderBy("sample_id")
    deltas = [r.bytes_recv_delta_mb for r in got.collect()]
    exp = pd.Series([(i * i) for i in range(12)], dtype=float).diff().fillna(0.0).tolist()
    assert deltas == exp
    since = W.counter_since_start(tele, "timestamp", ["bytes_recv"], seq="sample_id").orderBy("sample_id").collect()
    assert [r.bytes_recv_since_start_mb for r in since] == [float(i * i) for i in range(12)]


def test_run_kpis_and_bench(spark):
    log = spark.createDataFrame([(1, "Duration", 10.0), (2, "RowCount", 50.0), (3, "Duration", 20.0)],
                                "seq long, metric string, value double")
    k = W.run_kpis(log).first()
    assert (k.duration, k.row_count, k.throughput) == (20.0, 50.0, 2.5)
    k0 = W.run_kpis(log.filter("metric = 'Duration'")).first()
    assert k0.row_count == 0.0 and k0.throughput == 0.0
    hist = spark.createDataFrame([(1, 5, 10.0), (2, 5, 20.0), (3, 1, 4.0)], "seq long, files_count int, duration_sec double")
    b = W.bench_summary(hist).collect()
    assert [(r.files_count, r.duration_sec, r.sec_per_file) for r in b] == [(1, 4.0, 4.0), (5, 20.0, 4.0)]


def test_attached_scalars_keep_timestamps(spark):
    from pyspark.sql import functions as F

    from flightlake.operators.aggregates import attach_scalars
    df = spark.createDataFrame([(1,)], "x int").select(
        F.lit("2024-03-31 01:30:00.123456").cast("timestamp").alias("ltz"),
        F.lit("2024-10-27 02:30:00.5").cast("timestamp_ntz").alias("ntz"), F.lit(2.5).alias("d"))
    got = attach_scalars(spark.range(1), df.agg(F.max("ltz").alias("a"), F.max("ntz").alias("b"),
                                                F.max("d").alias("c")))
    row = got.select((F.col("a") == F.lit("2024-03-31 01:30:00.123456").cast("timestamp")).alias("ok_a"),
                     (F.col("b") == F.lit("2024-10-27 02:30:00.5").cast("timestamp_ntz")).alias("ok_b"),
                     F.col("c")).first()
    assert row.ok_a and row.ok_b and row.c == 2.5


def test_counters_with_gaps(spark):
    t0 = dt.datetime(2024, 1, 1)
    mb = 1024 * 1024
    values = [None, 10, 20, None, None, 35, 50, None]
    rows = [(i, t0 + dt.timedelta(seconds=i), v if v is None else v * mb) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "sample_id long, timestamp timestamp_ntz, bytes_recv long")
    for ranges in (1, 2, 3, 7):
        got = W.counter_delta(df, "timestamp", ["bytes_recv"], seq="sample_id", ranges=ranges).orderBy("sample_id")
        assert [r.bytes_recv_delta_mb for r in got.collect()] == [None, 0.0, 10.0, None, None, 15.0, 15.0, None]
    since = W.counter_since_start(df, "timestamp", ["bytes_recv"], seq="sample_id").orderBy("sample_id").collect()
    assert [r.bytes_recv_since_start_mb for r in since] == [None, 0.0, 10.0, None, None, 25.0, 40.0, None]


def test_missing_scores_and_times_come_last(spark):
    from flightlake.operators.aggregates import one_vote
    df = spark.createDataFrame([("a", None, 1), ("a", 2.0, 2), ("b", None, 3), (None, 1.0, 4), (None, None, 0)],
                               "icao24 string, anomaly_score double, x int")
    assert sorted((r.icao24 or "", r.x) for r in W.extreme_per_key(df).collect()) == [("", 4), ("a", 2), ("b", 3)]
    votes = spark.createDataFrame([("a", "bad", "1"), ("a", "100", "2"), ("a", "99", "3"), ("b", "bad", "4")],
                                  "icao24 string, time string, lat string")
    assert sorted((r.icao24, r.lat) for r in one_vote(votes).collect()) == [("a", "3"), ("b", "4")]


def test_first_per_key_shuffles_no_raw_rows(spark):
    """One scan, and below the only exchange a rank limit: a row a key and task."""
    from flightlake.operators.aggregates import first_per_key
    df = spark.range(0, 10_000, 1, 4).selectExpr("id % 7 AS k", "id AS t", "CAST(id AS STRING) AS s")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = first_per_key(df, "k", ["t", "s"])
        plan = first._jdf.queryExecution().sparkPlan().toString()
        assert "Join" not in plan and plan.count("Range (") == 1
        lines = [x.strip(" +-:") for x in first._jdf.queryExecution().executedPlan().toString().split("\n")]
        exchanges = [i for i, x in enumerate(lines) if x.startswith("Exchange")]
        assert len(exchanges) == 1 and lines[exchanges[0] + 1].startswith("WindowGroupLimit") and "Partial" in lines[exchanges[0] + 1]
        assert sorted((r.k, r.t) for r in first.collect()) == [(k, k) for k in range(7)]
        first.foreach(lambda r: None)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_first_per_key_against_a_sort(spark):
    import random
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice([None, 1.0, 2.0, float("nan")]), rng.choice([None, "x", "y"]))
            for _ in range(500)]
    from flightlake.operators.aggregates import first_per_key
    got = first_per_key(spark.createDataFrame(rows, "k string, t double, s string").repartition(7), "k", ["t", "s"]).collect()

    def order(r):
        return (r[1] is None, str(r[1]) == "nan", r[1] or 0, r[2] is None, r[2] or "")
    want = {k: min((r for r in rows if r[0] == k), key=order) for k in {r[0] for r in rows}}
    assert sorted(map(str, ((r.k, r.t, r.s) for r in got))) == sorted(map(str, want.values()))


def test_last_known_value_of_many_and_of_one_hot_series(spark):
    import random
    rng = random.Random(8)
    rows = [(s, i, rng.choice([None, rng.randrange(100)]), rng.choice([None, None, rng.random()]))
            for s, n in (("hot", 600), ("a", 40), (None, 30), ("b", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "series string, i long, c long, d double").repartition(5)
    want, last = [], {}
    for s, i, c, d in rows:
        want.append((s, i, *last.get(s, (None, None))))
        before = last.get(s, (None, None))
        last[s] = (before[0] if c is None else c, before[1] if d is None else d)
    for ranges in (1, 4, 13):
        got = W.last_known_before(df, ["i"], ["c", "d"], ["series"], ranges).select("series", "i", "_prev_c", "_prev_d")
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
        sizes = [r[0] for r in W.last_known_before(df, ["i"], ["c"], ["series"], ranges)
                 .groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert ranges == 1 or max(sizes) < 600  # one hot series, many tasks


def test_scalars_of_runs(spark):
    runs = spark.createDataFrame([(100.0, 2.0, 150.0, 7.0), (90.0, 0.0, 50.0, None), (80.0, None, None, 9.0)],
                                 "n_rows double, duration_sec double, cpu_percent double, disk_mb double")
    r = W.experiment_summary(runs).first()
    assert (r.max_disk_mb, r.peak_throughput, r.avg_cpu_factor) == (9.0, 50.0, 1.0)


def test_exact_quantiles(spark):
    import numpy as np

    from flightlake.operators.aggregates import auto_bins, exact_quantiles, histogram
    rng = np.random.default_rng(2)
    for x in (rng.normal(size=3000), rng.integers(0, 5, 2000).astype(float), np.array([1.0]), np.array([0.0, -1e308, 1e308] * 50),
              np.concatenate([rng.normal(size=1000) * 1e-9 + 1, rng.normal(size=1000) * 1e9])):
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double")
        shares = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
        for bins, small in ((4096, 65_536), (8, 20)):
            got = exact_quantiles(df, "x", shares, bins, small)
            with np.errstate(over="ignore"):
                assert np.allclose(got, np.quantile(x, shares), rtol=1e-12, atol=0) or np.abs(x).max() > 1e300
    x = rng.normal(size=4000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert auto_bins(df, "x") == len(np.histogram_bin_edges(x, "auto")) - 1
    assert [r.n for r in histogram(df, "x", None).collect()] == [n for n in np.histogram(x, "auto")[0].tolist() if n]
    assert auto_bins(df.limit(0), "x") == 1 and auto_bins(spark.createDataFrame([(2.0,)] * 9, "x double"), "x") == 1
