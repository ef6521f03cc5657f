import gzip
import io
import json
import tarfile

import pytest

from flightlake.operators.ingest import accept_members, archive_faults, clean_aircraft, clean_states
from flightlake.sources import files as S
from flightlake.sources.archives import write_state_archives
from flightlake.sources.tarstates import read_archive_members, register

HEADER = "time,icao24,lat,lon,velocity,heading,vertrate,callsign,onground,alert,spi,squawk,baroaltitude,geoaltitude,lastposupdate,lastcontact"


def row(t, icao="abc123", v="100.0"):
    return f"{t},{icao},50.1,8.6,{v},90,0,DLH1,False,False,False,1000,3000,3050,{t},{t}"


def make_tar(path, members, truncate=None):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as tar:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    raw = buf.getvalue()
    path.write_bytes(raw[:truncate] if truncate else raw)
    return str(path)


def gz(lines):
    return gzip.compress(("\n".join(lines) + "\n").encode())


def test_good_ragged_and_bad_bytes(spark, tmp_path):
    register(spark)
    good = make_tar(tmp_path / "good.tar", [("a.csv.gz", gz([HEADER, row(1), row(2), row(3)])),
                                            ("b.csv.gz", gz([HEADER, row(4), row(5), row(6)]))])
    ragged_lines = [",".join(["1"] * 9), ",".join(["2"] * 10), ",".join(["3"] * 15), row(4), row(5) + ",x", "",
                    "T9," + row(9).split(",", 1)[1]]
    ragged = make_tar(tmp_path / "ragged.tar", [("r.csv", "\n".join(ragged_lines).encode())])
    badb = make_tar(tmp_path / "bad.tar", [("e.csv", row(11).encode() + b"\xff\xfe" + b"\n")])
    lines = spark.read.format("tarstates").load(",".join([good, ragged, badb]))
    assert lines.rdd.getNumPartitions() == 3          # one task per archive
    by = {r.archive.split("/")[-1]: r.n for r in lines.groupBy("archive").count().withColumnRenamed("count", "n").collect()}
    assert by["good.tar"] == 8 and by["ragged.tar"] == 7
    lenient = accept_members(lines, "lenient", keep=["archive"])
    lr = [r for r in lenient.collect() if r.archive.endswith("ragged.tar")]
    assert sorted(r.time for r in lr) == ["2", "3", "4", "5"]          # >= 10 fields, numeric time
    assert all(r.lastcontact is not None for r in lr)                   # padded with ''
    strict = accept_members(lines, "strict", keep=["archive"])
    sr = sorted(r.time for r in strict.collect() if r.archive.endswith("ragged.tar"))
    assert sr == ["4", "T9"]
    bad = [r for r in clean_states(lenient).collect() if r.archive.endswith("bad.tar")]
    assert len(bad) == 1 and bad[0].lastcontact == "11"                  # invalid bytes dropped


def test_aircraft_csv(spark, tmp_path):
    p = tmp_path / "aircraft-database-complete-2024-05.csv"
    p.write_text("icao24,manufacturerName,model,typecode,categoryDescription,operator,extra\n"
                 "'abc','Air, Inc','A''1','T1','','Op',x\n"
                 "short,M\n"
                 "toolong,a,b,c,d,e,f,g\n"
                 "abc,Dup,B,T,,Op2,y\n"
                 "ABC,Case,C,T,,Op3,z\n")
    raw = S.read_aircraft_csv(spark, str(p))
    got = {r.icao24: r for r in clean_aircraft(raw, order_col="_pos").collect()}
    assert set(got) == {"abc", "short", "ABC"}
    assert got["abc"].manufacturerName == "Air, Inc" and got["abc"].model == "A'1"
    assert got["short"].model is None
    norm = clean_aircraft(raw, order_col="_pos", normalise_key=True).collect()
    assert sorted(r.icao24 for r in norm) == ["abc", "short"]
    files = S.list_files(spark, str(tmp_path), glob="*.csv")
    (tmp_path / "aircraft-database-complete-2023-11.csv").write_text("icao24\n")
    assert S.resolve_master(S.list_files(spark, str(tmp_path), glob="*.csv")).first().version == "2024-05"
    assert files.count() == 1


def test_metric_log_telemetry_runs(spark, tmp_path):
    recs = [{"timestamp": 1.0, "iso_date": "x", "stage": "P", "metric": "Duration", "value": 4.0, "unit": "s", "remarks": ""},
            {"timestamp": 2.0, "iso_date": "x", "stage": "P", "metric": "RowCount", "value": 8.0, "unit": "", "remarks": ""}]
    (tmp_path / "log.json").write_text(json.dumps(recs, indent=4))
    (tmp_path / "log.jsonl").write_text("\n".join(json.dumps(r) for r in recs) + "\n{broken\n")
    assert S.read_metric_log(spark, str(tmp_path / "log.json")).count() == 2
    assert S.read_metric_log(spark, str(tmp_path / "log.jsonl"), array=False).count() == 2
    (tmp_path / "m.csv").write_text("timestamp,stage,cpu_percent,ram_percent,ram_gb,net_sent_mb,net_recv_mb\n"
                                    "2024-01-01T10:00:00.5,Init,1,2,3,0,0.5\n")
    t = S.read_telemetry(spark, str(tmp_path / "m.csv")).first()
    assert t.stage == "Init" and t.net_recv_mb == 0.5 and t.timestamp.microsecond == 500000
    df = spark.range(5)
    S.write_run(df, str(tmp_path / "processed"), 100)
    S.write_run(df.limit(2), str(tmp_path / "processed"), 200)
    S.write_once(df, str(tmp_path / "processed" / "run_200"))        # exists: untouched
    latest = S.latest_run(S.list_files(spark, str(tmp_path / "processed"), glob="*.parquet")).first()
    assert latest.epoch == 200
    n, preview = S.verify_run(spark, latest.run_dir, cols=["id"])
    assert n == 2 and preview.count() == 2
    S.run_noop(df)


def test_line_counts_bench_history_and_ingest_job(spark, tmp_path):
    from flightlake.plans.jobs import ingest_states
    (tmp_path / "a.csv.gz").write_bytes(gz([HEADER, row(1), row(2)]))
    (tmp_path / "b.csv").write_text("x\ny\nz\nw\n")
    counts = {r.path.split("/")[-1]: r.n_lines for r in S.line_counts(spark, str(tmp_path)).collect()}
    assert counts == {"a.csv.gz": 3, "b.csv": 4}
    (tmp_path / "h.csv").write_text("files_count,duration_sec,avg_cpu,avg_ram,net_mb,disk_mb\n5,10,1,2,3,4\n5,12,1,2,3,4\n1,2,1,2,3,4\n")
    h = S.read_bench_history(spark, str(tmp_path / "h.csv"))
    from flightlake.operators.windows import bench_summary
    assert [(r.files_count, r.duration_sec) for r in bench_summary(h).collect()] == [(1, 2.0), (5, 12.0)]
    tar = make_tar(tmp_path / "s.tar", [("m.csv.gz", gz([HEADER, row(1), row(2), row(3, v="")]))])
    out = ingest_states(spark, [tar], str(tmp_path / "runs"), 7)
    assert out.endswith("run_7") and spark.read.parquet(out).count() == 2
    assert ingest_states(spark, [], str(tmp_path / "runs"), 8) is None


def broken_archives(tmp_path):
    """Every kind of break between good members, and what must come back."""
    body = "\n".join(row(i) for i in range(400))
    good = [("m1.csv.gz", gz([row(i) for i in range(5)])), ("m3.csv.gz", gz([row(i) for i in range(7)]))]
    cut = gzip.compress(body.encode())
    cases = {
        "badgzip": [good[0], ("m2.csv.gz", b"no gzip at all"), good[1]],
        "cutgzip": [good[0], ("m2.csv.gz", cut[:len(cut) // 2]), good[1]],
        "badavro": [good[0], ("m2.avro", b"Obj\x01garbage"), good[1]],
    }
    paths = [make_tar(tmp_path / f"{n}.tar", m) for n, m in cases.items()]
    # the archive itself ends inside its last member, or inside a header
    paths.append(make_tar(tmp_path / "endsdata.tar", [*good, ("z.csv", body.encode())], truncate=512 * 6 + 5000))
    paths.append(make_tar(tmp_path / "endshead.tar", [*good, ("z.csv", b"x")], truncate=512 * 4 + 100))
    return paths


def test_breaks_are_the_same_on_every_path(spark, tmp_path):
    register(spark)
    paths = broken_archives(tmp_path)
    joined = ",".join(paths)
    key = lambda r: tuple(str(x) for x in r)
    whole = sorted(spark.read.format("tarstates").option("splitMembers", "false").load(joined).collect(), key=key)
    split = sorted(spark.read.format("tarstates").option("partitionBytes", 100).load(joined).collect(), key=key)
    listed = read_archive_members(spark.createDataFrame([(p,) for p in paths], "path string"), target_bytes=100)
    assert whole == split == sorted(listed.collect(), key=key)
    faults = {(r.archive.split("/")[-1][:-4], r.member) for r in archive_faults(listed).collect()}
    assert faults >= {("badgzip", "m2.csv.gz"), ("cutgzip", "m2.csv.gz"), ("badavro", "m2.avro"), ("endsdata", "z.csv")}
    for name in ("badgzip", "cutgzip", "badavro", "endsdata", "endshead"):
        lines = [r for r in whole if r.archive.endswith(f"/{name}.tar") and r.line is not None]
        assert sum(r.member == "m1.csv.gz" for r in lines) == 5 and sum(r.member == "m3.csv.gz" for r in lines) == 7
    cut = [r.line for r in whole if r.archive.endswith("cutgzip.tar") and r.member == "m2.csv.gz" and r.line is not None]
    assert cut == [row(i) for i in range(len(cut))] or sorted(cut) == sorted(row(i) for i in range(len(cut)))


def test_broken_headers_are_faults(spark, tmp_path):
    register(spark)
    members = [(f"m{i}.csv", f"{i}\n".encode()) for i in range(3)]
    whole = make_tar(tmp_path / "whole.tar", members)
    data = open(whole, "rb").read()
    paths = [whole]
    for name, broken in {"endshead": data[:512 * 4 + 100],                          # cut inside the third header
                         "badsum": data[:1024 + 148] + b"9" + data[1024 + 149:],   # wrong checksum in the second
                         "noend": data[:512 * 6]}.items():                          # all members, no zero blocks
        (tmp_path / f"{name}.tar").write_bytes(broken)
        paths.append(str(tmp_path / f"{name}.tar"))
    listed = read_archive_members(spark.createDataFrame([(p,) for p in paths], "path string"))
    loaded = spark.read.format("tarstates").option("partitionBytes", 1).load(",".join(paths))
    for rows in (listed.collect(), loaded.collect()):
        name = lambda r: r.archive.split("/")[-1][:-4]
        assert sorted(name(r) for r in rows if r.fault is not None) == ["badsum", "endshead"]
        assert sorted((name(r), r.line) for r in rows if r.line is not None) == [
            ("badsum", "0"), ("endshead", "0"), ("endshead", "1"), ("noend", "0"), ("noend", "1"), ("noend", "2"),
            ("whole", "0"), ("whole", "1"), ("whole", "2")]


def test_a_missing_archive_fails_the_read(spark, tmp_path):
    paths = spark.createDataFrame([(str(tmp_path / "none.tar"),)], "path string")
    with pytest.raises(Exception, match="none.tar"):
        read_archive_members(paths).collect()


def test_uri_archives_are_split(spark, tmp_path):
    register(spark)
    tar = make_tar(tmp_path / "big.tar", [(f"m{i}.csv.gz", gz([row(i * 100 + j) for j in range(50)])) for i in range(8)])
    split = spark.read.format("tarstates").option("partitionBytes", 600).load(f"file://{tar}")
    assert split.rdd.getNumPartitions() >= 4 and split.count() == 400
    many = [make_tar(tmp_path / f"t{i}.tar", [("a.csv", b"x\n" * 10)] * 9) for i in range(8)]
    spread = read_archive_members(spark.createDataFrame([(f"file://{p}",) for p in many], "path string"))
    assert spread.rdd.getNumPartitions() >= 8 and spread.count() == 8 * 9 * 10


def test_archives_roll_by_size(spark, tmp_path):
    df = spark.range(4000).selectExpr("CAST(id AS STRING) AS time", "'abc' AS icao24")
    paths = write_state_archives(df, root=str(tmp_path / "out"), num_archives=2, max_bytes=4000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")
    try:
        found = sorted(r.path for r in paths.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) > 4
    lines = read_archive_members(spark.createDataFrame([(p,) for p in found], "path string"))
    assert lines.filter("line NOT LIKE 'time%'").count() == 4000


def test_truncated_part_fails_the_check(spark, tmp_path):
    run = S.write_run(spark.range(100).repartition(4), str(tmp_path), 1)
    part = sorted((tmp_path / "run_1").glob("part-*.parquet"))[1]
    lost = spark.read.parquet(str(part)).count()
    part.write_bytes(part.read_bytes()[:-20])
    (tmp_path / "run_1" / f".{part.name}.crc").unlink()
    with pytest.raises(Exception):
        S.verify_run(spark, run, cols=["id"])
    assert S.read_run(spark, run, skip_corrupt=True).count() == 100 - lost
    assert [r.path.split("/")[-1] for r in S.corrupt_parts(spark, run).collect()] == [part.name]


def test_record_order_over_files_packed_by_size(spark, tmp_path):
    folder = tmp_path / "h"
    folder.mkdir()
    head = "files_count,duration_sec,avg_cpu,avg_ram,net_mb,disk_mb\n"
    for i in range(6):  # later files are larger, so splits are not packed in their order
        (folder / f"h{i}.csv").write_text(head + f"5,{i},1,2,3,4\n" * (1 + 40 * i))
    h = S.read_bench_history(spark, str(folder))
    from flightlake.operators.windows import bench_summary
    assert bench_summary(h).first().duration_sec == 5.0


def test_archive_split_by_members(spark, tmp_path):
    register(spark)
    members = [(f"m{i}.csv.gz", gz([HEADER] + [row(i * 100 + j) for j in range(50)])) for i in range(5)]
    members.append(("plain_states.csv", "\n".join(row(900 + j) for j in range(7)).encode()))
    tar = make_tar(tmp_path / "big.tar", members)
    split = spark.read.format("tarstates").option("partitionBytes", 600).load(tar)
    whole = spark.read.format("tarstates").option("splitMembers", "false").load(tar)
    assert split.rdd.getNumPartitions() >= 5 and whole.rdd.getNumPartitions() == 1
    key = lambda r: (str(r.member), str(r.line))
    assert sorted(split.collect(), key=key) == sorted(whole.collect(), key=key)
    assert split.count() == 5 * 51 + 7


def test_first_archives_lists_few_folders(spark, tmp_path):
    for day in range(1, 29):
        for hour in range(6):
            folder = tmp_path / "states" / f"2024-02-{day:02d}" / f"{hour:02d}"
            folder.mkdir(parents=True)
            (folder / f"s{hour}.tar").write_text("x")
            (folder / "s.txt").write_text("x")
    (tmp_path / "states" / ".hidden").mkdir()
    (tmp_path / "states" / ".hidden" / "2024-01-01.tar").write_text("x")
    (tmp_path / "states-2020-01").mkdir()
    (tmp_path / "states-2020-01" / "z.tar").write_text("x")
    listing = S.list_files(spark, str(tmp_path))
    for n, prefixes in ((5, None), (8, ["states/", "states-"]), (3, ["states/2024-02-2", "nothing/", "states/"]), (500, None)):
        found, listed = S.first_archives(spark, str(tmp_path), n, prefixes=prefixes)
        full = None if prefixes is None else [f"file:{tmp_path}/{p}" for p in prefixes]
        want = S.select_archives(listing, n, prefixes=full, path_col="path")
        got = [(r.prefix_rank, r.path) for r in found.collect()]
        assert got == [(r.prefix_rank, r.path) for r in want.collect()] and len(got) == min(n, 168)
        assert n == 500 or listed <= n + 6


def test_rows_of_archives_are_kept_or_sorted_out(spark, tmp_path):
    from flightlake.plans import jobs
    members = [("a.csv.gz", gz([HEADER, row(1), "short,line", row(2).replace("2", "x", 1), ""])),
               ("b.csv.gz", gz([row(5)] * 50)[:60]), ("states.csv", row(7).encode())]
    tar = make_tar(tmp_path / "x.tar", members)
    paths = spark.createDataFrame([(tar,)], "path string")
    done = jobs.ingest_with_rejects(spark, paths, str(tmp_path / "runs"), str(tmp_path / "rejects"), 1)
    left = S.read_run(spark, done.rejects).collect()
    whole = {(r.member, r.position): r.reason for r in left if r.reason != "fault"}
    assert whole.items() >= {("a.csv.gz", 1): "time", ("a.csv.gz", 3): "fields"}.items()
    assert [(r.member, r.position) for r in left if r.reason == "fault"] == [("b.csv.gz", None)]
    assert done.accepted == S.read_run(spark, done.run).count() and done.rejected == len(left)
    assert done.accepted == accepted_count(spark, paths)


def accepted_count(spark, paths):
    from flightlake.operators.ingest import accept_members, clean_states
    from flightlake.sources.tarstates import read_archive_members
    return clean_states(accept_members(read_archive_members(paths))).count()


def test_broken_lines_of_a_metric_log_are_kept_apart(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"metric": "Duration", "value": 4.0}\n{broken\n{"metric": "RowCount", "value": "x"}\n')
    accepted, rejected = S.split_metric_log(spark, str(tmp_path / "log.jsonl"), array=False)
    assert [r.metric for r in accepted.collect()] == ["Duration"]
    assert sorted(r.text for r in rejected.collect()) == ['{"metric": "RowCount", "value": "x"}', "{broken"]
