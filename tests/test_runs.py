"""Runs against their manifests; broken parts by name."""

import shutil

import pytest
from pyspark.sql import functions as F

from flightlake.sources import files as S


def _run(spark, tmp_path, n=4000, parts=4):
    df = spark.range(n).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"), (F.col("id") / 7).alias("d"),
                               F.when(F.col("id") % 3 == 0, F.col("id")).alias("maybe"),
                               F.create_map(F.lit("k"), F.col("id")).alias("m")).repartition(parts, "id")
    path = S.write_run(df, str(tmp_path), 1)
    folder = tmp_path / "run_1"
    return df, path, folder, sorted(folder.glob("part-*.parquet"))


def _drop_crc(part):
    crc = part.parent / f".{part.name}.crc"
    if crc.exists():
        crc.unlink()


def _faults(spark, path):
    return {r.path.split("/")[-1]: (r.fault, r.expected, r.decoded) for r in S.corrupt_parts(spark, path).collect()}


def test_sound_run_in_any_layout(spark, tmp_path):
    df, path, _, _ = _run(spark, tmp_path)
    written, read = S.check_run(spark, path)
    assert written == read and read.rows == 4000
    assert S.checksum(df.repartition(7).select(*reversed(df.columns))) == read
    assert S.verify_run(spark, path, ["id"])[0] == 4000
    assert S.read_run(spark, path).count() == 4000 and "_manifest" not in str(S.read_run(spark, path).inputFiles())
    assert _faults(spark, path) == {}


def test_lost_and_doubled_parts_fail(spark, tmp_path):
    _, path, folder, parts = _run(spark, tmp_path)
    shutil.copy(parts[0], folder / "part-copy.parquet")
    with pytest.raises(RuntimeError, match="other rows"):
        S.verify_run(spark, path, ["id"])
    (folder / "part-copy.parquet").unlink()
    S.verify_run(spark, path, ["id"])
    parts[1].unlink()
    _drop_crc(parts[1])
    with pytest.raises(RuntimeError, match="other rows"):
        S.verify_run(spark, path, ["id"])


def test_doubling_two_parts_does_not_cancel_out(spark):
    df = spark.range(50).selectExpr("id", "CAST(id AS STRING) AS s")
    twice = S.checksum(df.union(df))
    assert twice.hash_xor == 0 and twice != S.checksum(df.limit(0))


def test_swapped_columns_and_nulls_show(spark):
    a = spark.createDataFrame([("x", None), ("y", "z")], "p string, q string")
    b = spark.createDataFrame([(None, "x"), ("y", "z")], "p string, q string")
    assert S.checksum(a) != S.checksum(b)


def test_damaged_pages_fail_and_are_named(spark, tmp_path):
    _, path, _, parts = _run(spark, tmp_path, 20_000)
    data = bytearray(parts[2].read_bytes())
    middle = len(data) // 3
    data[middle:middle + 2000] = bytes(b ^ 0x5A for b in data[middle:middle + 2000])
    parts[2].write_bytes(bytes(data))
    _drop_crc(parts[2])
    with pytest.raises(Exception):
        S.verify_run(spark, path, ["id"])
    assert S.read_run(spark, path).count() == 20_000  # footers alone tell of nothing
    found = _faults(spark, path)
    # What the damage breaks is named; damage that still decodes to other values is the checksum's.
    assert set(found) <= {parts[2].name}


def test_half_readable_part_is_named_with_both_counts(spark, tmp_path):
    df = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s")).coalesce(1)
    df.write.option("parquet.block.size", 1 << 20).option("parquet.page.size", 1 << 14).parquet(str(tmp_path / "r"))
    spark.range(0).select("id", F.lit("x").alias("s")).coalesce(1).write.mode("append").parquet(str(tmp_path / "r"))
    part = max((tmp_path / "r").glob("part-*.parquet"), key=lambda p: p.stat().st_size)
    data = bytearray(part.read_bytes())
    at = len(data) * 3 // 4
    data[at:at + 300_000] = b"\0" * 300_000
    part.write_bytes(bytes(data))
    _drop_crc(part)
    report = {r.path.split("/")[-1]: r for r in S.part_report(spark, str(tmp_path / "r")).collect()}
    broken = report.pop(part.name)
    assert broken.fault == "rows" and broken.expected == 60_000 and 0 <= broken.decoded < 60_000
    assert [(r.expected, r.decoded, r.fault) for r in report.values()] == [(0, 0, None)]


def test_part_without_a_footer_is_named(spark, tmp_path):
    _, path, _, parts = _run(spark, tmp_path)
    parts[0].write_bytes(parts[0].read_bytes()[:-30])
    _drop_crc(parts[0])
    assert _faults(spark, path) == {parts[0].name: ("footer", None, 0)}


def test_run_without_a_manifest(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "run_5"))
    assert S.run_manifest(spark, str(tmp_path / "run_5")) is None
    assert S.verify_run(spark, str(tmp_path / "run_5"), ["id"])[0] == 10


def test_empty_run(spark, tmp_path):
    path = S.write_run(spark.range(0), str(tmp_path), 3)
    assert S.run_manifest(spark, path).rows == 0 and S.verify_run(spark, path, ["id"])[0] == 0
