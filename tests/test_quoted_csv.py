"""Quoted CSV read by many tasks against the reader that takes a file as one task."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.sources import files as S
from flightlake.sources.quoted_csv import open_after, read_records


def one_task(spark, path, columns):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_over"]])
    df = (spark.read.schema(schema).option("header", True).option("quote", "'").option("escape", "'")
          .option("multiLine", True).csv(path))
    return df.withColumn("_pos", F.monotonically_increasing_id()).filter("_over IS NULL").drop("_over")


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def write(path, seed, n, line_end="\n"):
    rng = random.Random(seed)
    values = ["a", "", "x y", "it's", "'", "''", "a,b", "l1\nl2", "\n", "a\n\n,'b'\n", "é", "long " * 40, "'\n'"]

    def cell():
        v = rng.choice(values)
        if rng.random() < 0.6 or "," in v or "\n" in v or v.startswith("'"):
            return "'" + v.replace("'", "''") + "'"
        return v

    lines = ["k,p,q"]
    for i in range(n):
        width = rng.choice([1, 2, 3, 3, 3, 3, 4, 6])
        lines.append(",".join([str(i), *(cell() for _ in range(width - 1))]))
        if rng.random() < 0.05:
            lines.append("")
    path.write_bytes((line_end.join(lines) + rng.choice(["", line_end])).encode())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_the_one_task_read(spark, tmp_path, small_blocks, seed):
    write(tmp_path / "m.csv", seed, 400)
    got = S.read_aircraft_csv(spark, str(tmp_path / "m.csv"))
    assert rows(got) == rows(one_task(spark, str(tmp_path / "m.csv"), ["k", "p", "q"]))
    assert spark.read.text(str(tmp_path / "m.csv")).rdd.getNumPartitions() > 5


def test_several_files_keep_their_order(spark, tmp_path, small_blocks):
    for i in range(3):
        write(tmp_path / f"m{i}.csv", 10 + i, 50 + 100 * (i == 1))
    got = S.read_aircraft_csv(spark, str(tmp_path)).orderBy("_pos").select("k").collect()
    want = [r.k for i in range(3) for r in one_task(spark, str(tmp_path / f"m{i}.csv"), ["k", "p", "q"]).orderBy("_pos").collect()]
    assert [r.k for r in got] == want


def test_rejected_rows_have_their_place(spark, tmp_path, small_blocks):
    (tmp_path / "m.csv").write_text("k,p\n1,a\n2,'b\nc',x\n3\n4,d,e,f\n'5\n',z\n")
    accepted, rejected = S.split_aircraft_csv(spark, str(tmp_path / "m.csv"))
    assert sorted((r.k, r.p, r._pos) for r in accepted.collect()) == [("1", "a", 0), ("3", None, 2), ("5\n", "z", 4)]
    assert sorted((r.number, r.text, r.reason) for r in rejected.collect()) == [
        (3, "2,'b\nc',x", "too many fields"), (5, "4,d,e,f", "too many fields")]


def test_windows_line_ends_and_byte_order_mark(spark, tmp_path, small_blocks):
    (tmp_path / "m.csv").write_bytes("﻿k,p\r\n1,'a'\r\n\r\n2,b\r\n".encode())
    got = S.read_aircraft_csv(spark, str(tmp_path / "m.csv"))
    assert sorted((r.k, r.p, r._pos) for r in got.collect()) == [("1", "a", 0), ("2", "b", 1)]


def test_quotes_that_stay_open_end_with_the_file(spark, tmp_path, small_blocks):
    (tmp_path / "m.csv").write_text("k,p\n1,'a\n" + "b\n" * 500)
    records = read_records(spark, str(tmp_path / "m.csv"))
    assert [(r.number, len(r.text)) for r in records.orderBy("number").collect()] == [(1, 3), (2, 4 + 2 * 500)]


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "head.csv").write_text("k,p\n")
    assert S.read_aircraft_csv(spark, str(tmp_path / "head.csv")).columns == ["k", "p", "_pos"]
    assert S.read_aircraft_csv(spark, str(tmp_path / "head.csv")).collect() == []


def test_states_of_lines():
    for line, fresh, inside in [("a,b", False, True), ("'a", True, False), ("'a'", False, True), ("'a''", True, True),
                                ("a'b,'c", True, True), ("it's", False, False), ("'a'x,'b", True, True), ("','", False, True)]:
        assert open_after(line, False, "'", ",") is fresh, line
        del inside
