import random
import zlib

from pyspark.sql import functions as F

from flightlake.llm import queries, sharding
from tests.llm.util import SF01


def check(rows, shards, limit):
    """Gapless slots, sizes within the largest row of the target, contiguous order."""
    total = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for s, members in by.items():
        assert 0 <= s < shards
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
        assert abs(sum(r["size"] for r in members) - total / shards) <= limit


def test_query_law(spark):
    rows = queries.op2_sharding(spark, SF01).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "bytes", None)
    check(rows, 40, max(r["size"] for r in rows))
    again = {(r.doc_id, r.shard, r.slot) for r in queries.op2_sharding(spark, SF01).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}
    homes = {}
    for r in rows:
        homes.setdefault(docs[r.doc_id], set()).add(r.shard)
    largest = max(r["size"] for r in rows)
    sizes = {t: sum(r["size"] for r in rows if docs[r.doc_id] == t) for t, h in homes.items() if len(h) > 1}
    assert all(v > largest for v in sizes.values())


def test_contiguous_by_id_with_hot_text_nulls_and_ties(spark):
    rng = random.Random(3)
    rows = [(i, "hot text " * 5 if i % 3 == 0 else "t" * rng.randint(0, 200), "x", 5) for i in range(600)]
    rows += [(None, None, "x", 5), (None, "", "x", 5), (7, "dup", "x", 5), (7, "dup", "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int").withColumn(
        "size", sharding.text_bytes())
    out = sharding.shard_documents(docs, 8, size=F.col("size")).collect()
    assert len(out) == len(rows)
    check(out, 8, max(r["size"] for r in out))
    order = sorted(out, key=lambda r: (r.shard, r.slot))
    ids = [-1 if r.doc_id is None else r.doc_id for r in order]
    assert ids == sorted(ids)
    grouped = sharding.shard_documents(docs, 8, size=F.col("size"), group=F.md5("text")).collect()
    check(grouped, 8, max(r["size"] for r in grouped))


def test_few_rows_and_none(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in sharding.shard_documents(docs, 40).collect()) == [1, 2]
    empty = sharding.shard_documents(docs.limit(0), 40)
    assert empty.collect() == [] and empty.columns == ["doc_id", "text", "shard", "slot"]
