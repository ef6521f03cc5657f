import zlib

import numpy as np
import pytest

from flightlake.llm import queries, quality

SF = "/root/testdata/sf0.1"


def test_interactions_by_the_identity():
    rng = np.random.default_rng(0)
    x = rng.random((3, quality.WIDTH)).astype(np.float32) * (rng.random((3, quality.WIDTH)) < 0.005)
    m = quality.Machine(0.3, rng.normal(size=quality.WIDTH), rng.normal(size=(quality.WIDTH, quality.RANK)))
    for row, margin in zip(x, m.margin(x)):
        at = np.flatnonzero(row)
        want = 0.3 + row @ m.w + sum(m.v[i] @ m.v[j] * row[i] * row[j] for a, i in enumerate(at) for j in at[a + 1:])
        assert margin == pytest.approx(want, rel=1e-4)


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op6_quality(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    assert sorted(rows) == sorted(d.doc_id for d in docs)
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [(rows[x.doc_id], x.quality) for x in labels if zlib.crc32(str(x.doc_id).encode()) % 4 == 2]
    assert all(r.held_out for r, _ in held) and len(held) > 500
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
    assert sum(r.predicted == y for r, y in held) / len(held) > 0.98


DOCS = [(1, "a b c", "en"), (2, None, "en"), (3, "", None), (4, "word " * 50_000, "fr"), (5, "a b c", "de"), (5, "a b c", "de"),
        (None, "a b c", "en")]


def test_odd_rows_and_labels(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (None, 1), (3, None)], "doc_id long, quality int")
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == len(DOCS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.text == "a b c"}) == 1
    assert len({r.score for r in rows if not r.text}) == 1
    none = quality.score_quality(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.score_quality(docs.limit(0), labels).collect() == []


def test_scores_do_not_depend_on_labels_of_held_out_ids(spark):
    docs = spark.createDataFrame([(i, "good words here now" if i % 2 else "!!! ### $$$ !!!", "x") for i in range(60)],
                                 "doc_id long, text string, lang string")
    right = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    wrong = spark.createDataFrame([(i, i % 2 if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - i % 2) for i in range(60)],
                                  "doc_id long, quality int")
    a = {r.doc_id: r.score for r in quality.score_quality(docs, right).collect()}
    b = {r.doc_id: r.score for r in quality.score_quality(docs, wrong).collect()}
    assert a == pytest.approx(b)
