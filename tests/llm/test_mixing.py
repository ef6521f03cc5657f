from collections import Counter

import pytest

from flightlake.llm import mixing


def docs_frame(spark):
    rows = [(i, "w " * (1 + i % 50), "hot", 1) for i in range(400)]
    rows += [(1000 + i, "a b c", "small", 1) for i in range(5)]
    rows += [(2000 + i, "x y\tz\n" * 4, None, 1) for i in range(40)]
    rows += [(3000, "", "empty", 1), (3001, None, "empty", 1), (None, "one two", "hot", 1)]
    rows += [(4000, "p q r s", "twin", 1)] * 3 + [(4001 + i, "long " * 300, "twin", 1) for i in range(8)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")


def water_fill(sizes, weights, repeats):
    """Targets by resharing in rounds."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > repeats * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: float(repeats * sizes[s]) for s in over}


def test_targets_and_budgets(spark):
    rows = mixing.mix_sources(docs_frame(spark)).collect()
    assert len(rows) == docs_frame(spark).count()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        assert r.size == len((r.text or "").split())
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    targets = water_fill(dict(sizes), (1, 2, 3), 3)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source], abs=1e-6)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] + 1e-6
    again = mixing.mix_sources(docs_frame(spark).repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_repeats_become_rows(spark):
    mixed = mixing.mix_sources(docs_frame(spark).drop("taken"))
    want = sum(r.taken // r.size for r in mixed.collect() if r.size)
    out = mixing.repeat_taken(mixed)
    assert out.count() == want and out.columns == ["doc_id", "text", "source"]


def test_empty(spark):
    out = mixing.mix_sources(docs_frame(spark).limit(0))
    assert out.collect() == []
    only_empty = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in mixing.mix_sources(only_empty).collect()) == [
        (1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_equal_and_null_ids_come_near_the_target(spark):
    """Rows that nothing tells apart: as many are taken as fit."""
    rows = [(None, "a b c", "a")] * 1000 + [(None, f"x{i} y z", "b") for i in range(700)] + [(7, "p q", "c")] * 900
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    for frame in (df, df.repartition(3)):
        taken, target = Counter(), {}
        for r in mixing.mix_sources(frame).collect():
            taken[r.source] += r.taken
            target[r.source] = r.target
        assert all(abs(taken[s] - target[s]) <= 3 for s in "abc")


def test_ranges_of_any_width_give_the_same_mix(spark):
    key = lambda r: (str(r.doc_id), r.text or "", r.taken)
    want = sorted(map(key, mixing.mix_sources(docs_frame(spark)).collect()))
    assert sorted(map(key, mixing.mix_sources(docs_frame(spark), buckets=3).collect())) == want


def test_words_are_counted_without_holding_them(spark):
    texts = [None, "", " ", "\t\n\x0b\x0c\r ", "a", " a", "a ", "a  b\tc\n", "\u00a0 \u2003x", "x\x00y \x1c", "\U0001f600 $1 \\ x", "w " * 20000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    plan = df.select(mixing.word_count().alias("n"))
    assert "regexp_extract_all" not in plan._jdf.queryExecution().executedPlan().toString()
    got = [r.n for r in df.select("i", mixing.word_count().alias("n")).orderBy("i").collect()]
    assert got == [0, 0, 0, 0, 1, 1, 1, 3, 2, 2, 4, 20000]
    assert got == [r.n or 0 for r in df.selectExpr("i", r"regexp_count(text, r'[^\x20\x09-\x0D]+') n").orderBy("i").collect()]
