import hashlib

import pytest

from flightlake.llm import decontam, queries
from tests.llm.util import SF001, words


def brute(docs, bench, n=10):
    """{doc number: (n_words, hit words, sorted item ids)} by comparing every window."""
    items = [(str(i) if i is not None else None, words(t)) for i, t in bench]
    out = []
    for _, text in docs:
        w = words(text)
        hit, found = set(), set()
        for name, item in items:
            k = min(n, len(item))
            windows = {tuple(item[i:i + k]) for i in range(len(item) - k + 1)} if k else set()
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit.update(range(i, i + k))
                    found.add(name)
        out.append((len(w), hit, sorted(found - {None})))
    return out


LONG = " ".join(f"w{i}" for i in range(30))
BENCH = [(1, LONG), (2, "one two three"), (3, ""), (4, None), (None, "null id item words"), (5, LONG.upper()),
         (12, "ééé ßß 0 9"), (2, "second row of item two")]
DOCS = [
    (0, "start " + LONG + " end"), (1, "a ONE, two--three! b one two"), (2, None), (3, ""), (4, "... \n\t !!"),
    (5, " ".join(f"w{i}" for i in range(9))), (6, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 x w12 w11"),
    (7, "null id item words"), (8, "x " * 30_000 + LONG + " y" * 30_000), (9, "ééé ßß 0 9"), (9, "ééé ßß 0 9"),
    (None, "one two three one two three"), (11, LONG + " " + LONG), (12, "one two"), (13, "three one two three"),
]


@pytest.mark.parametrize("limit", [decontam.MAX_BROADCAST, 120])
def test_against_brute_force(spark, limit):
    """Both with the benchmark in one broadcast and in several rounds."""
    docs = spark.createDataFrame([(i, t, "n", "s") for i, t in DOCS], "doc_id long, text string, n_hit string, items string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    found = decontam.find_contamination(docs, bench, max_broadcast=limit, spans=True).toPandas()
    got = sorted((str(r.doc_id), str(r.text), r.n_words, r.n_hit, list(r.items)) for r in found.itertuples(index=False))
    want = sorted((str(float(i)) if i is not None else "nan", str(t), n, len(h), ids)
                  for (i, t), (n, h, ids) in zip(DOCS, brute(DOCS, BENCH)))
    assert [(a[1:]) for a in got] == [(a[1:]) for a in want]
    for r in found.itertuples(index=False):
        assert len(words(r.clean_text)) == r.n_words - r.n_hit
        if not r.n_hit:
            assert r.clean_text == r.text or (r.clean_text is None and r.text is None)


def test_spans_cut_only_hits():
    hit = decontam.WindowIndex([(0, "one two three")])
    (_, mask, _), = hit.scan(["A, one TWO three! b"])
    assert decontam.cut_spans("A, one TWO three! b", mask) == "A, ! b"


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontam.find_contamination(docs, none).collect()] == [(1, "a b c", 3, 0, [])]
    assert decontam.find_contamination(docs.limit(0), none).collect() == []


def test_documents_are_removed(spark):
    docs = spark.createDataFrame([(1, "x one two three"), (2, "one two"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert sorted(r.doc_id for r in decontam.remove_contaminated(docs, bench).collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in decontam.remove_contaminated(docs, bench, spans=True).collect()}
    assert cut == {1: "x ", 2: "one two", 3: None}


def test_query_on_small_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = {d[0]: (n, len(h), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), len(h) > 0)
            for d, (n, h, ids) in zip(docs, brute(docs, bench))}
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in queries.op1_decontamination(spark, SF001).collect()}
    assert got == want
    assert any(v[4] for v in got.values())


def test_rounds_are_written(spark):
    """A benchmark of several parts: the last round reads a table and holds one part."""
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    found = decontam.find_contamination(docs, bench, max_broadcast=120)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "FileScan parquet" in plan


def test_index_takes_few_bytes_a_text_byte():
    import random
    import tracemalloc
    rng = random.Random(1)
    items = [(i, " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(400))) for i in range(600)]
    size = sum(len(t) for _, t in items)
    decontam.WindowIndex(items[:2])
    tracemalloc.start()
    index = decontam.WindowIndex(items)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    held -= sum(sieve.nbytes for sieve, *_ in index.by_size.values())  # of a fixed size
    assert held < 10 * size and peak < 20 * size
