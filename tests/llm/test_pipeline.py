"""The pipeline's stages, each held against what it must keep of its own input."""

from collections import Counter

import corpus_pipeline
from tests.llm.util import SF01, bag, classes, jaccard, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    inputs = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}

    good = corpus_pipeline.keep_good(spark, docs, SF01)
    assert good.columns == COLUMNS
    kept = {r.doc_id: r for r in good.collect()}
    assert all(inputs[i] == r for i, r in kept.items())
    judged = [(i in kept) == (q == 1) for i, q in labels.items()]
    assert sum(judged) / len(judged) > 0.97

    unique = corpus_pipeline.drop_copies(spark, good, SF01)
    assert unique.columns == COLUMNS
    rows = [(r.doc_id, r.text) for r in kept.values()]
    bags = [bag(t) for _, t in rows]
    sizes = [sum(b.values()) for b in bags]
    near = classes(rows, lambda i, j: min(sizes[i], sizes[j]) >= 0.8 * max(sizes[i], sizes[j]) - 1e-9
                   and jaccard(bags[i], bags[j]) >= 0.8)
    ids = {r.doc_id for r in unique.collect()}
    assert ids == set(near) and len(ids) < len(rows)

    clean = corpus_pipeline.decontaminate(spark, unique, SF01)
    assert clean.columns == COLUMNS
    windows = set()
    for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(10, len(w))
        windows |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
    holds = {i for i in ids for w in [words(inputs[i].text)]
             if any(tuple(w[k:k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))}
    assert {r.doc_id for r in clean.collect()} == ids - holds and holds

    mixed = corpus_pipeline.mix(spark, clean, SF01)
    assert mixed.columns == COLUMNS
    times = Counter(r.doc_id for r in mixed.collect())
    assert max(times.values()) <= 3 and set(times) <= ids - holds
    taken, total = Counter(), 0
    for i in ids - holds:
        size = len(inputs[i].text.split())
        total += size
        taken[inputs[i].source] += size * times[i]
    sources = sorted(taken)
    weight = {s: 1 + k % 3 for k, s in enumerate(sources)}
    assert abs(sum(taken.values()) - total) < 0.1 * total
    assert sum(taken[s] for s in sources if weight[s] == 3) > 1.5 * sum(taken[s] for s in sources if weight[s] == 1)

    sharded = corpus_pipeline.shard(spark, mixed, SF01).collect()
    assert Counter(r.doc_id for r in sharded) == times
    assert {r.shard for r in sharded} <= set(range(40))


def test_run_is_the_stages_and_reruns_agree(spark):
    sf = "/root/testdata/sf0.001"
    a = corpus_pipeline.run(spark, sf)
    assert a.columns == COLUMNS + ["shard", "slot"]
    key = lambda r: (r.shard, r.slot, r.doc_id)
    rows = sorted(map(key, a.collect()))
    assert rows and rows == sorted(map(key, corpus_pipeline.run(spark, sf).collect()))
