import random
import time

import numpy as np
import pyarrow as pa
import pytest

from flightlake.llm import jaccardjoin
from flightlake.session import _CLEANUP
from tests.llm.util import classes

SCHEMA = "doc_id long, text string"


def shingle_set(text):
    w = [x.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})) for x in _split(text or "")]
    n = min(5, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()


def _split(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [x for x in text.split(" ") if x]


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]

    def alike(i, j):
        return bool(sets[i]) and bool(sets[j]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])

    return sorted(((i, len(s), c if s else i) for (i, _), s, c in zip(rows, sets, classes(rows, alike))), key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def edited(rng, words, share):
    return [rng.choice("xyzuvw") + str(rng.randrange(10**6)) if rng.random() < share else w for w in words]


def corpus(seed):
    """Chains of edits, copies, and a passage that many documents hold."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for _ in range(8):
        words = [rng.choice("abcdefgh") + str(rng.randrange(4000)) for _ in range(rng.choice([6, 30, 120, 300]))]
        for _ in range(rng.randrange(1, 12)):
            rows.append(" ".join(words))
            words = edited(rng, words, rng.choice([0.0, 0.01, 0.02, 0.05]))
    for _ in range(25):
        rows.append(" ".join([*passage, *(str(rng.randrange(10**6)) for _ in range(rng.randrange(30)))]))
    rng.shuffle(rows)
    return list(enumerate(rows))


ODD = [(900, None), (901, ""), (902, " \t\n"), (903, "a b"), (904, "A\x0bb"), (905, "a b"), (None, "a b c d e f g"),
       (None, "a b c d e f g"), (907, "A B C D E F G"), (908, "solo"), (908, "x y z"), (908, "X Y Z"), (None, "one"),
       (909, "1 2 3 4 5 " * 2000), (910, "1 2 3 4 5 " * 1999), (901, ""), (911, None)]


@pytest.mark.parametrize("seed,block_rows", [(1, 512), (2, 2)])
def test_against_brute_force(spark, seed, block_rows):
    rows = corpus(seed) + ODD
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", digest string")  # a clashing name
    assert found(jaccardjoin.jaccard_components(df, block_rows=block_rows)) == brute(rows)


def test_common_shingles_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccardjoin, "COMMON", 2)
    rows = corpus(4)
    assert found(jaccardjoin.jaccard_components(spark.createDataFrame(rows, SCHEMA), block_rows=3)) == brute(rows)


def test_shared_counters_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccardjoin, "HELD_SLOTS", 50)
    some = np.random.default_rng(1).integers(0, 256, 1 << (jaccardjoin.SLOT_BITS - 2), dtype=np.uint8)
    count = jaccardjoin.slot_classes
    monkeypatch.setattr(jaccardjoin, "slot_classes", lambda texts: count(texts) | some)
    rows = corpus(5)
    assert found(jaccardjoin.jaccard_components(spark.createDataFrame(rows, SCHEMA), block_rows=3)) == brute(rows)


def test_empty(spark):
    assert jaccardjoin.jaccard_components(spark.createDataFrame([], SCHEMA)).collect() == []
    assert found(jaccardjoin.jaccard_components(spark.createDataFrame([(1, None)], SCHEMA))) == [(1, 0, 1)]


def test_text_ids(spark):
    df = spark.createDataFrame([("b", "x y z"), ("a", "X y z"), ("c", None)], "doc_id string, text string")
    assert found(jaccardjoin.jaccard_components(df)) == [("a", 1, "a"), ("b", 1, "a"), ("c", 0, "c")]


def test_prefixes_hold_a_shared_shingle():
    """The bound behind the join: every linked pair meets in the longer set's
    prefix and the shorter one's short prefix."""
    rng = np.random.default_rng(6)
    some = rng.integers(0, 256, 1 << (jaccardjoin.SLOT_BITS - 2), dtype=np.uint8)
    for _ in range(300):
        s = int(rng.integers(1, 60))
        common = np.sort(rng.integers(0, 1 << 63, s, dtype=np.uint64))
        a = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, int(rng.integers(0, s // 4 + 1)), dtype=np.uint64)]))
        b = common[:max(1, s - int(rng.integers(0, s // 5 + 1)))]
        short, long = sorted((a, b), key=len)
        if 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b)):
            p, lead, _, _ = jaccardjoin.prefix(short, some)
            q, _, _, _ = jaccardjoin.prefix(long, some)
            assert len(np.intersect1d(p[:lead], q))


def test_few_rows_meet_a_large_group_without_its_copies(spark):
    """A column that 300 rows have, 100 of which lie in small blocks of their own:
    the small ones go to the large blocks, and each pair of rows meets once."""
    columns = {0: list(range(300))} | {k: [k, 1000 + k] for k in range(200, 300)}
    members = spark.createDataFrame([(k, x) for k, xs in columns.items() for x in xs], "key long, node long")
    centres = spark.createDataFrame([(k, xs[0], 2000 if k else 1000) for k, xs in columns.items()],
                                    "key long, a long, centre_score long")
    nodes = spark.createDataFrame([(x, 100) for x in sorted({x for xs in columns.values() for x in xs})], "node long, n long")
    found = spark.createDataFrame([], "node long, component long")
    for block_rows in (512, 30):
        rows = jaccardjoin._open_blocks(members, centres, found, nodes, block_rows).collect()
        assert len(rows) < 4000  # above 20,000 if the group went to each of the 100
        sides = {}
        for r in rows:
            sides.setdefault((r.i, r.j), {}).setdefault(r.own, []).append(r.node)
        met = []
        for (i, j), own in sides.items():
            pairs = [(x, y) for x in own[i] for y in own[j]] if i != j else [(x, y) for x in own[i] for y in own[i] if x < y]
            met += [tuple(sorted(p)) for p in pairs]
        assert len(met) == len(set(met))
        assert {(x, y) for xs in columns.values() for x in xs for y in xs if x < y} <= set(met)


def test_tiles_cover_a_product_once(monkeypatch):
    monkeypatch.setattr(jaccardjoin, "TILE_ROWS", 3)

    def block(nodes):
        table = pa.table({"node": nodes, "comp": nodes, "n": [1] * len(nodes), "items": [[5]] * len(nodes)})
        return jaccardjoin.Block(table, "items")

    a, b = block(list(range(8))), block(list(range(10, 17)))
    met = [(x, y) for one, two in jaccardjoin._tile_pairs(a, b) for x in one.node for y in two.node]
    assert sorted(met) == [(x, y) for x in a.node for y in b.node]
    own = [(one.node[x], two.node[y]) for one, two in jaccardjoin._tile_pairs(a, a)
           for x, y in zip(*np.nonzero(jaccardjoin.eligible(one, two)))]
    assert sorted(own) == [(x, y) for x in range(8) for y in range(8) if x < y]
    assert len(jaccardjoin.links(a, a)) == 7  # all are linked; each link joins something new


@pytest.mark.parametrize("few,most", [(0, 0), (2, 3), (1, 1000)])
def test_pairs_and_products_find_the_same(spark, monkeypatch, few, most):
    monkeypatch.setattr(jaccardjoin, "PAIR_ROWS", few)
    monkeypatch.setattr(jaccardjoin, "PAIR_MOST", most)
    rows = corpus(8) + corpus(9)
    rows = [(i, t) for i, (_, t) in enumerate(rows)] + ODD
    assert found(jaccardjoin.jaccard_components(spark.createDataFrame(rows, SCHEMA), block_rows=4)) == brute(rows)


def chance(docs, words, seed=3):
    """Documents without anything in common but a passage of 5 words now and then."""
    rng = random.Random(seed)
    rows = []
    for i in range(docs):
        w = [f"w{rng.randrange(10**8)}" for _ in range(words)]
        for k in range(2):
            at, which = rng.randrange(words - 5), rng.randrange(docs // 3 if k else 9)
            w[at:at + 5] = [f"s{which}{'yx'[k]}{j}" for j in range(5)]
        rows.append((i, " ".join(w)))
    return rows


def shared_by_chance(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    bits = jaccardjoin.slot_classes(docs.select("text"))
    signed = jaccardjoin.sign_documents(docs, "doc_id", "text", spark.sparkContext.broadcast(bits))
    nodes = jaccardjoin.materialise(signed.withColumnRenamed("doc_id", "node"), "nodes")
    none = spark.createDataFrame([], "node long, component long")
    return jaccardjoin._shared_columns(nodes), none, nodes


def test_rows_that_share_little_go_through_no_block(spark):
    """The rows of a column went, with their prefixes, to every block that theirs
    was paired with, also if they share nothing but that column."""
    columns, none, nodes = shared_by_chance(spark, chance(300, 120))
    assert columns.groupBy("key").count().filter("count > 1").count() > 5
    pairing, others = jaccardjoin._open_columns(columns, none, nodes)
    assert others.count() == 0 and pairing.count() > 15
    assert jaccardjoin._likely_pairs(pairing).count() == 0


def test_pairs_within_the_bound_are_kept(spark):
    """Every linked pair is among the pairs, also if it shares columns with many others."""
    rows = [(i, t) for i, (_, t) in enumerate(corpus(10) + corpus(11))]
    columns, none, nodes = shared_by_chance(spark, rows)
    pairing, others = jaccardjoin._open_columns(columns, none, nodes)
    got = {(r.a, r.b) for r in jaccardjoin._likely_pairs(pairing).collect()}
    in_blocks = {}
    for r in columns.join(others, "key", "left_semi").collect():
        in_blocks.setdefault(r.key, set()).add(r.node)
    sets = [shingle_set(t) for _, t in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    assert len(linked) > 20
    assert all(p in got or any(p[0] in s and p[1] in s for s in in_blocks.values()) for p in linked)


@pytest.mark.parametrize("ids,kind", [([1, -7, None], "long"), (["a", "", None], "string"), ([], "long")])
def test_sets_are_made_of_wanted_texts(spark, ids, kind):
    others = [(i if kind == "long" else str(i), f"t{i}") for i in range(100, 400)]
    rows = spark.createDataFrame(others + [(i, "x") for i in ids] * 2, f"doc_id {kind}, text string")
    bits = jaccardjoin.id_bits(spark.createDataFrame([(i,) for i in ids], f"w {kind}"))
    kept = jaccardjoin.whole_sets(rows, "doc_id", "text", spark.sparkContext.broadcast(bits)).collect()
    x = jaccardjoin.shingles("x").view(np.int64).tolist()
    assert sum(r["items"] == x for r in kept) == 2 * len(ids)
    assert len(kept) < 2 * len(ids) + 5  # of the others hardly any


def test_shuffle_files_go_with_their_step(spark, monkeypatch):
    """They stayed until the driver collected its garbage, those of all steps together."""
    def left():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        files = [files.apply(i) for i in range(files.size())]
        return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_")}

    rows = chance(150, 400) + [(500 + i, t) for i, t in chance(40, 400)]
    before, most = set(left()), []
    write = jaccardjoin.materialise

    def watched(df, name):
        out = write(df, name)
        for _ in range(50):  # they are removed in the background
            size = sum(s for f, s in left().items() if f not in before)
            if size < 50_000:
                break
            time.sleep(0.1)
        most.append(size)
        return out

    monkeypatch.setattr(jaccardjoin, "materialise", watched)
    kept = spark.conf.get(_CLEANUP, None)
    assert found(jaccardjoin.jaccard_components(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert len(most) > 10 and max(most) < 50_000
    assert spark.conf.get(_CLEANUP, None) == kept
