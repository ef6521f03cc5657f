import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from flightlake.llm import trie
from flightlake.llm.running import running

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built = turns.get(c - int(np.fmod(c, 5)), [])[:h] + mine[h:]
        for d in range(len(built) + 1):
            members[tuple(built[:d])].append((c, d == len(built)))
    out = []
    for path, held in members.items():
        below = [p for p in members if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c, e in sorted(held) if e)
        out.append((min(held)[0], len(path), min(members[path[:-1]])[0] if path else None, len(held), len(children),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def talk(seed, convs, longest=12, words="ab"):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(words)) for t in range(rng.randrange(1, longest))]
    return rows


ODD = [(40, None, "user", "x"), (40, None, None, None), (40, 3, "user", None), (40, 3, "user", None), (None, 0, "user", "a"),
       (41, 1, "", "é" * 3000), (-7, 0, "user", "a"), (-5, 0, "user", "a"), (-5, 1, "user", "b"), (-3, 1, "user", "a"),
       (3, 1, "user", "a"), (1 << 40, 0, "user", "a")]


@pytest.mark.parametrize("local_nodes", [trie.LOCAL_NODES, 6])
def test_against_brute_force(spark, local_nodes):
    rows = talk(1, range(60)) + ODD + [(200, t, "user", str(t % 3)) for t in range(90)]  # a long one
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", depth string")  # a clashing name
    assert found(trie.conversation_trie(df, local_nodes)) == brute(rows)


def test_hot_prefix_and_copies(spark):
    rows = [(c, t, "user", "same" if t < 5 else str(c)) for c in range(300, 360) for t in range(7 if c % 3 else 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(trie.conversation_trie(df, 20)) == brute(rows)


def test_no_conversations(spark):
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)).collect() == []


def test_digest_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 7)
    rows = [(c, 0, "user", "same") for c in range(0, 500, 5)]
    assert found(trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_split_components_sums_subtrees():
    rng = np.random.default_rng(4)
    for n in (1, 2, 40, 400):
        parent = np.array([-1] + [int(rng.integers(max(0, i - 4), i)) for i in range(1, n)])
        values = rng.integers(0, 50, (n, 2))
        want, weight = values.copy(), np.ones(n, dtype=np.int64)
        for i in range(n - 1, 0, -1):
            want[parent[i]] += want[i]
            weight[parent[i]] += weight[i]
        assert (trie.split_components(np.zeros(n, dtype=np.int64), parent, weight, values) == want).all()


def test_running_over_partitions(spark):
    rng = random.Random(5)
    rows = [(k, i, rng.getrandbits(62)) for k, n in ((1, 3), (2, 400), (3, 1), (4, 50)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, i long, x long").repartition(9)
    want, state = [], {}
    for k, i, x in rows:
        n, y = state.get(k, (0, 0))
        state[k] = (n + 1, y ^ x)
        want.append((k, i, *state[k]))
    got = running(df, ["k"], [df["i"]], [df["i"]], ["x"]).select("k", "i", "nth", "x").collect()
    assert sorted(map(tuple, got)) == sorted(want)
