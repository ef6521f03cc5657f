import random
import zlib

import numpy as np
import pytest

from flightlake.llm import toxicity


def brute_kernel(s, t, decay=toxicity.DECAY):
    from itertools import combinations
    def sub(x):
        out = {}
        for i, j, k in combinations(range(len(x)), 3):
            out[x[i], x[j], x[k]] = out.get((x[i], x[j], x[k]), 0.0) + decay ** (k - i + 1)
        return out
    a, b = sub(s), sub(t)
    return sum(v * b.get(g, 0.0) for g, v in a.items())


def test_kernel_against_enumeration():
    marks = ["^idiot", "^worthless", "^banana", "^aaa"]
    strings = ["^idiot", "^idxiot", "^bananas", "^aaaa", "^the", "^ab", "^\u00e9t\u00e9s", "^ttoidi"]
    kernel = toxicity.Kernel(marks)
    got = kernel.against(strings, np.ascontiguousarray(kernel.table.T))
    for i, s in enumerate(strings):
        for j, m in enumerate(marks):
            norm = (brute_kernel(s, s) * brute_kernel(m, m)) ** 0.5
            assert got[i, j] == pytest.approx(brute_kernel(s, m) / norm, abs=1e-5)


def test_units_join_spaced_letters_and_strip_signs():
    assert "idiot" in toxicity.units("you i d i o t there")
    assert toxicity.pieces("(i.d.i.o.t)") == ["^i.d.i.o.t", "^idiot"]
    assert toxicity.pieces("...") == [] and toxicity.pieces("a") == []
    long = "".join(chr(97 + i % 26) for i in range(95))
    cut = toxicity.pieces(long)
    assert {len(p) for p in cut} == {toxicity.WINDOW} and cut[-1] == long[-toxicity.WINDOW:]
    assert all(any(long[i:i + 7] in p for p in cut) for i in range(len(long) - 7))
    assert toxicity.units(None) == [] and toxicity.units("") == []


def corpus(n, seed):
    rng = random.Random(seed)
    syllables = ["the", "an", "er", "tion", "ou", "re", "ed", "nd", "ha", "in", "ea", "st", "ble"]
    bad = ["idiot", "moron", "scum", "worthless", "loser"]
    docs = []
    for i in range(n):
        w = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(5, 120))]
        toxic = int(rng.random() < 0.2)
        for _ in range(rng.randint(1, 3) * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        docs.append((i, " ".join(w), toxic))
    return docs


def test_held_out_accuracy_and_gaps(spark):
    rows = corpus(1500, 1)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, lang string")
    probes = {-1: "the moxron then reed", -2: "ed an i d i o t ou", -3: "w.o.r.t.h.l.e.s.s tionre", -4: "reed then hathe ou",
              -5: "", -6: None, -7: "Lo-ser! thean"}
    docs = docs.union(spark.createDataFrame([(i, t, "x") for i, t in probes.items()], docs.schema))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    held = [(got[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(r.held_out for r, _ in held)
    assert sum(r.predicted == y for r, y in held) / len(held) > 0.98
    assert [got[i].predicted for i in (-1, -2, -3, -4, -5, -6, -7)] == [1, 1, 1, 0, 0, 0, 1]
    assert all(0 <= r.score <= 1 for r in got.values())


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 2), (None, "x " * 40_000, 2), (3, "y" * 50_000, 2), (3, "y" * 50_000, 2)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, None)], "doc_id long, toxic int")
    assert len(toxicity.score_toxicity(docs, labels).collect()) == 4
    assert toxicity.score_toxicity(docs.limit(0), labels.limit(0)).collect() == []


def test_windows_of_short_tokens():
    starts = frozenset(["idio", "wort"])
    assert toxicity.windows("the id iot and wor th less".split(), starts) == ["id iot", "id iot and", "wor th", "wor th less"]
    assert toxicity.windows("id iotic then".split(), starts) == ["id iotic"]
    assert toxicity.windows("id wonderful iot".split(), starts) == [] and toxicity.windows([], starts) == []


def test_insults_that_were_taken_apart():
    rows = corpus(1500, 1)
    model = toxicity.fit([t for _, t, _ in rows], np.array([y for _, _, y in rows], dtype=float))
    split = ["the id iot tionre", "ed wor th less ou", "re mo ron hathe", "the lo ser ed", "the idiot then"]
    assert (model.scores(split) >= 0.7).all()
    assert (model.scores(["reed then hathe ou", "thean ed the an er re", "id the an iot", "", None]) < 0.7).all()
    again = toxicity.Model.from_bytes(model.to_bytes())
    assert np.allclose(again.scores(split), model.scores(split))


def test_text_without_blanks():
    def unspaced(n, seed):
        rng = random.Random(seed)
        syllables = ["the", "an", "er", "tion", "ou", "re", "ed", "nd", "ha", "in", "ea", "st", "ble"]
        out = []
        for _ in range(n):
            text, toxic = "".join(rng.choices(syllables, k=40)), rng.random() < 0.2
            at = rng.randint(24, 30)
            out.append((text[:at] + rng.choice(["idiot", "moron", "scum", "worthless", "loser"]) + text[at:] if toxic else text, toxic))
        return out

    rows, held = unspaced(900, 3), unspaced(300, 4)
    model = toxicity.fit([t for t, _ in rows], np.array([y for _, y in rows], dtype=float))
    found = model.scores([t for t, _ in held]) >= 0.7
    toxic = np.array([y for _, y in held])
    assert found[toxic].mean() >= 0.9 and found[~toxic].mean() <= 0.02


def test_large_alphabets_make_small_models():
    rng = random.Random(5)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    bad = ["".join(rng.choices(letters, k=4)) for _ in range(4)]
    rows = []
    for i in range(400):
        w = ["".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(20)]
        rows.append((" ".join(w + [rng.choice(bad)] if i % 4 == 0 else w), float(i % 4 == 0)))
    model = toxicity.fit([t for t, _ in rows], np.array([y for _, y in rows]))
    assert len(model.to_bytes()) < 20 << 20
    assert (model.scores([f"{letters[0]}{letters[1]} {b}" for b in bad]) >= 0.7).all()


def test_query_on_whole_tables(spark):
    from flightlake.llm import queries
    from tests.llm.util import SF01
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = queries.op3_toxicity(spark, SF01).collect()
    assert len(rows) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    held = [(r, labels[r.doc_id]) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and r.doc_id in labels]
    assert all(r.held_out and r.predicted == int(r.score >= 0.7) for r, _ in held)
    # Of the toxic ones some hold no insult, or one of a language with a handful of examples.
    assert sum(r.predicted for r, y in held if y) >= 0.7 * sum(y for _, y in held)
    assert sum(r.predicted for r, y in held if not y) <= 0.02 * len(held)
