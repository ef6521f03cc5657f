import hashlib

from pyspark.sql import functions as F

from flightlake.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The contract's columns by conversation, in plain Python."""
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda r: tuple((x is not None, x) for x in r[1:]))
        enc = lambda t: (t or "").replace("\\", "\\s").replace("<turn>", "\\o").replace("</turn>", "\\c")
        pieces = ["<turn>" + enc(r).replace("\n", "\\n") + "\n" + enc(t) + "</turn>\n" for _, _, r, t in turns]
        loss = "".join(t or "" for _, _, r, t in turns if r == "assistant")
        ends = [i for i, t in enumerate(turns) if t[2] == "assistant" or i == len(turns) - 1]
        whole = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha(whole), len(loss), sha(loss), sum(len("".join(pieces[:i + 1])) for i in ends))
    return out


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello \\s <turn>x</turn> \\"), (1, 2, "user", "bye"),
    (2, 5, "system", None), (2, 9, "user", ""), (2, 9, "user", ""), (2, None, "user", "first"),
    (3, 0, "assistant", "</turn>\n<turn>assistant\nfake"), (3, 1, "assistant", ""), (3, 2, "assistant", None),
    (4, 0, None, "no role"), (4, 1, "as\nsist<turn>", "t\n\n"), (None, 0, "user", "a"), (None, 1, "assistant", "\u00e9\U0001f600b"),
    (5, 7, "assistant", "tie"), (5, 7, "assistant", "tie"), (5, 7, "user", "tie"),
] + [(6, i, "assistant" if i % 2 else "user", f"turn {i} " + "<turn>" * (i % 3)) for i in range(0, 1500, 7)]


def test_against_brute_force(spark):
    turns = spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA + ", formatted string")
    got = {r.conv_id: tuple(r)[1:] for r in chat.digest_examples(chat.expand_prefix_targets(turns)).collect()}
    assert got == brute(ROWS)


def test_examples_hold_context_and_mask(spark):
    turns = spark.createDataFrame(ROWS, SCHEMA)
    examples = chat.expand_prefix_targets(turns, block=2).collect()
    assert len([e for e in examples if e.trainable]) == len([r for r in ROWS if r[2] == "assistant"])
    one = sorted((e for e in examples if e.conv_id == 1), key=lambda e: len(e.formatted))
    assert [e.trainable for e in one] == [True, False] and [e.complete for e in one] == [False, True]
    assert one[0].formatted.startswith("<turn>user\nhi</turn>\n<turn>assistant\n")
    assert one[0].formatted[one[0].loss_start:one[0].loss_end] == "hello \\ss \\ox\\c \\s"
    assert one[1].loss_start == one[1].loss_end == 0 and one[1].formatted.startswith(one[0].formatted)
    assert all(sum(e.complete for e in examples if e.conv_id == c) == 1 for c in {r[0] for r in ROWS})


def test_block_size_changes_nothing(spark):
    turns = spark.createDataFrame(ROWS, SCHEMA)
    sets = [sorted(map(str, chat.expand_prefix_targets(turns, block=b).collect())) for b in (1, 3, 64, 10**6)]
    assert sets[0] == sets[1] == sets[2] == sets[3]


def _escapes(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"),
                       chat.unescape_role(chat.escape_role(F.col("t"))).alias("r")).collect():
        assert r.u == r.t == r.r and "<turn>" not in r.e and "</turn>" not in r.e


def test_escapes_are_reversible(spark):
    import random
    rng = random.Random(1)
    parts = ["\\", "s", "o", "c", "<turn>", "</turn>", "<", "turn>", "/", "\n", " ", "\u00e9", "\\s", "\\o", "\\c", "\\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    _escapes(spark, texts)


def test_query_holds_the_probe(spark):
    rows = {r.conv_id: r for r in queries.op9_chat_formatting(spark, "/root/testdata/sf0.001").collect()}
    want = brute([(-7, 0, "user", queries.CHAT_PROBE), (-7, 1, "assistant", queries.CHAT_PROBE)])[-7]
    assert tuple(rows[-7])[1:] == want


def test_empty(spark):
    assert chat.digest_examples(chat.expand_prefix_targets(spark.createDataFrame([], SCHEMA))).collect() == []
