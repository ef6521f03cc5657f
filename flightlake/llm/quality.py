"""Quality classifier: a factorisation machine over whole texts.

A text becomes hashed word counts, structure statistics and its length (each
statistic as a value and as an indicator of its range). The machine adds a
low-rank interaction of every pair of features; scoring is linear in the
features by the identity  sum_{i<j} <v_i, v_j> x_i x_j
= 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Features of the labelled sample are made by all tasks; one task fits the model
on that sample, whose bound is a parameter; scoring is one pass over all texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.common import held_out, without, words
from flightlake.llm.decontam import chunks

#: Labelled rows that a fit uses at most (those with the smallest id hashes).
MAX_TRAIN = 8_000
WORD_SLOTS = 4_096
RANGES = 8
RANK = 8
EPOCHS, BATCH, RATE, L2 = 12, 64, 0.02, 1e-5
THRESHOLD = 0.7

_N_STATS = 12
WIDTH = WORD_SLOTS + _N_STATS * (1 + RANGES)

_LOG = np.log1p(np.arange(256)).astype(np.float32)


def features(text: str | None, out: np.ndarray) -> None:
    """Write the features of one text into a row of zeros. Null is as empty."""
    tokens = words(text)
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n = max(1, len(tokens))
    stats = np.zeros(_N_STATS)
    slots = np.fromiter(map(zlib.crc32, tokens), dtype=np.uint32, count=len(tokens))
    if len(tokens):
        counts = np.bincount(slots % WORD_SLOTS, minlength=WORD_SLOTS)
        present = np.flatnonzero(counts)
        x = _LOG[np.minimum(counts[present], 255)]
        out[present] = x / np.sqrt((x * x).sum())
        _, uses = np.unique(slots, return_counts=True)
        stats[0] = len(uses) / n
        stats[1] = uses.max() / n
        stats[2] = float((slots[1:] == slots[:-1]).sum()) / n
    by_byte = np.bincount(raw, minlength=256)
    size = max(1, len(raw))
    upper, lower = by_byte[65:91].sum(), by_byte[97:123].sum()
    blanks = by_byte[9:14].sum() + by_byte[32]
    plain = upper + lower + by_byte[48:58].sum() + by_byte[128:].sum() + blanks
    stats[3] = upper / max(1, upper + lower)
    stats[4] = min(1.0, (size - plain) / n / 4) if len(raw) else 0.0  # signs a word
    stats[5] = by_byte[48:58].sum() / size
    stats[6] = min(1.0, by_byte[33] / n)
    stats[7] = min(1.0, by_byte[124] / n)
    stats[8] = min(1.0, (by_byte[35] + by_byte[36] + by_byte[37] + by_byte[38] + by_byte[42]) / n / 3)
    stats[9] = min(1.0, (by_byte[46] + by_byte[44]) / n)
    stats[10] = min(1.0, len(raw) / n / 16)
    stats[11] = min(1.0, np.log1p(len(tokens)) / 12)
    out[WORD_SLOTS:WORD_SLOTS + _N_STATS] = stats
    ranges = np.minimum((stats * RANGES).astype(int), RANGES - 1)
    out[WORD_SLOTS + _N_STATS + np.arange(_N_STATS) * RANGES + ranges] = 1.0


class Machine:
    """w0 + <w, x> + pairwise interactions, through a logistic link."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    def margin(self, x: np.ndarray) -> np.ndarray:
        sums = x @ self.v
        return self.w0 + x @ self.w + 0.5 * (sums * sums - (x * x) @ (self.v * self.v)).sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))

    def to_bytes(self) -> bytes:
        return np.concatenate([[self.w0], self.w, self.v.ravel()]).astype(np.float32).tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> Machine:
        a = np.frombuffer(data, dtype=np.float32)
        return Machine(float(a[0]), a[1:1 + WIDTH], a[1 + WIDTH:].reshape(WIDTH, RANK))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss, adaptive gradient steps over shuffled batches. ``rows`` are
    (feature numbers, values). With one class only, the score is constant."""
    rng = np.random.default_rng(seed)
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    w0, w = float(np.log(share / (1 - share))), np.zeros(WIDTH, dtype=np.float32)
    v = rng.normal(0, 0.01, (WIDTH, RANK)).astype(np.float32)
    if len(labels) == 0 or labels.min() == labels.max():
        return Machine(w0, w, np.zeros_like(v))
    g0, gw, gv = 1e-6, np.full(WIDTH, 1e-6, np.float32), np.full((WIDTH, RANK), 1e-6, np.float32)
    epochs = max(EPOCHS, -(-20_000 // len(labels)))  # a small sample is seen more often
    for _ in range(min(epochs, 100)):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            picked = order[at:at + BATCH]
            x = np.zeros((len(picked), WIDTH), dtype=np.float32)
            for r, i in enumerate(picked):
                x[r, rows[i][0]] = rows[i][1]
            m = Machine(w0, w, v)
            loss = ((m.score(x) - labels[picked]) / len(picked)).astype(np.float32)
            sums = x @ v
            d0, dw = float(loss.sum()), loss @ x + L2 * w
            dv = x.T @ (loss[:, None] * sums) - (loss @ (x * x))[:, None] * v + L2 * v
            g0, gw, gv = g0 + d0 * d0, gw + dw * dw, gv + dv * dv
            w0 -= RATE * d0 / np.sqrt(g0)
            w -= RATE * dw / np.sqrt(gw)
            v -= RATE * dv / np.sqrt(gv)
    return Machine(w0, w, v)


def sample_labels(labels: DataFrame, label: str, modulus: int, remainder: int, limit: int) -> DataFrame:
    """(doc_id, label) of at most ``limit`` labelled rows outside the held-out
    ids: those with the smallest hashes of their ids. Null labels or ids are no
    labels; of several labels of an id the greatest counts."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()
                          & ~held_out(F.col("doc_id"), modulus, remainder))
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("__label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, __label, text): one row an id, whatever the number of documents
    that repeat it (the text with the smallest hash)."""
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most max_train small rows
    return rows.groupBy("doc_id", "__label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 4, remainder: int = 2,
          max_train: int = MAX_TRAIN) -> bytes:
    """The fitted machine, as bytes (its size does not depend on the input)."""
    sample = sample_labels(labels, label, modulus, remainder, max_train)
    chosen = labelled_texts(docs, sample)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, values = [], []
            x = np.zeros(WIDTH, dtype=np.float32)
            for t in batch.column("text").to_pylist():
                x[:] = 0
                features(t, x)
                at = np.flatnonzero(x)
                numbers.append(at.astype(np.int32).tobytes())
                values.append(x[at].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("__label"), pa.array(numbers, pa.binary()),
                 pa.array(values, pa.binary())], names=["id", "label", "numbers", "vals"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: (r["id"], r["label"], r["numbers"], r["vals"]))
        x = [(np.frombuffer(r["numbers"], np.int32), np.frombuffer(r["vals"], np.float32)) for r in rows]
        model = fit(x, np.array([r["label"] for r in rows], dtype=np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], pa.binary())], names=["model"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    rows = chosen.select(F.col("doc_id").alias("id"), "__label", "text").mapInArrow(
        extract, f"id {kind}, label int, numbers binary, vals binary")
    found = rows.repartition(1).mapInArrow(learn, "model binary").first()
    return found["model"] if found else fit([], np.zeros(0)).to_bytes()


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 4, remainder: int = 2,
                  max_train: int = MAX_TRAIN, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``keep`` columns) with held_out, score and predicted.

    score is the probability of label 1 and only depends on the text; ids whose
    crc32 leaves ``remainder`` teach nothing and are held_out. Null and empty
    texts score as texts without words. Without labels, or with one class, every
    text has the same score. Columns with the names of the results are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label, modulus, remainder, max_train))
    base = without(docs, "held_out", "score", "predicted")
    carried = [f for f in base.schema.fields if keep is None or f.name in keep]
    schema = T.StructType(carried + [T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine.from_bytes(model.value)
        for batch in batches:
            scores: list[float] = []
            for part in chunks(batch.column("text").to_pylist(), 256 << 10):
                x = np.zeros((len(part), WIDTH), dtype=np.float32)
                for row, text in zip(x, part):
                    features(text, row)
                scores += machine.score(x).astype(float).tolist()
            columns = [batch.column(f.name) for f in carried] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    needed = {f.name for f in carried} | {"text"}
    scored = base.select([c for c in base.columns if c in needed]).mapInArrow(score, schema)
    return scored.withColumns({"held_out": held_out(F.col("doc_id"), modulus, remainder),
                               "predicted": (F.col("score") >= threshold).cast("int")})
