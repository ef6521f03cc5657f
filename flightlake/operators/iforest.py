"""Isolation forest on Spark (X2-X4; Liu, Ting and Zhou, ICDM 2008).

fit
  1. Rows with equal features are one weighted point (a partial aggregate), so
     repeated rows are sampled in proportion and spread over the trees.
  2. One sampling design for every size: about 2 * psi * trees draws are taken
     in all. A point of weight m is drawn floor(m * p + u) times, u its hash in
     [0, 1); each draw goes to ``c`` different trees, chosen by hash. c is 1
     unless the data are fewer than the draws. Each tree keeps the psi draws
     with the smallest hashes. Nothing depends on partitioning.
  3. ``groupBy('tree').applyInPandas`` grows each tree (about 2 * psi rows a
     group before the cut) with a generator seeded by (seed, tree).
  4. The model — at most trees * (2 * psi - 1) nodes, a size fixed by the
     parameters — is collected once and broadcast.
score
  ``mapInPandas`` walks all trees over Arrow batches with numpy (no per-row
  Python); score_samples = -2 ** (-E[h] / c(psi)); the offset is the exact
  ``contamination`` percentile of the scores of the fitted data (counts in
  bins that narrow in), or -0.5 without contamination; decision = score -
  offset; label -1 when decision < 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.functions import fill_zero
from flightlake.session import stored

# Euler-Mascheroni constant used by the average path length.
EULER_GAMMA = 0.5772156649
# Bins of one counting pass, and distinct values that end the narrowing.
QUANTILE_BINS = 4_096

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("leaf_value", T.DoubleType()),
])


def average_path_length(n: np.ndarray | float) -> np.ndarray:
    """c(n): mean path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


@dataclass
class ForestModel:
    features: list[str]
    psi: int
    max_depth: int
    feature: np.ndarray      # [trees, nodes] int, -1 = leaf / padding
    threshold: np.ndarray    # [trees, nodes]
    left: np.ndarray
    right: np.ndarray
    leaf_value: np.ndarray   # depth + c(size) at leaves
    offset: float | None = None

    def __post_init__(self):
        # walk arrays: a leaf points to itself with threshold +inf, so every
        # row takes exactly max_depth steps with no leaf test
        leaf = self.feature < 0
        ids = np.broadcast_to(np.arange(self.feature.shape[1]), self.feature.shape)
        self._feat = np.where(leaf, 0, self.feature)
        self._thr = np.where(leaf, np.inf, self.threshold)
        self._left = np.where(leaf, ids, self.left)
        self._right = np.where(leaf, ids, self.right)

    def score_samples(self, x: np.ndarray) -> np.ndarray:
        """-(2 ** (-mean path length / c(psi))) for rows of ``x``."""
        n = x.shape[0]
        xt = np.ascontiguousarray(x.T)
        rows = np.arange(n)
        total = np.zeros(n)
        for t in range(self._feat.shape[0]):
            ft, tt, lt, rt = self._feat[t], self._thr[t], self._left[t], self._right[t]
            idx = np.zeros(n, dtype=np.int64)
            for _ in range(self.max_depth):
                idx = np.where(xt[ft[idx], rows] < tt[idx], lt[idx], rt[idx])
            total += self.leaf_value[t][idx]
        mean_h = total / self._feat.shape[0]
        cpsi = float(average_path_length(np.array([self.psi]))[0]) or 1.0
        return -np.power(2.0, -mean_h / cpsi)


def _grow_tree(pdf: pd.DataFrame, features: list[str], max_depth: int, seed: int) -> pd.DataFrame:
    """One isolation tree over the rows of one group (pandas, inside a task)."""
    tree = int(pdf["tree"].iloc[0])
    x = pdf.sort_values("_h")[features].to_numpy(dtype=float)
    rng = np.random.default_rng([seed, tree])
    out: list[tuple] = []
    stack = [(np.arange(len(x)), 0, 0)]
    next_id = 1
    while stack:
        idx, depth, node = stack.pop()
        sub = x[idx]
        lo, hi = (sub.min(axis=0), sub.max(axis=0)) if len(idx) else (None, None)
        usable = np.flatnonzero(hi > lo) if len(idx) > 1 else np.array([], dtype=int)
        if depth >= max_depth or len(usable) == 0:
            leaf = depth + float(average_path_length(np.array([len(idx)]))[0])
            out.append((tree, node, -1, 0.0, -1, -1, leaf))
            continue
        f = int(usable[rng.integers(len(usable))])
        thr = float(rng.uniform(lo[f], hi[f]))
        left_id, right_id = next_id, next_id + 1
        next_id += 2
        out.append((tree, node, f, thr, left_id, right_id, 0.0))
        mask = sub[:, f] < thr
        stack.append((idx[~mask], depth + 1, right_id))
        stack.append((idx[mask], depth + 1, left_id))
    return pd.DataFrame(out, columns=[f.name for f in NODE_SCHEMA.fields])


def spark_parallelism(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def _features_frame(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({c: fill_zero(c) for c in features})


def _unit(*cols) -> Column:
    """Pseudo-uniform number in [0, 1) from a hash of ``cols``."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) * F.lit(2.0 ** -53)


def sample_trees(df: DataFrame, features: Sequence[str], n: int, trees: int, psi: int, seed: int) -> DataFrame:
    """(tree, _h, features): the psi draws of every tree from ``n`` rows."""
    target = 2 * psi * trees
    c = min(trees, -(-target // n))
    p = min(1.0, target / (n * c))
    points = df.groupBy(*features).agg(F.count(F.lit(1)).alias("_m"))
    draws = F.floor(F.col("_m") * F.lit(p) + _unit(F.lit(seed), F.lit(-1), *features)).cast("int")
    drawn = points.select(*features, draws.alias("_d")).filter("_d > 0")
    drawn = drawn.select(*features, F.explode(F.sequence(F.lit(1), F.col("_d"))).alias("_i"))
    # c different trees: a start and a stride without a common divisor with the number of trees
    strides = F.array(*[F.lit(k) for k in range(1, trees + 1) if math.gcd(k, trees) == 1])
    h = F.xxhash64(F.lit(seed), F.lit(-2), *features, F.col("_i"))
    stride = F.element_at(strides, (F.pmod(F.shiftright(h, 32), F.size(strides)) + 1).cast("int"))
    dealt = drawn.select(*features, "_i", F.pmod(h, F.lit(trees)).alias("_t"), stride.alias("_s"),
                         F.explode(F.sequence(F.lit(0), F.lit(c - 1))).alias("_j"))
    tree = F.pmod(F.col("_t") + F.col("_j") * F.col("_s"), F.lit(trees)).cast("int")
    dealt = dealt.select(*features, "_i", tree.alias("tree"))
    dealt = dealt.withColumn("_h", F.xxhash64(F.lit(seed), F.lit(-3), *features, F.col("_i"), F.col("tree")))
    w = Window.partitionBy("tree").orderBy("_h", *features, "_i")
    return dealt.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= psi).select("tree", "_h", *features)


def fit(df: DataFrame, features: Sequence[str], trees: int = 100, sample: int = 256,
        contamination: float | None = 0.01, seed: int = 42) -> ForestModel:
    """Grow the forest on ``df`` (NULL features count as 0) and set the offset."""
    features = list(features)
    data = _features_frame(df, features).select(*features)
    n = data.count()
    if n == 0:
        raise ValueError("cannot fit on an empty DataFrame")
    psi = min(sample, n)
    max_depth = max(1, math.ceil(math.log2(max(psi, 2))))
    picked = sample_trees(data, features, n, trees, psi, seed)
    # growing trees is CPU-bound Python over a bounded sample (<= psi * trees
    # rows): spread the trees over the cores instead of letting the small
    # shuffle be coalesced into one task
    spread = max(1, min(trees, spark_parallelism(df)))
    picked = picked.repartition(spread, "tree")
    nodes = picked.groupBy("tree").applyInPandas(
        lambda pdf: _grow_tree(pdf, features, max_depth, seed), NODE_SCHEMA)
    model = _assemble(nodes.toPandas(), features, psi, max_depth, trees)
    if contamination is None:
        model.offset = -0.5
    else:
        scores = stored(score_samples(data, model, "_raw").select("_raw"))
        model.offset = exact_quantile(scores, "_raw", contamination)
    return model


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """The ``q`` quantile of a column (linear interpolation between the two
    nearest values), exactly and with bounded counts on the driver.

    Each pass counts the rows in equal bins of the current interval; the bin
    that holds the lower rank is the next interval, until it has few rows or
    all of its values are one. None for an empty column.
    """
    x = df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
    n, lo, hi = x.agg(F.count("x"), F.min("x"), F.max("x")).first()
    if not n:
        return None
    at = q * (n - 1)
    rank = math.floor(at)
    below, rows = 0, n  # rows under the interval, and in it
    while rows > QUANTILE_BINS and lo < lo + (hi - lo) / QUANTILE_BINS:
        number = F.floor((F.col("x") - F.lit(lo)) / F.lit((hi - lo) / QUANTILE_BINS))
        bins = (x.filter(F.col("x").between(lo, hi)).groupBy(F.least(number, F.lit(QUANTILE_BINS - 1)).alias("b"))
                .agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("b").collect())
        for b in bins:
            if rank < below + b.n:
                lo, hi, rows = b.lo, b.hi, b.n
                break
            below += b.n
    for v in x.filter(F.col("x").between(lo, hi)).groupBy("x").agg(F.count("x").alias("n")).orderBy("x").collect():
        below += v.n
        if rank < below:
            break
    above = v.x
    if rank + 1 >= below and rank + 1 < n:
        above = x.filter(F.col("x") > F.lit(v.x)).agg(F.min("x")).first()[0]
    return v.x + (at - rank) * (above - v.x)


def _assemble(pdf: pd.DataFrame, features: list[str], psi: int, max_depth: int, trees: int) -> ForestModel:
    width = int(pdf["node"].max()) + 1 if len(pdf) else 1
    shape = (trees, width)
    feat = np.full(shape, -1, dtype=np.int64)
    thr = np.zeros(shape)
    left = np.zeros(shape, dtype=np.int64)
    right = np.zeros(shape, dtype=np.int64)
    leaf = np.zeros(shape)
    t, nd = pdf["tree"].to_numpy(), pdf["node"].to_numpy()
    feat[t, nd] = pdf["feature"].to_numpy()
    thr[t, nd] = pdf["threshold"].to_numpy()
    left[t, nd] = np.maximum(pdf["left"].to_numpy(), 0)
    right[t, nd] = np.maximum(pdf["right"].to_numpy(), 0)
    leaf[t, nd] = pdf["leaf_value"].to_numpy()
    return ForestModel(features, psi, max_depth, feat, thr, left, right, leaf)


def score_samples(df: DataFrame, model: ForestModel, out_col: str = "anomaly_score_raw",
                  spread: int | None = None) -> DataFrame:
    """Vectorised scoring: adds ``out_col`` (more negative = more anomalous).

    Scoring is CPU-bound Python; a caller whose input has fewer splits than
    cores can have it dealt to ``spread`` partitions first.
    """
    spark = df.sparkSession
    # plain arrays only: broadcast values are unpickled without our package
    bc = spark.sparkContext.broadcast({k: getattr(model, k) for k in
                                       ("features", "psi", "max_depth", "feature", "threshold", "left", "right",
                                        "leaf_value")})
    features = model.features
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.DoubleType())])
    if spread:
        df = df.repartition(spread)

    def run(batches):
        m = ForestModel(**bc.value)
        for pdf in batches:
            x = np.column_stack([pd.to_numeric(pdf[c], errors="coerce").fillna(0.0).to_numpy(dtype=float)
                                 for c in features]) if len(pdf) else np.zeros((0, len(features)))
            pdf[out_col] = m.score_samples(x) if len(pdf) else np.zeros(0)
            yield pdf

    return df.mapInPandas(run, schema)


def score(df: DataFrame, model: ForestModel, score_col: str = "anomaly_score",
          label_col: str = "anomaly_label", spread: int | None = None) -> DataFrame:
    """Decision score (score_samples - offset) and label -1 / 1."""
    offset = model.offset if model.offset is not None else -0.5
    s = score_samples(df, model, "_raw", spread)
    return (s.withColumn(score_col, F.col("_raw") - F.lit(offset))
            .withColumn(label_col, F.when(F.col(score_col) < 0, F.lit(-1)).otherwise(F.lit(1)))
            .drop("_raw"))
