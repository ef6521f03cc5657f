"""Exact top-k inner products with a bit-sliced index.

Rows are dealt to blocks of bounded size. In a block each dimension is kept as
bit slices (bitmaps over the rows) of its quantised offset from the block's
minimum. A query adds the slices of all dimensions with bitmap arithmetic,
weight bit by weight bit, which gives every row's score as bit slices; walking
these from the most significant one down selects the top rows. Quantisation
leaves each score an interval of known width, so the rows within that width of
the k-th value are the boundary: they are resolved by exact integer products.
Vectors with a component that slices of 32 bits do not hold are kept beside the
slices and always resolved exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.common import materialise

#: Rows of an index block and queries of a query block, at most.
BLOCK_ROWS, QUERY_ROWS = 65_536, 1_024
#: Bits kept of values and of query weights in the slices.
VALUE_BITS, WEIGHT_BITS = 8, 8
#: Scaled components of a vector in the slices are smaller than this.
LIMIT = 1 << 31

_BLOCK = "block int, dim int, ids binary, rows binary, vals binary, wide binary"
_LONG = (1 << 63) - 1


def quantise(batch: pa.RecordBatch, vec_id: str, vector: str, scale: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Ids, row numbers and floor(scale * x) (whole numbers as doubles) of each
    vector; None where the vector (or its id) is null or has a null or non-finite
    component."""
    lists = batch.column(vector)
    flat = lists.flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False)  # nulls become NaN
    sizes = np.asarray(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    ok = (bad[ends] == bad[ends - sizes]) & np.asarray(lists.is_valid()) & np.asarray(batch.column(vec_id).is_valid())
    with np.errstate(invalid="ignore", over="ignore"):
        q = np.floor(scale * x)
        large = ~np.isfinite(q) & np.isfinite(x)
    q[large] = np.floor(x[large])  # scale x is beyond a double: the score saturates either way
    ids = batch.column(vec_id).cast(pa.int64()).fill_null(0).to_numpy()
    vectors = [q[e - s:e] if good else None for e, s, good in zip(ends.tolist(), sizes.tolist(), ok.tolist())]
    return ids, batch.column("__row").to_numpy(), vectors


def pack_blocks(vectors: DataFrame, blocks: int, rows: int, vec_id: str, vector: str, scale: int) -> DataFrame:
    """Vectors as blocks of at most ``rows`` rows of one dimension, those with a
    component beyond LIMIT in blocks of their own (``wide``, as doubles); ``block``
    is 0 to blocks-1 (a partition may hold several blocks with its number)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting: dict[tuple[int, bool], list] = {}

        def block(dim: int, wide: bool) -> pa.RecordBatch:
            held = waiting.pop((dim, wide))
            ids, numbers = (np.array([h[i] for h in held], dtype=np.int64).tobytes() for i in (0, 1))
            vals = np.array([h[2] for h in held], dtype=np.float64).reshape(len(held), dim)
            vals, large = (None, vals.tobytes()) if wide else (vals.astype(np.int32).tobytes(), None)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([dim], pa.int32()), pa.array([ids], pa.binary()),
                 pa.array([numbers], pa.binary()), pa.array([vals], pa.binary()), pa.array([large], pa.binary())],
                names=["block", "dim", "ids", "rows", "vals", "wide"])

        for batch in batches:
            for i, r, v in zip(*(x.tolist() if hasattr(x, "tolist") else x for x in quantise(batch, vec_id, vector, scale))):
                if v is not None:
                    kind = len(v), bool((np.abs(v) >= LIMIT).any())
                    waiting.setdefault(kind, []).append((i, r, v))
                    if len(waiting[kind]) == rows:
                        yield block(*kind)
        for kind in list(waiting):
            yield block(*kind)

    return vectors.select(vec_id, vector, "__row").repartition(blocks).mapInArrow(pack, _BLOCK)


def unpack(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, row numbers, values) of a block; wide ones are Python integers."""
    ids, rows = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["rows"], np.int64)
    if block["wide"] is None:
        return ids, rows, np.frombuffer(block["vals"], np.int32).reshape(len(ids), block["dim"])
    wide = np.frombuffer(block["wide"], np.float64)
    return ids, rows, np.array([int(x) for x in wide], dtype=object).reshape(len(ids), block["dim"])


class SlicedBlock:
    """Bit slices of one block: ``slices[d, b]`` is a bitmap of 64-bit words."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vals: np.ndarray):
        self.ids, self.rows, self.vals, self.n = ids, rows, vals, len(ids)
        self.low = vals.min(axis=0).astype(np.int64) if self.n else np.zeros(vals.shape[1], np.int64)
        offset = vals - self.low
        bits = int(offset.max(initial=0)).bit_length()
        self.shift = max(0, bits - VALUE_BITS)
        self.bits = max(1, bits - self.shift)
        coarse = (offset >> self.shift).astype(np.uint16)
        pad = -self.n % 64
        self.slices = np.empty((vals.shape[1], self.bits, (self.n + pad) // 64), dtype=np.uint64)
        for b in range(self.bits):
            plane = np.pad(((coarse >> b) & 1).astype(np.uint8).T, ((0, 0), (0, pad)))
            self.slices[:, b] = np.ascontiguousarray(np.packbits(plane, axis=1, bitorder="little")).view(np.uint64)
        self.inverse = ~self.slices  # of the complement, for negative weights
        self.all = np.packbits(np.pad(np.ones(self.n, np.uint8), (0, pad)), bitorder="little").view(np.uint64)

    def score_slices(self, weights: np.ndarray, negative: np.ndarray) -> list[np.ndarray]:
        """Slices of the sum over dimensions of weight x coarse value (of the
        complement where the query's component is negative)."""
        planes = [self.inverse[d] if neg else self.slices[d] for d, neg in enumerate(negative.tolist())]
        total: list[np.ndarray] = []
        for bit in range(int(weights.max(initial=0)).bit_length() - 1, -1, -1):
            level: list[np.ndarray] = []
            for d in np.flatnonzero((weights >> bit) & 1).tolist():
                _add(level, planes[d])
            if total:
                total.insert(0, np.zeros_like(self.all))  # twice the sum of the higher bits
            _add(total, level)
        return total

    def at_least(self, slices: list[np.ndarray], value: int) -> np.ndarray:
        """Bitmap of the rows whose sum is ``value`` or more."""
        if value <= 0:
            return self.all.copy()
        if value.bit_length() > len(slices):
            return np.zeros_like(self.all)
        above, equal = np.zeros_like(self.all), self.all.copy()
        for b in range(len(slices) - 1, -1, -1):
            if value >> b & 1:
                equal &= slices[b]
            else:
                above |= equal & slices[b]
                equal &= ~slices[b]
        return above | equal

    def kth_value(self, slices: list[np.ndarray], among: np.ndarray, k: int) -> int:
        """The k-th largest sum among some rows (0 if there are fewer), from the
        most significant slice downward: rows surely in, and rows still tied."""
        sure, tied, value = np.zeros_like(among), among.copy(), 0
        for b in range(len(slices) - 1, -1, -1):
            upper = sure | (tied & slices[b])
            if int(np.bitwise_count(upper).sum()) >= k:
                tied &= slices[b]
                value |= 1 << b
            else:
                sure = upper
                tied &= ~slices[b]
        return value

    def top(self, own_row: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the block's k best rows, the query's own row left out."""
        magnitude = np.abs(query)
        t = max(0, int(magnitude.max(initial=0)).bit_length() - WEIGHT_BITS)
        weights = (magnitude + ((1 << t) >> 1)) >> t
        error = np.abs(magnitude - (weights << t))
        own = np.flatnonzero(self.rows == own_row)
        among = self.all.copy()
        for row in own.tolist():
            among[row // 64] &= ~np.uint64(1 << (row % 64))
        slices = self.score_slices(weights, query < 0)
        # Every true score is constant + (sum << shift + t) + [0, width].
        width = (int(error.sum()) << self.shift) * ((1 << self.bits) - 1) + int(magnitude.sum()) * ((1 << self.shift) - 1)
        floor = self.kth_value(slices, among, k) - (width >> (self.shift + t))
        rows = np.flatnonzero(np.unpackbits((self.at_least(slices, floor) & among).view(np.uint8), bitorder="little"))
        return best_of(self.ids[rows], exact_products(self.vals[rows], query), k)


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    best = np.lexsort((ids, -scores))[:k]
    return ids[best], scores[best]


def exact_products(vals: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer products of rows and a query (int64 or Python integers); beyond a long they saturate."""
    if vals.dtype != object and query.dtype != object:
        bound = vals.shape[1] * int(np.abs(query).max(initial=0)) * int(np.abs(vals.astype(np.int64)).max(initial=0))
        if bound < 1 << 62:
            return vals.astype(np.int64) @ query
    products = (vals.astype(object) * query.astype(object)).sum(axis=1) if vals.shape[1] else [0] * len(vals)
    return np.array([max(-_LONG, min(_LONG, int(s))) for s in products], dtype=np.int64)


def _add(total: list[np.ndarray], number: list[np.ndarray] | np.ndarray) -> None:
    """Add a bit-sliced number to a bit-sliced total, in place (ripple carry)."""
    carry = None
    for b, x in enumerate(number):
        if b == len(total):
            total.append(np.zeros_like(x))
        a = total[b]
        half = a ^ x
        both = a & x
        if carry is None:
            total[b], carry = half, both
        else:
            total[b] = half ^ carry
            half &= carry
            both |= half
            carry = both
    b = len(number)
    while carry is not None and carry.any():
        if b == len(total):
            total.append(carry)
            break
        a = total[b]
        total[b] = a ^ carry
        carry = a & carry
        b += 1


def top_k(vectors: DataFrame, asked: Column | str, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
          scale: int = 1024, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` for which
    ``asked`` is true, the k other rows with the highest integer inner product of
    floor(scale * x), ties to the smaller vec_id; fewer rows if there are fewer.

    Rows are told apart by number, not by id: only the query's own row is left
    out, rows that repeat its id or its values are candidates like all others,
    and each of several query rows with one id gets its k rows. Vectors that are
    null, or hold null or non-finite components, or have a null id, take no part;
    only vectors of equal dimension are compared. Components may be of any size;
    scores beyond a long saturate. Other columns are ignored.

    Both sides are dealt to blocks; each pair of an index block and a query block is
    one group of bounded size. Where index blocks are few, queries are dealt to more
    blocks, so that all cores have some (a small index block would cost nearly as
    much a query as a large one). What returns is k rows a query and block, of which
    a window keeps the k best.
    """
    where = F.expr(asked) if isinstance(asked, str) else asked
    rows = materialise(vectors.select(vec_id, vector, F.coalesce(where, F.lit(False)).alias("__asked"),
                                      F.monotonically_increasing_id().alias("__row")), "vectors")
    n, n_asked = rows.agg(F.count(F.lit(1)), F.count_if("__asked")).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = -(-n // block_rows) or 1
    query_rows = min(query_rows, max(1, -(-n_asked * blocks // (2 * cores))))
    query_blocks = -(-n_asked // query_rows) or 1
    index = pack_blocks(rows, blocks, block_rows, vec_id, vector, scale)
    queries = pack_blocks(rows.filter("__asked"), query_blocks, query_rows, vec_id, vector, scale)
    index = index.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = queries.withColumnRenamed("block", "other").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "query_row": [], "vec_id": [], "score": []}
        asks = [(ask["dim"], *unpack(ask)) for ask in right.to_pylist()]
        for packed in left.to_pylist():
            ids, numbers, vals = unpack(packed)
            block = SlicedBlock(ids, numbers, vals) if vals.dtype != object else None
            for dim, query_ids, query_numbers, queries in asks:
                if dim != packed["dim"]:
                    continue
                for i, own, q in zip(query_ids.tolist(), query_numbers.tolist(), queries):
                    q = q if q.dtype == object else q.astype(np.int64)
                    if block is not None and q.dtype != object:
                        best, scores = block.top(own, q, k)
                    else:  # too wide for slices: all rows are resolved exactly
                        others = numbers != own
                        best, scores = best_of(ids[others], exact_products(vals[others], q), k)
                    out["query_id"] += [i] * len(best)
                    out["query_row"] += [own] * len(best)
                    out["vec_id"] += best.tolist()
                    out["score"] += scores.tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    found = (index.groupBy("block", "other").cogroup(queries.groupBy("block", "other"))
             .applyInArrow(search, "query_id long, query_row long, vec_id long, score long"))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
