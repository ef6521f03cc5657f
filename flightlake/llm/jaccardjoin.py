"""Exact Jaccard join of documents by word 5-grams, as blocked sparse products.

A document is a row of the document by shingle incidence matrix; the overlap of
two documents is an entry of the product of the matrix with its transpose. Size
bounds keep most of that product from being made:

* A pair at 0.8 shares one of the first floor(n/5) + 1 shingles of each, in any
  fixed order of all shingles; of the shorter even one of the first
  floor(n/9) + 1. Only these prefixes are joined.
* The order puts rare shingles first, in four classes. How common a shingle is is
  read from a table of counters over all documents (fixed size; shingles share
  counters, which affects the order only). So what many documents hold brings
  together only those that hold little else.
* The overlap inside the prefixes bounds the whole overlap.

Documents with equal sets are one row of the matrix, and shingles with equal
rows one column. The rows of a column of the prefix matrix are first compared with
its most connected row. Where they are then still of several components, columns
that few rows have, or rows that mostly share little else, give pairs of rows, whose
overlap in the prefixes is counted; columns of many like rows give no pairs, but
blocks of rows of different components are multiplied, columns in blocks. Pairs
whose overlap cannot reach the bound are discarded. The rows that are left are
compared over their whole sets, which counts every overlap exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy
from itertools import combinations_with_replacement, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.common import materialise, mix64, window_hashes
from flightlake.llm.components import connected_components
from flightlake.session import drop_stored, shuffles_removed, stored_tables

SHINGLE = 5
#: Counters: 2^SLOT_BITS of them, in ranges of 2^16.
SLOT_BITS = 26
#: Shingles that a task counts before it hands their counters on.
HELD_SLOTS = 1 << 22
#: A shingle is common if its counter is over this (or, in a larger corpus, over eight times the mean).
COMMON = 64
#: A column gives pairs of rows if it has PAIR_ROWS rows at most, or up to PAIR_MOST
#: of which PAIR_ROWS at most share so many columns that a row of their size may be linked.
PAIR_ROWS, PAIR_MOST = 32, 1024
#: Bits that tell the ids whose texts are wanted from most others.
ID_BITS = 26
#: Rows and shingles of a block of the product. Rows go once to each block that their
#: block is paired with: a group is cut into blocks of BLOCK_ROWS, but into SPREAD at
#: most until they have FULL x BLOCK_ROWS rows or BLOCK_ITEMS shingles.
BLOCK_ROWS, SPREAD, FULL, BLOCK_ITEMS = 512, 8, 16, 1_000_000
#: Rows and columns that are multiplied at a time.
TILE_ROWS, BLOCK_COLUMNS = 512, 4096

_RANGES = 1 << (SLOT_BITS - 16)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles: ``k`` consecutive words (ASCII
    lower-cased, separated by ASCII blanks); fewer words are one shingle."""
    w = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not w:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), dtype=np.uint64, count=len(w))
    return np.unique(mix64(window_hashes(h, min(k, len(h)))))


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def count_slots(texts: DataFrame) -> DataFrame:
    """(range, levels, total): the counters of the shingles of all texts, a row
    for each range of 65,536; a level is the bit length of a count."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            slots = np.sort(np.concatenate(held))
            ends = np.searchsorted(slots >> 16, np.arange(_RANGES + 1))
            low = (slots & 0xFFFF).astype(np.uint16)
            some = np.flatnonzero(np.diff(ends))
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([low[ends[r]:ends[r + 1]].tobytes() for r in some.tolist()], pa.binary())],
                names=["range", "low"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.append(_slots(shingles(t)))
                size += len(held[-1])
                if size >= HELD_SLOTS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, counts = None, None

        def done() -> pa.RecordBatch:
            levels = np.frexp(counts.astype(np.float64))[1].astype(np.uint8)  # bit lengths
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([levels.tobytes()], pa.binary()), pa.array([int(counts.sum())], pa.int64())],
                names=["range", "levels", "total"])

        for batch in batches:
            for r, low in zip(batch.column("range").to_pylist(), batch.column("low").to_pylist()):
                if r != at:
                    if at is not None:
                        yield done()
                    at, counts = r, np.zeros(1 << 16, dtype=np.int64)
                counts += np.bincount(np.frombuffer(low, np.uint16), minlength=1 << 16)
        if at is not None:
            yield done()

    blobs = texts.mapInArrow(collect, "range int, low binary")
    return (blobs.repartition("range").sortWithinPartitions("range")
            .mapInArrow(add, "range int, levels binary, total long"))


def slot_classes(texts: DataFrame) -> np.ndarray:
    """Class of each counter, four to a byte (16 MB, whatever the size of the
    corpus): 0 about what a counter has anyway, 1 up to twice and 2 well above
    that, 3 common (more than COMMON, and than eight times the mean)."""
    levels = materialise(count_slots(texts), "slots")
    written = stored_tables()[-1]
    mean = (levels.agg(F.sum("total")).first()[0] or 0) / (1 << SLOT_BITS)
    usual = int(2 + 2 * mean).bit_length()  # levels are bit lengths of counts
    common = max(COMMON, int(8 * mean)).bit_length()

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for x in batch.column("levels").to_pylist():
                x = np.frombuffer(x, np.uint8)
                c = (x > usual).astype(np.uint8) + (x > usual + 1) + (x > max(common, usual + 1))
                c = c.astype(np.uint8)
                packed.append((c[0::4] | c[1::4] << 2 | c[2::4] << 4 | c[3::4] << 6).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("range"), pa.array(packed, pa.binary())], names=["range", "classes"])

    out = np.zeros((_RANGES, 1 << 14), dtype=np.uint8)
    for r, classes in levels.mapInArrow(classify, "range int, classes binary").toLocalIterator():
        out[r] = np.frombuffer(classes, np.uint8)
    drop_stored(texts.sparkSession, [written])
    return out.reshape(-1)


def prefix(h: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, int, int, int]:
    """(the prefix in the order; the length of the short prefix; how many of the
    prefix are not common; where the prefix ends in the order, as a number)."""
    n = len(h)
    slots = _slots(h)
    kind = classes[slots >> 2] >> ((slots & 3) << 1).astype(np.uint8) & 3
    order = np.argsort(kind, kind="stable")[:n // 5 + 1]  # inside a class by hash, as they come
    first, kind = h[order], kind[order]
    end = (1 << 63) - 1
    if len(first) < n:  # else nothing lies beyond the prefix
        end = (int(kind[-1]) << 60) | int(first[-1] >> np.uint64(4))
    return first, n // 9 + 1 if n else 0, int((kind < 3).sum()), end


def sign_documents(docs: DataFrame, doc_id: str, text: str, table: Broadcast) -> DataFrame:
    """(doc_id, digest, n, prefix, lead, usual, cut): digest and size of each set, its prefix."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = table.value
        for batch in batches:
            out = []
            for t in batch.column("text").to_pylist():
                h = shingles(t)
                first, lead, usual, cut = prefix(h, classes)
                out.append((xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None, len(h), first.view(np.int64),
                            lead, usual, cut))
            kinds = [pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([r[i] for r in out], k) for i, k in enumerate(kinds))],
                names=["doc_id", "digest", "n", "prefix", "lead", "usual", "cut"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sign, f"doc_id {kind}, digest binary, n long, prefix array<long>, lead long, usual long, cut long")


def whole_sets(docs: DataFrame, doc_id: str, text: str, table: Broadcast) -> DataFrame:
    """(digest, items): the whole set of each text whose id has its bit set in
    ``table`` (``id_bits``): all texts with one of the ids, and few others."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            at = batch.column("at").to_numpy()
            wanted = pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))
            sets = [shingles(t) for t in batch.column("text").filter(wanted).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None for h in sets], pa.binary()),
                 pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64()))], names=["digest", "items"])

    rows = docs.select(_id_bit(doc_id).alias("at"), F.col(text).alias("text"))
    return rows.mapInArrow(build, "digest binary, items array<long>")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Entries of the product of two blocks: for each left and right row the
    number of columns that both have. Columns that only one side has are left out;
    the others go in blocks."""
    def entries(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    sides = entries(left), entries(right)
    columns = np.intersect1d(sides[0][0], sides[1][0])
    total = np.zeros((len(left), len(right)), dtype=np.float32)  # counts far below 2^24
    for at in range(0, len(columns), BLOCK_COLUMNS):
        block = columns[at:at + BLOCK_COLUMNS]
        dense = []
        for (c, owner), rows in zip(sides, (left, right)):
            place = np.minimum(np.searchsorted(block, c), len(block) - 1)
            hit = block[place] == c
            part = np.zeros((len(rows), len(block)), dtype=np.float32)
            part[owner[hit], place[hit]] = 1.0
            dense.append(part)
        total += dense[0] @ dense[1].T
    return total.astype(np.int64)


class Block:
    """Rows of one side of a product: their numbers, components, set sizes and columns."""

    def __init__(self, table: pa.Table, column: str):
        self.node, self.comp, self.n = (table.column(c).to_numpy() for c in ("node", "comp", "n"))
        lists = table.column(column).combine_chunks()
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        self.columns = np.split(lists.flatten().to_numpy(), ends[:-1]) if len(ends) else []
        self.cut = table.column("cut").to_numpy() if "cut" in table.column_names else None

    def tiles(self) -> list[Block]:
        """The block in parts of TILE_ROWS rows."""
        parts = []
        for at in range(0, len(self.node), TILE_ROWS):
            part, rows = copy(self), slice(at, at + TILE_ROWS)
            part.node, part.comp, part.n, part.columns = self.node[rows], self.comp[rows], self.n[rows], self.columns[rows]
            part.cut = None if self.cut is None else self.cut[rows]
            parts.append(part)
        return parts


def _tile_pairs(left: Block, right: Block) -> Iterator[tuple[Block, Block]]:
    """The pairs of tiles of two blocks, of a block with itself each pair once."""
    if left is right:
        yield from combinations_with_replacement(left.tiles(), 2)
    else:
        yield from product(left.tiles(), right.tiles())


def eligible(left: Block, right: Block) -> np.ndarray:
    """Which pairs are of different components and of sizes that allow a link."""
    s, t = left.n[:, None], right.n[None, :]
    may = (left.comp[:, None] != right.comp[None, :]) & (5 * np.minimum(s, t) >= 4 * np.maximum(s, t))
    return np.triu(may, 1) if left is right else may


def may_link(left: Block, right: Block) -> np.ndarray:
    """Which pairs may reach the bound, by the overlap of their prefixes: beyond
    where the first of two prefixes ends, its row has only so many shingles left."""
    may = eligible(left, right)
    if not may.any():
        return may
    s, t = left.n[:, None], right.n[None, :]
    rest_s, rest_t = s - np.minimum(s, s // 5 + 1), t - np.minimum(t, t // 5 + 1)
    first = np.sign(left.cut[:, None] - right.cut[None, :])
    rest = np.where(first < 0, rest_s, np.where(first > 0, rest_t, np.maximum(rest_s, rest_t)))
    return may & (9 * (overlaps(left.columns, right.columns) + rest) >= 4 * (s + t))


def links(left: Block, right: Block) -> list[tuple[int, int]]:
    """Links between different components, less those that join nothing new."""
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = []
    for one, two in _tile_pairs(left, right):
        may = eligible(one, two)
        if not may.any():
            continue
        may &= 9 * overlaps(one.columns, two.columns) >= 4 * (one.n[:, None] + two.n[None, :])
        for x, y in zip(*(i.tolist() for i in np.nonzero(may))):
            a, b = root(int(one.comp[x])), root(int(two.comp[y]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(one.node[x]), int(two.node[y])))
    return out


def _products(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, int, Block, Block]]:
    """(i, j, left block, right block) of the groups in batches sorted by (i, j, own)."""
    held: list[pa.RecordBatch] = []

    def group(parts: list[pa.RecordBatch]) -> tuple[int, int, Block, Block] | None:
        table = pa.Table.from_batches(parts)
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        own = table.column("own").to_numpy()
        left = Block(table.filter(pa.array(own == i)), column)
        right = left if i == j else Block(table.filter(pa.array(own == j)), column)
        return (i, j, left, right) if len(left.node) and len(right.node) else None

    for batch in batches:
        i, j = batch.column("i").to_numpy(), batch.column("j").to_numpy()
        cuts = (np.flatnonzero((i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1).tolist()
        for at, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            if end == at:
                continue
            if held and (held[-1].column("i")[0], held[-1].column("j")[0]) != (batch.column("i")[at], batch.column("j")[at]):
                if found := group(held):
                    yield found
                held = []
            held.append(batch.slice(at, end - at))
    if held and (found := group(held)):
        yield found


def _by_blocks(blocks: DataFrame, column: str, run, schema: str) -> DataFrame:
    """``run`` over the products of block pairs, many in a task, one at a time in memory."""
    dealt = blocks.repartition("i", "j").sortWithinPartitions("i", "j", "own")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        for i, j, left, right in _products(batches, column):
            rows = run(i, j, left, right)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    return dealt.mapInArrow(work, schema)


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(src, dst) of the pairs (a, b) whose whole sets reach the bound."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("n1"), F.col("items").alias("items1"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("items").alias("items2"))
    return (pairs.join(one, "a").join(two, "b")
            .withColumn("common", F.size(F.array_intersect("items1", "items2")))
            .filter("9 * common >= 4 * (n1 + n2)").select(F.col("a").alias("src"), F.col("b").alias("dst")))


def _id_bit(doc_id: str) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << ID_BITS))


def id_bits(ids: DataFrame) -> np.ndarray:
    """A bit for each value of a hash of the ids, set where there is one (8 MB, however many they are)."""
    at = ids.select(_id_bit(ids.columns[0]).alias("at"))
    parts = materialise(at.groupBy(F.shiftright("at", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("at") % (1 << 15)).alias("bits")), "ids")
    written = stored_tables()[-1]
    out = np.zeros((1 << ID_BITS - 15, 1 << 12), dtype=np.uint8)
    for part, bits in parts.toLocalIterator():
        out[part] = np.frombuffer(bits, np.uint8)
    drop_stored(ids.sparkSession, [written])
    return out.reshape(-1)


def _sets_of(some: DataFrame, nodes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, n, items): whole sets of some nodes, made anew from one text each, written."""
    wanted = nodes.select("node", "n", "digest", "first_id").join(some, "node", "left_semi")
    table = docs.sparkSession.sparkContext.broadcast(id_bits(wanted.select("first_id")))
    found = whole_sets(docs, doc_id, text, table).dropDuplicates(["digest"])
    sets = materialise(wanted.select("digest", "node", "n").join(found, "digest").select("node", "n", "items"), "items")
    table.destroy()
    return sets


def _shared_columns(nodes: DataFrame) -> DataFrame:
    """(key, node, n, size, times, short): the rows of each column of the prefix
    matrix that several rows have. Columns with the same rows are one, the first of
    them in the order (a pair that meets in them meets there first); ``times`` says
    how many they are, ``short`` whether one of the rows has one of them in its short
    prefix. A pair that is linked meets in such a column; the others only count."""
    postings = nodes.select("node", F.posexplode("prefix").alias("place", "key"), "lead", "usual")
    # Place and whether it is in the short prefix, in one number.
    spot = (2 * F.col("place") + (F.col("place") < F.col("lead")).cast("int")).alias("spot")
    rare = postings.filter("place < usual").select("key", "node", spot)
    often = postings.filter("place >= usual").select("key", "node", spot)
    h = F.xxhash64("node")
    facts = {"size": F.count(F.lit(1)), "any_short": F.max(F.expr("spot % 2 = 1")), "x": F.bit_xor(h),
             "s": F.sum(F.shiftright(h, 20)), "least": F.min(F.struct("node", "spot"))}
    columns = ["key", "node", "spot", *facts]
    # Most columns have one row, so that adding up before the shuffle saves
    # nothing: rows go as they are, once. Common columns may be of any size: their
    # rows are added up first.
    by_key = Window.partitionBy("key")
    shared = rare.withColumn("size", F.count(F.lit(1)).over(by_key)).filter("size > 1")
    shared = shared.withColumns({c: f.over(by_key) for c, f in facts.items() if c != "size"})
    summed = often.groupBy("key").agg(*[f.alias(c) for c, f in facts.items()]).filter("size > 1")
    seen = materialise(shared.select(*columns).union(often.join(summed, "key").select(*columns)), "seen")
    firsts = (seen.filter("node = least.node").groupBy("size", "x", "s", F.col("least.node").alias("m"))
              .agg(F.min(F.struct("spot", "key")).alias("c"), F.max("any_short").alias("short"), F.count(F.lit(1)).alias("times"))
              .select(F.col("c.key").alias("key"), "times", "short"))
    written = stored_tables()[-1]
    members = materialise(seen.select("key", "node", "size").join(firsts, "key").join(nodes.select("node", "n"), "node"), "members")
    drop_stored(nodes.sparkSession, [written])
    return members


def _open_columns(members: DataFrame, found: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The columns of several components: (key, times, short, node, n, comp, cut,
    most, beyond), the rows of those that give pairs, and (key), the others that
    rows have by their short prefix. ``most``: the columns that a row shares at all;
    ``beyond``: those that are in neither."""
    placed = (members.join(found, "node", "left")
              .select("key", "times", "short", "node", "n", F.coalesce("component", "node").alias("comp")))
    comps = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    open_rows = materialise(placed.join(comps.filter("lo < hi").select("key"), "key"), "columns")
    most = open_rows.groupBy("node").agg(F.sum("times").alias("most"))
    strong = F.expr("9 * (most + n - least(n, n div 5 + 1)) >= 8 * n").cast("int")
    few = (open_rows.join(most, "node").groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum(strong).alias("strong"))
           .select("key", F.expr(f"m <= {PAIR_ROWS} OR m <= {PAIR_MOST} AND strong <= {PAIR_ROWS}").alias("few")))
    split = materialise(open_rows.join(few, "key"), "split")
    facts = split.groupBy("node").agg(F.sum("times").alias("most"), F.sum(F.expr("if(few OR short, 0, times)")).alias("beyond"))
    pairing = split.filter("few").drop("few").join(facts, "node").join(nodes.select("node", "cut"), "node")
    return pairing, split.filter("short AND NOT few").select("key").distinct()


def _likely_pairs(pairing: DataFrame) -> DataFrame:
    """(a, b): the pairs of rows of different components that meet in columns that
    give pairs, and may reach the bound by their prefixes' overlap (as in
    ``may_link``). A pair that meets in another column as well may be left out:
    it is in the products."""
    one, two = (pairing.select("key", *(["times", "short"] if c == "a" else []),
                               *(F.col(x).alias(f"{x}_{c}") for x in ("node", "n", "comp", "cut", "most", "beyond"))) for c in "ab")
    rest_a, rest_b = (f"(n_{c} - least(n_{c}, n_{c} div 5 + 1))" for c in "ab")
    rest = f"CASE WHEN cut_a < cut_b THEN {rest_a} WHEN cut_a > cut_b THEN {rest_b} ELSE greatest({rest_a}, {rest_b}) END"
    met = (one.join(two, "key")
           .filter("node_a < node_b AND comp_a <> comp_b AND 5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)")
           .filter(f"9 * (least(most_a, most_b) + {rest}) >= 4 * (n_a + n_b)"))
    need = F.expr(f"4 * (n_a + n_b) - 9 * ({rest} + least(beyond_a, beyond_b))")
    return (met.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"), need.alias("need"))
            .agg(F.sum("times").alias("shared"), F.max("short").alias("short"))
            .filter("short AND 9 * shared >= need").select("a", "b"))


def _open_blocks(members: DataFrame, centres: DataFrame, found: DataFrame, nodes: DataFrame, block_rows: int) -> DataFrame:
    """(i, j, own, node, comp): the pairs of row blocks to be multiplied, with the
    rows of both. A row lies in one block, with rows of about its size that meet
    the same most connected row (near copies lie together; each such group joins the
    largest one that it shares a column with), and apart from these if
    it is of their largest component; blocks are paired if a column of several
    components has rows of both, but not two blocks of one component, nor of sizes
    that allow no link. So each pair of rows is looked at once, however many columns
    it shares.

    The smaller block of a pair goes to the larger one: ``i`` is a block, ``j`` is
    itself or stands for several smaller ones that it is paired with, about as many
    rows as it has. So the rows made are at most twice those of the smaller blocks
    of all pairs, and one copy of each block. A group is cut into SPREAD blocks at
    most until these are full."""
    placed = (members.select("key", "node").join(found, "node", "left")
              .select("key", "node", F.coalesce("component", "node").alias("comp")))
    comps = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    open_rows = materialise(placed.join(comps.filter("lo < hi").select("key"), "key"), "open")
    home = (open_rows.join(centres.select("key", "a", "centre_score"), "key").groupBy("node", "comp")
            .agg(F.max(F.struct("centre_score", "a")).alias("h")).select("node", "comp", F.col("h.a").alias("home")))
    home = materialise(home, "homes")
    at = open_rows.select("key", "node").join(home.select("node", "home"), "node").select("key", "home").distinct()
    at = at.join(home.groupBy("home").agg(F.count(F.lit(1)).alias("m")), "home")
    largest = at.groupBy("key").agg(F.max(F.struct("m", "home")).alias("to"))
    moves = at.join(largest, "key").groupBy("home").agg(F.max("to").alias("to")).select("home", F.col("to.home").alias("into"))
    home = (home.join(moves, "home").select("node", "comp", F.col("into").alias("home"))
            .join(nodes.select("node", F.col("n").alias("items")), "node")
            # Sizes of a link differ by 1.25 at most, so by one class of 1.26 at most.
            .withColumn("scale", F.floor(F.log("items") / F.log(F.lit(1.26))).cast("int")))
    sizes = home.groupBy("home", "scale", "comp").agg(F.count(F.lit(1)).alias("m"), F.sum("items").alias("items"))
    main = (sizes.groupBy("home", "scale").agg(F.max(F.struct("m", "comp")).alias("main"))
            .select("home", "scale", F.col("main.comp").alias("main")))
    parts = (sizes.join(main, ["home", "scale"]).groupBy("home", "scale", (F.col("comp") == F.col("main")).alias("is_main"))
             .agg(F.sum("m").alias("m"), F.sum("items").alias("items"))
             .select("home", "scale", "is_main", F.expr(
                 f"cast(ceil(greatest(least(m / {block_rows}, {SPREAD}), m / {FULL * block_rows}, items / {BLOCK_ITEMS})) as int)").alias("blocks")))
    lying = (home.join(main, ["home", "scale"]).withColumn("is_main", F.col("comp") == F.col("main"))
             .join(parts, ["home", "scale", "is_main"])
             .select("node", "comp", "scale", "items", F.xxhash64("home", "scale", "is_main", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("own"),
                     F.when(F.col("is_main"), F.col("comp")).alias("only")))
    lying = materialise(lying, "blocks")
    seen = open_rows.select("key", "node").join(lying, "node").select("key", "own", "only", "scale").distinct()
    left = seen.select("key", F.col("own").alias("i"), F.col("only").alias("only_i"), F.col("scale").alias("scale_i"))
    right = seen.select("key", F.col("own").alias("j"), F.col("only").alias("only_j"), F.col("scale").alias("scale_j"))
    met = (left.join(right, "key").filter("i <= j AND abs(scale_i - scale_j) <= 1 AND NOT coalesce(only_i = only_j, false)")
           .select("i", "j").distinct())
    blocks = lying.groupBy("own").agg(F.count(F.lit(1)).alias("m"), F.sum("items").alias("items"))
    one, two = (blocks.select(F.col("own").alias(c), F.struct("m", "items", "own").alias(f"block_{c}")) for c in "ij")
    met = met.join(one, "i").join(two, "j").select(F.greatest("block_i", "block_j").alias("big"), F.least("block_i", "block_j").alias("small"))
    met = materialise(met.select(F.col("big.own").alias("i"), F.col("big.m").alias("m"), "small"), "met")
    packs = met.filter("i <> small.own").groupBy("i").agg(F.expr(
        f"ceil(greatest(sum(small.m) / greatest(first(m), {block_rows}), sum(small.items) / {BLOCK_ITEMS}))").alias("packs"))
    dealt = met.join(packs, "i", "left").select("i", F.col("small.own").alias("block"), F.when(F.col("i") == F.col("small.own"), F.col("i")).otherwise(
        F.xxhash64("i", F.pmod(F.xxhash64("small.own"), F.col("packs")))).alias("j"))
    firsts = dealt.filter("i <> j").select("i", "j", F.col("i").alias("own"), F.col("i").alias("block")).distinct()
    sides = dealt.select("i", "j", F.col("j").alias("own"), "block").union(firsts)
    return sides.join(lying.select("node", "comp", F.col("own").alias("block")), "block").drop("block")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs``.

    Two documents are linked if their shingle sets have a Jaccard index of 0.8
    or more (100 |a & b| >= 80 |a or b|); component_id is the smallest doc_id
    reachable over links. Words are runs of other than ASCII blanks, A-Z
    lower-cased; fewer than five are one shingle. Null texts and texts without
    words have no shingles, are linked with nothing and keep their own id.
    Repeated rows are linked like copies, also under one id. Null ids are left
    out of the minimum (a component without any id has none). Other columns are
    ignored; an empty table gives no rows. Shingles are told apart by 64-bit hashes.
    """
    with shuffles_removed(docs.sparkSession):
        signed, nodes, found = _classes(docs, doc_id, text, block_rows)
    named = found.join(nodes.select("node", "digest", "first_id"), "node")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = named.join(smallest, "component").select("digest", "component_id")
    owners = nodes.select("digest", "first_id").join(classes, "digest", "left").select(
        "digest", F.coalesce("component_id", "first_id").alias("component_id"))
    return (signed.select("doc_id", "digest", F.col("n").alias("n_shingles")).join(owners, "digest", "left")
            .select("doc_id", "n_shingles", F.when(F.col("digest").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id")))


def _classes(docs: DataFrame, doc_id: str, text: str, block_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, digest, n) of the documents, (node, digest, first_id, ...) of the
    rows of the matrix, (node, component) of those that are linked; all written."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(slot_classes(docs.select(text)))  # 16 MB at any size
    signed = materialise(sign_documents(docs, doc_id, text, table), "signed")
    table.destroy()
    nodes = (signed.filter("digest IS NOT NULL").groupBy("digest")
             .agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"),
                  F.first("lead").alias("lead"), F.first("usual").alias("usual"), F.first("cut").alias("cut"))
             .withColumn("node", F.monotonically_increasing_id()))
    fat = stored_tables()[-1]
    nodes = materialise(nodes, "nodes")
    signed = materialise(signed.select("doc_id", "digest", "n"), "rows")
    drop_stored(spark, [fat])  # the prefixes are with the nodes now
    columns = _shared_columns(nodes)
    members = columns.filter("short")

    def compared(pairs: DataFrame) -> DataFrame:
        """The links of the pairs, written."""
        rows = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = _sets_of(rows, nodes, docs, doc_id, text)
        written = stored_tables()[-1]
        near = materialise(_linked(pairs, sets), "links")
        drop_stored(spark, [written])
        return near

    # The row that meets the others most often is the likeliest origin of its
    # copies. Rows that share enough columns with it are compared; all other
    # pairs are left to the steps below.
    score = members.groupBy("node").agg(F.sum((F.col("size") - 1) * F.col("times")).alias("score"))
    centres = (members.join(score, "node").groupBy("key").agg(F.max(F.struct("score", "node", "n")).alias("c"))
               .select("key", F.col("c.node").alias("a"), F.col("c.n").alias("centre_n"),
                       F.col("c.score").alias("centre_score")))
    centres = materialise(centres, "centres")
    rest = F.expr("greatest(n - least(n, n div 5 + 1), centre_n - least(centre_n, centre_n div 5 + 1))")
    pairs = (members.join(centres, "key").filter("node <> a AND 5 * least(n, centre_n) >= 4 * greatest(n, centre_n)")
             .groupBy("a", F.col("node").alias("b"), "n", "centre_n").agg(F.sum("times").alias("shared"))
             .filter(9 * (F.col("shared") + rest) >= 4 * (F.col("n") + F.col("centre_n"))).select("a", "b"))
    near = compared(materialise(pairs, "pairs"))
    found = materialise(connected_components(near), "classes")

    pairing, others = _open_columns(columns, found, nodes)
    pairs = materialise(_likely_pairs(pairing), "pairs")
    if not pairs.isEmpty():
        near = near.union(compared(pairs))
        found = materialise(connected_components(near), "classes")
    members = materialise(members.join(others, "key", "left_semi"), "members")
    if not members.isEmpty():
        more = _block_links(members, centres, found, nodes, docs, doc_id, text, block_rows)
        if not more.isEmpty():
            found = materialise(connected_components(near.union(more)), "classes")
    return signed, nodes, found


def _block_links(members: DataFrame, centres: DataFrame, found: DataFrame, nodes: DataFrame, docs: DataFrame,
                 doc_id: str, text: str, block_rows: int) -> DataFrame:
    """(src, dst): links of rows of different components that meet in columns of ``members``, by products of blocks."""
    spark = docs.sparkSession
    pairs = _open_blocks(members, centres, found, nodes, block_rows)
    rows = pairs.join(nodes.select("node", "n", "cut", "prefix"), "node")

    def promising(i: int, j: int, left: Block, right: Block) -> list[tuple]:
        kept = set()
        for one, two in _tile_pairs(left, right):
            may = may_link(one, two)
            kept |= {(i, j, i, int(x)) for x in one.node[may.any(axis=1)]} | {(i, j, j, int(y)) for y in two.node[may.any(axis=0)]}
        return sorted(kept)

    likely = _by_blocks(rows, "prefix", promising, "i long, j long, own long, node long")
    likely = materialise(likely, "likely")
    sets = _sets_of(likely.select("node").distinct(), nodes, docs, doc_id, text)
    written = stored_tables()[-1]
    whole = (likely.join(found, "node", "left").withColumn("comp", F.coalesce("component", "node"))
             .join(sets, "node").select("i", "j", "own", "node", "comp", "n", "items"))
    more = materialise(_by_blocks(whole, "items", lambda i, j, left, right: links(left, right), "src long, dst long"), "links")
    drop_stored(spark, [written])
    return more
