"""Near-duplicates by BagMinHash: weighted-Jaccard signatures of word shingles.

A text is a bag: its shingles of five words, each weighing as often as it
occurs. Weights are discretised to unit levels, and the levels of a shingle are
covered by dyadic blocks [0,1), [1,2), [2,4), [4,8), ... Each block is a Poisson
process, seeded by shingle and block, whose rate is its length; every point
carries a time, a register and a level. A text owns the points at levels below
its weight (a whole block at once, a last one thinned by level), and a register
of its signature is the earliest point there. Two texts agree in a register with
probability sum min / sum max of their weights. Points are made in time order
and only up to the time by which all registers are filled, so that a signature
costs little more than one look at each shingle.

Signatures are cut into bands; texts that share a band are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import materialise, mix64, window_hashes, words
from flightlake.llm.components import connected_components
from flightlake.llm.decontam import chunks, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: Bands of ROWS registers: at similarity 0.8 a pair shares none with
#: probability (1 - 0.8^4)^25 < 2e-6.
BANDS, ROWS = 25, 4
REGISTERS = BANDS * ROWS
#: Members of a block, beside the bound on their items.
BLOCK_ROWS = 2_000

_TIME, _REGISTER, _LEVEL = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def shingle_bag(text: str | None, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingle hashes, counts). A text of fewer words than ``k``, but
    not none, is one shingle."""
    h = word_hashes(words(text))
    if not len(h):
        return h, np.zeros(0, np.int64)
    return np.unique(mix64(window_hashes(h, min(k, len(h)))), return_counts=True)


def bag_items(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bag as a set: hashes of (shingle, occurrence), so that the Jaccard
    index of two such sets is the weighted one of the bags."""
    at = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
    return mix64(shingles[at] + nth.astype(np.uint64) * _LEVEL)


def _blocks(bags: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """All (text, seed, rate, first level, weight) of the blocks of some bags."""
    doc = np.repeat(np.arange(len(bags)), [len(s) for s, _ in bags])
    shingle = np.concatenate([s for s, _ in bags])
    weight = np.concatenate([c for _, c in bags]).astype(np.int64)
    parts = []
    low, b = 0, 0
    while len(doc):
        rate = 1 if b == 0 else 1 << (b - 1)
        seed = mix64(shingle + np.full(1, b + 1, np.uint64) * _TIME)
        parts.append((doc, seed, np.full(len(doc), float(rate)), np.full(len(doc), low, np.int64), weight))
        low, b = low + rate, b + 1
        more = weight > low
        doc, shingle, weight = doc[more], shingle[more], weight[more]
    return tuple(np.concatenate(x) for x in zip(*parts))


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """One row of ``registers`` point hashes for each (non-empty) bag."""
    out = np.zeros((len(bags), registers), dtype=np.uint64)
    doc, seed, rate, low, weight = _blocks(bags)
    total = np.array([c.sum() for _, c in bags], dtype=float)
    limit = registers / total * (np.log(registers) + 3.0)  # filled by then, with 5 % exceptions
    waiting = np.arange(len(bags))
    with np.errstate(over="ignore"):
        while len(waiting):
            place, time, point = _points(doc, seed, rate, low, weight, limit, registers)
            first = np.full(len(bags) * registers, np.inf)
            np.minimum.at(first, place, time)
            earliest = time == first[place]
            found = np.zeros(len(bags) * registers, dtype=np.uint64)
            found[place[earliest]] = point[earliest]
            filled = np.isfinite(first).reshape(len(bags), registers).all(axis=1)
            done = waiting[filled[waiting]]
            out[done] = found.reshape(len(bags), registers)[done]
            waiting = waiting[~filled[waiting]]
            limit[waiting] *= 2.0
            again = np.isin(doc, waiting)
            doc, seed, rate, low, weight = (x[again] for x in (doc, seed, rate, low, weight))
    return out


def _points(doc, seed, rate, low, weight, limit, registers) -> tuple[np.ndarray, ...]:
    """(text x registers + register, time, hash) of all points up to each text's limit."""
    kept = []
    live = np.arange(len(doc))
    time = np.zeros(len(doc))
    step = np.uint64(0)
    while len(live):
        step += np.uint64(1)
        h = mix64(seed[live] + step * _TIME)
        time = time - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate[live]
        inside = time <= limit[doc[live]]
        live, time, h = live[inside], time[inside], h[inside]
        own = np.arange(len(live))
        thinned = np.flatnonzero(weight[live] < low[live] + rate[live])  # the last block of a weight
        if len(thinned):
            some = live[thinned]
            level = low[some] + ((mix64(h[thinned] ^ _LEVEL) >> np.uint64(32)) * rate[some].astype(np.uint64)
                                 >> np.uint64(32)).astype(np.int64)
            own = np.delete(own, thinned[level >= weight[some]])
        register = (mix64(h[own] ^ _REGISTER) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)
        kept.append((doc[live[own]] * registers + register.astype(np.int64), time[own], h[own]))
    return tuple(np.concatenate(x) for x in zip(*kept))


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """64-bit keys of the bands of each signature, as signed numbers."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _LEVEL, parts.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix64(key * _REGISTER + parts[:, :, r])
    return key.view(np.int64)


def _bag_digest(text: str | None, bag: tuple[np.ndarray, np.ndarray]) -> bytes | None:
    """Equal for equal bags; texts without words are alike if equal; null: none."""
    if text is None:
        return None
    if not len(bag[0]):
        return xxhash.xxh3_128_digest(b"text" + text.encode("utf-8", "surrogatepass"))
    return xxhash.xxh3_128_digest(b"bag" + bag[0].tobytes() + bag[1].astype(np.int64).tobytes())


def sign_texts(docs: DataFrame, doc_id: str, text: str, row: Column) -> DataFrame:
    """(doc_id, row, bag, n, bands): digest and total weight of the bag, band keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            digests, sizes, keys = [], [], []
            for part in chunks(texts, 1 << 20):
                bags = [shingle_bag(t) for t in part]
                some = [i for i, b in enumerate(bags) if len(b[0])]
                bands = [[] for _ in part]
                if some:
                    for i, k in zip(some, band_keys(signatures([bags[i] for i in some])).tolist()):
                        bands[i] = k
                digests += [_bag_digest(t, b) for t, b in zip(part, bags)]
                sizes += [int(c.sum()) for _, c in bags]
                keys += bands
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(digests, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "row", "bag", "n", "bands"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), row.alias("row"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sign, f"doc_id {kind}, row long, bag binary, n long, bands array<long>")


def bag_sets(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, bag, items): the whole bag of each text as a set of hashes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            bags = [shingle_bag(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([_bag_digest(t, b) for t, b in zip(texts, bags)], pa.binary()),
                 pa.array([bag_items(*b).view(np.int64) for b in bags], pa.list_(pa.int64()))],
                names=["doc_id", "bag", "items"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(build, f"doc_id {kind}, bag binary, items array<long>")


def _links_of_blocks(table: pa.Table, threshold: float) -> list[tuple[int, int]]:
    """Links between the members of a bucket that are in different classes, for
    one pair of its blocks. A pair that an earlier band also brings together is
    left to that band; links that join nothing new are left out."""
    rows = table.to_pylist()
    rows.sort(key=lambda r: r["node"])
    key, i, j = rows[0]["key"], rows[0]["i"], rows[0]["j"]
    if len({r["block"] for r in rows}) < (1 if i == j else 2):
        return []  # one of the blocks is empty
    bands = np.array([r["bands"] for r in rows], dtype=np.int64)
    band = int(np.flatnonzero(bands[0] == key)[0])
    side = np.array([r["block"] for r in rows])
    size = np.array([r["n"] for r in rows], dtype=np.int64)
    parent = {r["comp"]: r["comp"] for r in rows}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    # Bit sets over the items that several members have.
    flat = np.concatenate([np.array(r["items"], dtype=np.int64) for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r["items"]) for r in rows])
    _, item, uses = np.unique(flat, return_inverse=True, return_counts=True)
    shared = uses > 1
    number = np.cumsum(shared) - 1
    width = int(shared.sum())
    use = shared[item]
    words64 = -(-max(1, width) // 64)
    bits = np.zeros((len(rows), words64), dtype=np.uint64)
    column = number[item[use]]
    np.bitwise_or.at(bits, (owner[use], column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    found = []
    right = np.flatnonzero(side == j)
    for x in np.flatnonzero(side == i).tolist():
        others = right[right > x] if i == j else right
        comp_x = root(rows[x]["comp"])
        others = np.array([y for y in others.tolist() if root(rows[y]["comp"]) != comp_x], dtype=np.int64)
        small, large = np.minimum(size[others], size[x]), np.maximum(size[others], size[x])
        others = others[small >= threshold * large - 1e-9]
        others = others[~(bands[others, :band] == bands[x, :band]).any(axis=1)]
        if not len(others):
            continue
        common = np.bitwise_count(bits[others] & bits[x]).sum(axis=1).astype(np.int64)
        for y in others[common / (size[others] + size[x] - common) >= threshold].tolist():
            a, b = root(rows[x]["comp"]), root(rows[y]["comp"])
            if a != b:
                parent[max(a, b)] = min(a, b)
                found.append((rows[x]["node"], rows[y]["node"]))
    return found


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    threshold: float = SIMILARITY, block_items: int = 400_000) -> DataFrame:
    """(doc_id, class_id, n_shingles), one row for each row of ``docs``.

    Texts whose bags of five-word shingles have a weighted Jaccard index of
    ``threshold`` or more are linked; class_id is the smallest doc_id among
    those that links connect. Words are ASCII lower-cased runs of digits,
    letters and non-ASCII characters; a text of one to four words is one
    shingle. Texts without words are alike only if they are equal, a null text
    is alike to none (class_id is its own id). Repeated rows get equal classes;
    null ids are left out of the minimum (a class without any id has none).

    Equal bags are one node. Nodes that share a band are candidates. First each
    bucket's members are compared with its most connected member; then, in
    buckets whose members are still of several classes, pairs of different
    classes, block against block; the largest class of a bucket is not paired
    with itself, so that one foreign member costs one look at the others. Whatever
    the size of a bucket, a task holds two blocks of about ``block_items`` items
    and at most some BLOCK_ROWS members, and only links leave it.
    """
    rows = _classed_rows(docs, doc_id, text, threshold, block_items, F.monotonically_increasing_id())
    return rows.select("doc_id", "class_id", "n_shingles")


def _classed_rows(docs: DataFrame, doc_id: str, text: str, threshold: float, block_items: int,
                  row: Column) -> DataFrame:
    """(doc_id, row, class_id, n_shingles, kept): ``kept`` is the row number of
    the class's first row by (doc_id, nulls last; row number), null for a null text."""
    signed = materialise(sign_texts(docs, doc_id, text, row), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    nodes = (signed.filter("bag IS NOT NULL").groupBy("bag")
             .agg(F.min("doc_id").alias("first_id"), first.alias("first"),
                  F.first("n").alias("n"), F.first("bands").alias("bands"))
             .withColumn("node", F.monotonically_increasing_id()))
    nodes = materialise(nodes, "bags")

    members = nodes.select("node", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialise(members.join(buckets, "key"), "members")
    # The member that collides most often is the likeliest origin of its copies.
    score = members.groupBy("node").agg(F.sum(F.col("size") - 1).alias("score"))
    centres = (members.join(score, "node").groupBy("key")
               .agg(F.max(F.struct("score", (-F.col("node")).alias("m"))).alias("c"))
               .select("key", (-F.col("c.m")).alias("centre")))
    pairs = members.join(centres, "key").filter("node <> centre").select("centre", "node").distinct()

    # Whole bags of the nodes that collide: each one's items, once.
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi")
    ids = wanted.select(F.col("first_id").alias("w"))
    sources = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sources = sources.join(ids, F.col("doc_id").eqNullSafe(F.col("w")), "left_semi")
    sets = bag_sets(sources, "doc_id", "text").select("bag", "items").dropDuplicates(["bag"])
    sets = materialise(wanted.join(sets, "bag").select("node", "n", "bands", "items"), "items")

    left = sets.select(F.col("node").alias("centre"), F.col("n").alias("n1"), F.col("items").alias("items1"))
    common = F.size(F.array_intersect("items1", "items"))
    links = (pairs.join(sets.select("node", "n", "items"), "node").join(left, "centre")
             .filter(F.least("n", "n1") >= threshold * F.greatest("n", "n1") - 1e-9)
             .withColumn("common", common)
             .filter(F.col("common") / (F.col("n") + F.col("n1") - F.col("common")) >= threshold)
             .select(F.col("centre").alias("src"), F.col("node").alias("dst")))
    links = materialise(links, "links")
    found = materialise(connected_components(links), "classes")

    placed = (members.join(found, "node", "left").withColumn("comp", F.coalesce("component", "node"))
              .join(nodes.select("node", "n"), "node").select("key", "node", "comp", "n"))
    parts = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("items"))
    largest = F.max(F.struct("m", "comp", "items"))
    blocks_of = "cast(ceil(greatest({items} / {block_items}, {m} / {rows})) as int)"
    open_keys = (parts.groupBy("key").agg(largest.alias("top"), F.sum("m").alias("m"), F.sum("items").alias("items"),
                                          F.count(F.lit(1)).alias("comps"))
                 # A bucket of two has no pair but the one compared.
                 .filter("comps > 1 AND m > 2")
                 .select("key", F.col("top.comp").alias("main"),
                         F.expr(blocks_of.format(items="top.items", m="top.m", block_items=block_items, rows=BLOCK_ROWS))
                         .alias("main_blocks"),
                         F.expr(blocks_of.format(items="(items - top.items)", m="(m - top.m)", block_items=block_items,
                                                 rows=BLOCK_ROWS)).alias("blocks")))
    # The largest class of a bucket is never paired with itself: blocks of the
    # others meet each other and the blocks of that class.
    dealt = (placed.join(open_keys, "key").withColumn("is_main", F.expr("comp = main"))
             .withColumn("own", F.expr("cast(pmod(xxhash64(node), if(is_main, main_blocks, blocks)) as int)"))
             .withColumn("meets", F.expr("if(is_main, transform(sequence(0, blocks - 1), x -> struct(x AS i, -1 - own AS j)), "
                                         "concat(transform(sequence(0, blocks - 1), x -> struct(least(own, x) AS i, "
                                         "greatest(own, x) AS j)), transform(sequence(0, main_blocks - 1), "
                                         "x -> struct(own AS i, -1 - x AS j))))"))
             .select("key", "node", "comp", F.expr("if(is_main, -1 - own, own)").alias("block"), F.explode("meets").alias("m"))
             .select("key", "node", "comp", "block", "m.i", "m.j"))
    grouped = dealt.join(sets.select("node", "n", "bands", "items"), "node")

    def compare(table: pa.Table) -> pa.Table:
        links = _links_of_blocks(table, threshold)
        return pa.table({"src": pa.array([a for a, _ in links], pa.int64()),
                         "dst": pa.array([b for _, b in links], pa.int64())})

    more = materialise(grouped.groupBy("key", "i", "j").applyInArrow(compare, "src long, dst long"), "links")
    if not more.isEmpty():
        found = materialise(connected_components(links.union(more)), "classes")

    firsts = found.join(nodes.select("node", "first"), "node")
    smallest = firsts.groupBy("component").agg(F.min("first").alias("smallest"))
    linked = firsts.join(smallest, "component").select("node", "smallest")
    classes = (nodes.select("bag", "node", "first").join(linked, "node", "left")
               .withColumn("first", F.coalesce("smallest", "first"))
               .select("bag", F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("kept")))
    classes = materialise(classes, "classes")
    return (signed.select("doc_id", "row", "bag", F.col("n").alias("n_shingles")).join(classes, "bag", "left")
            .select("doc_id", "row", F.when(F.col("bag").isNull(), F.col("doc_id"))
                    .otherwise(F.col("class_id")).alias("class_id"), "n_shingles", "kept"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         threshold: float = SIMILARITY, block_items: int = 400_000,
                         null_ids_stay: bool = True) -> DataFrame:
    """One row of each class: the first by (doc_id, nulls last), of rows with
    the same id any one. The choice is by row: equal ids of different classes do
    not touch each other, repeated rows are copies. Null texts stay, they are
    alike to none. ``null_ids_stay``: rows without an id are nobody's copies;
    otherwise they are dropped like all others."""
    numbered = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    rows = _classed_rows(numbered, doc_id, text, threshold, block_items, F.col("__row"))
    surplus = rows.filter("row <> kept")
    if null_ids_stay:
        surplus = surplus.filter("doc_id IS NOT NULL")
    surplus = materialise(surplus.select(F.col("row").alias("__row")), "surplus")
    return numbered.join(surplus, "__row", "left_anti").select(docs.columns)
