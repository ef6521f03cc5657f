"""Prefix trie of conversations, rolled up over a centroid decomposition.

Every distinct sequence of first turns is a node. A prefix is known by the xor
of hashes of (turn, depth), a running xor inside the conversation, so that no
task walks a conversation from its start. A node is named by its smallest
member and its depth.

Totals over subtrees come from a centroid decomposition of the parent-edge
forest. A component is split at its centroid, the deepest node that holds at
least half of the component's weight (a node weighs its members, so a subtree's
weight is a sum over members and needs no rollup). Above and at the centroid lie
the component's heavy nodes, one path up to its top. Every node of that path
gets the total of the component's part at or below the centroid; the centroid
leaves, and the parts below it and the rest above are components of at most
half the weight. Each pair of a node and a descendant is counted in the one
component where their path loses its centroid. Components that are small are
split in the same way inside a task, many at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import materialise
from flightlake.llm.running import running

#: Nodes of a component that one task splits to the end.
LOCAL_NODES = 20_000
#: Ids of a chunk of a node's list of members.
CHUNK_IDS = 4_096

_EMPTY = hashlib.sha256(b"").hexdigest()


def borrowed_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from its group's first one."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations with their length; their rebuilt turns with hashes)."""
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    short = [F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 32)]
    clean = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    placed = running(clean, ["conv_id"], short, order, name="turns").select(
        "conv_id", "nth", F.xxhash64(F.lit(1), "role", "text").alias("a"), F.xxhash64(F.lit(2), "role", "text").alias("b"),
        F.octet_length("text").cast("long").alias("bytes"))

    own = placed.groupBy("conv_id").agg(F.max("nth").alias("n"))
    heads = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    h = borrowed_turns(F.col("conv_id"))
    convs = (own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(heads, "base", "left")
             .select("conv_id", "base", h.alias("h"), F.least(h, F.coalesce("base_n", F.lit(0))).alias("taken"), "n")
             .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    convs = materialise(convs, "conversations")

    kept = (placed.join(convs.select("conv_id", "h", "taken", "length"), "conv_id").filter("nth > h")
            .select("conv_id", (F.col("taken") + F.col("nth") - F.col("h")).alias("depth"), "a", "b", "bytes", "length"))
    first = placed.filter("nth <= 8").withColumnRenamed("conv_id", "base")
    lent = (convs.filter("taken > 0").select("base", "conv_id", "taken", "length").join(first, "base")
            .filter("nth <= taken").select("conv_id", F.col("nth").alias("depth"), "a", "b", "bytes", "length"))
    rows = kept.union(lent).select("conv_id", "depth", F.xxhash64("a", "b", "depth").alias("ha"),
                                   F.xxhash64("b", "depth", "a").alias("hb"), "bytes", "length")
    return convs, rows


def member_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, pa, pb, ua, ub, bytes, length): every conversation at
    each of its depths from 0, with the prefix's key (pa, pb) and its parent's."""
    convs, rows = _rebuilt(turns)
    rows = rows.withColumns({"pa": F.col("ha"), "pb": F.col("hb")})
    keyed = running(rows, ["conv_id"], [F.col("depth")], [F.col("depth")], ["pa", "pb"], name="prefixes")
    none = F.lit(0).cast("long")
    roots = convs.select("conv_id", none.alias("depth"), none.alias("pa"), none.alias("pb"), none.alias("ua"),
                         none.alias("ub"), none.alias("bytes"), "length")
    return roots.union(keyed.select("conv_id", "depth", "pa", "pb", F.col("pa").bitwiseXOR(F.col("ha")).alias("ua"),
                                    F.col("pb").bitwiseXOR(F.col("hb")).alias("ub"), "bytes", "length"))


def trie_nodes(members: DataFrame) -> DataFrame:
    """(conv_id, depth, parent, pa, pb, n_convs, weight, saved, n_children) of each node."""
    nodes = members.groupBy("depth", "pa", "pb").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
        F.first("ua").alias("ua"), F.first("ub").alias("ub"), F.first("bytes").alias("bytes"))
    nodes = materialise(nodes, "nodes")
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("pa").alias("ua"), F.col("pb").alias("ub"),
                      F.col("conv_id").alias("parent"))
    below = (nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("ua").alias("pa"),
                                               F.col("ub").alias("pb")).agg(F.count(F.lit(1)).alias("n_children")))
    return (nodes.join(up, ["depth", "ua", "ub"], "left").join(below, ["depth", "pa", "pb"], "left")
            .select("conv_id", "depth", "parent", "pa", "pb", "n_convs", "weight",
                    ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
                    F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children")))


def split_components(top: np.ndarray, parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Totals of ``values`` (a column each) over the subtrees inside each
    component. ``top``: index of the node's component top; ``parent``: index
    (-1 for a top); ``weight``: subtree weights inside the component."""
    total = np.zeros_like(values)
    top, weight = top.copy(), weight.copy()
    live = np.arange(len(top))
    while len(live):
        heavy = 2 * weight[live] >= weight[top[live]]
        path = live[heavy]
        inner = np.zeros(len(top), dtype=bool)  # has a heavy child in its component
        below = path[path != top[path]]
        inner[parent[below]] = True
        centroids = path[~inner[path]]
        is_centroid = np.zeros(len(top), dtype=bool)
        is_centroid[centroids] = True
        of = np.full(len(top), -1)  # centroid of the component with this top
        of[top[centroids]] = centroids

        # A node's new top is its nearest ancestor (or itself) that is a top or a centroid's child.
        own = (live == top[live]) | is_centroid[np.maximum(parent[live], 0)] & (parent[live] >= 0)
        jump = np.arange(len(top))
        jump[live[~own]] = parent[live[~own]]
        while True:
            further = jump[jump[live]]
            if (further == jump[live]).all():
                break
            jump[live] = further
        new = jump[live]

        lower = ~is_centroid[live] & (new != top[live])
        part = np.zeros_like(values)
        np.add.at(part, of[top[live[lower]]], values[live[lower]])
        part[centroids] += values[centroids]
        total[path] += part[of[top[path]]]
        shrunk = path[~is_centroid[path]]
        weight[shrunk] -= weight[of[top[shrunk]]]
        top[live] = new
        live = live[~is_centroid[live]]
    return total


def _finish(small: DataFrame) -> DataFrame:
    """Contributions (conv_id, depth, leaves, saved) inside components that fit a task."""
    columns = ["conv_id", "depth", "parent", "tc", "td", "weight", "leaves", "saved"]

    def solve(rows: np.ndarray) -> pa.RecordBatch:
        conv, depth, parent, tc, td, weight = rows[:6]
        names, code = np.unique(conv, return_inverse=True)
        wide = int(depth.max()) + 2
        key = code * wide + depth
        at = np.argsort(key)

        def find(c: np.ndarray, d: np.ndarray) -> np.ndarray:
            place = np.minimum(np.searchsorted(names, c), len(names) - 1)
            return at[np.minimum(np.searchsorted(key[at], place * wide + d), len(at) - 1)]

        top = find(tc, td)
        is_top = top == np.arange(len(top))
        up = np.where(is_top, -1, find(parent, depth - 1))
        total = split_components(top, up, weight, rows[6:].T.copy())
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (conv, depth, total[:, 0], total[:, 1])],
                                          names=["conv_id", "depth", "leaves", "saved"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(columns), 0), dtype=np.int64)
        for batch in batches:
            held = np.concatenate([held, np.array([batch.column(c).to_numpy() for c in columns], dtype=np.int64)], axis=1)
            if held.shape[1] >= 4 * LOCAL_NODES:  # all but the last component are whole
                tops = held[3:5]
                end = int(np.flatnonzero((tops != tops[:, -1:]).any(axis=0)).max(initial=-1)) + 1
                if end:
                    yield solve(held[:, :end])
                    held = held[:, end:]
        if held.shape[1]:
            yield solve(held)

    rows = small.withColumn("parent", F.coalesce("parent", F.lit(0).cast("long"))).select(*columns)
    rows = rows.repartition("tc", "td").sortWithinPartitions("tc", "td")
    return rows.mapInArrow(run, "conv_id long, depth long, leaves long, saved long")


def rollup(nodes: DataFrame, members: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens): totals over each node's subtree."""
    # The whole trie is one component; its top is the root, whose name is one value.
    root = nodes.filter("depth = 0").select(F.max("conv_id")).scalar()
    tree = nodes.select("conv_id", "depth", "parent", "weight", (F.col("n_children") == 0).cast("long").alias("leaves"),
                        "saved", root.alias("tc"), F.lit(0).cast("long").alias("td"))
    above = None  # where each conversation's own prefixes lie: built when a component is split by joins
    found = []
    while True:
        sizes = tree.groupBy("tc", "td").agg(F.max("weight").alias("all"), F.count(F.lit(1)).alias("size"))
        sizes = materialise(sizes, "components")
        small = tree.join(sizes.filter(F.col("size") <= local_nodes), ["tc", "td"])
        found.append(_finish(small))
        large = sizes.filter(F.col("size") > local_nodes)
        if large.isEmpty():
            break
        if above is None:
            owners = nodes.select("conv_id").distinct()
            names = nodes.select("depth", "pa", "pb", F.col("conv_id").alias("ac"), F.col("parent").alias("ap"))
            above = materialise(members.join(owners, "conv_id", "left_semi").join(names, ["depth", "pa", "pb"])
                                .select("conv_id", F.col("depth").alias("ad"), "ac", "ap"), "ancestors")
        big = tree.join(large.select("tc", "td", "all"), ["tc", "td"]).withColumn("heavy", F.expr("2 * weight >= all"))
        centre = (big.filter("heavy").groupBy("tc", "td")
                  .agg(F.max(F.struct("depth", "conv_id", "weight")).alias("x"))
                  .select("tc", "td", F.col("x.depth").alias("xd"), F.col("x.conv_id").alias("xc"), F.col("x.weight").alias("xw")))
        placed = (big.join(centre, ["tc", "td"]).withColumn("ad", F.col("xd") + 1)
                  .join(above, ["conv_id", "ad"], "left")
                  .withColumn("below", F.expr("depth > xd AND coalesce(ap = xc, false)"))
                  .withColumn("centroid", F.expr("depth = xd AND conv_id = xc")))
        placed = materialise(placed, "split")
        part = (placed.filter("below OR centroid").groupBy("tc", "td")
                .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
        found.append(placed.filter("heavy").select("conv_id", "depth", "tc", "td").join(part, ["tc", "td"])
                     .select("conv_id", "depth", "leaves", "saved"))
        tree = placed.filter("NOT centroid").select(
            "conv_id", "depth", "parent", F.expr("if(heavy, weight - xw, weight)").alias("weight"), "leaves", "saved",
            F.expr("if(below, ac, tc)").alias("tc"), F.expr("if(below, ad, td)").alias("td"))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every.groupBy("conv_id", "depth").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def end_digests(members: DataFrame) -> DataFrame:
    """(depth, pa, pb, ends_sha256) of the nodes where conversations end: SHA-256
    of their ids, ascending, comma-joined. Tasks join ids to chunks; the chunks
    of a node are hashed in order by one task that keeps only the hash's state."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["depth", "pa", "pb"]

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def chunk() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*(pa.array([x], pa.int64()) for x in (*node, ids[0])), pa.array([",".join(map(str, ids))])],
                names=[*key, "first", "ids"])

        for batch in batches:
            for *at, conv in zip(*(batch.column(c).to_pylist() for c in [*key, "conv_id"])):
                if at != node or len(ids) == CHUNK_IDS:
                    if ids:
                        yield chunk()
                    node, ids = at, []
                ids.append(conv)
        if ids:
            yield chunk()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for *at, text in zip(*(batch.column(c).to_pylist() for c in [*key, "ids"])):
                if at == node:
                    state.update(b"," + text.encode())
                else:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256(text.encode())
            yield _digest_rows(done, key)
        if node:
            yield _digest_rows([(*node, state.hexdigest())], key)

    ends = members.filter("depth = length").select(*key, "conv_id")
    chunks = (ends.repartitionByRange(parts, *key, "conv_id").sortWithinPartitions(*key, "conv_id")
              .mapInArrow(join_ids, "depth long, pa long, pb long, first long, ids string"))
    return (chunks.repartition(*key).sortWithinPartitions(*key, "first").select(*key, "ids")
            .mapInArrow(digest, "depth long, pa long, pb long, ends_sha256 string"))


def _digest_rows(rows: list[tuple], key: list[str]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([r[3] for r in rows], pa.string())], names=[*key, "ends_sha256"])


def conversation_trie(turns: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """The trie of all rebuilt conversations: (conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256) for each node.

    ``turns`` has conv_id, turn, role and text. Rows go by turn (null first),
    then role and text; null role or text is empty; rows without conv_id are
    left out; repeated rows are turns of their own. A conversation c starts with
    the first crc32(c) % 9 turns of c - c % 5 (all if there are fewer) and goes on
    with its own turns after as many. Without conversations there is no node.
    Other columns are ignored. Prefixes are told apart by 128-bit keys."""
    members = materialise(member_rows(turns.select("conv_id", "turn", "role", "text")), "members")
    nodes = materialise(trie_nodes(members), "trie")
    totals = rollup(nodes, members, local_nodes)
    return (nodes.join(totals, ["conv_id", "depth"]).join(end_digests(members), ["depth", "pa", "pb"], "left")
            .select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                    "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256")))
