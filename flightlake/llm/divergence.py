"""How far sources of a language differ in their words: pairwise prices over
hash-consed segment trees.

The kept terms of a language are numbered by falling frequency, so that rare
terms, whose counts are mostly 0 or 1, lie side by side. A group's counts over
the numbers are a segment tree, cut into blocks of a fixed width. In a block
the trees of all groups are built together, level by level, and equal subtrees
are one node. Two groups are compared by walking both trees at once: at each
level equal node pairs of a group pair are merged and counted, so that a node
pair is expanded and priced once, however often it occurs. Blocks are priced by
different tasks and summed. All arithmetic is in integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.common import materialise
from flightlake.llm.running import running

#: Documents of a language that must hold a kept term.
MIN_DOCS = 3
#: Terms of a block (a power of two) and groups that are compared in one task with as many others.
BLOCK_TERMS, BUCKET_GROUPS = 4096, 64
#: Leaves that group pairs walked together may reach.
FRONTIER = 1 << 21
#: Entries of a task's table of counts before it is handed on.
HELD_TERMS = 500_000
SCALE = 1_000_000_000

# A-Z in lower case; other ASCII but letters separates.
_TO_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters (lower-cased) and non-ASCII characters."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_TERM).split() if text else []


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in
    each group; a row with null term for every group, with or without terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs_of) in held.items():
                names = [None, *(t.decode("utf-8", "replace") for t in n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names)), pa.array([source] * len(names)), pa.array(names, pa.string()),
                     pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs_of[t] for t in n)], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                n, docs_of = held.setdefault((lang or "", source or ""), (Counter(), Counter()))
                size -= len(n)
                found = terms(text)
                n.update(found)
                docs_of.update(set(found))
                size += len(n)
                if size >= HELD_TERMS:
                    yield from flush()
                    size = 0
        yield from flush()

    rows = docs.select("lang", "source", "text").mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE (count + 1) / total), exact at any count."""
    if int(count.max(initial=0)) < (1 << 62) // SCALE:
        return 1 + SCALE * (count + 1) // total
    return np.array([1 + SCALE * (int(c) + 1) // int(t) for c, t in zip(*np.broadcast_arrays(count, total))], dtype=np.int64)


class SharedTrees:
    """Segment trees of the rows of a matrix of counts (its width a power of
    two). A node is its number among the distinct subtrees of its height;
    ``kids[h]`` are the (left, right) nodes of those of height h + 1."""

    def __init__(self, counts: np.ndarray):
        self.values, nodes = np.unique(counts, return_inverse=True)
        nodes = nodes.reshape(counts.shape)
        self.kids: list[tuple[np.ndarray, np.ndarray]] = []
        distinct = len(self.values)
        while nodes.shape[1] > 1:
            pair, inverse = np.unique(nodes[:, 0::2] * np.int64(distinct) + nodes[:, 1::2], return_inverse=True)
            self.kids.append(np.divmod(pair, distinct))
            nodes, distinct = inverse.reshape(len(nodes), -1), len(pair)
        self.roots = nodes[:, 0]

    def walk(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, ...]:
        """(pair, count, count, how often) for pairs of rows: the distinct leaf
        pairs of the two trees and the number of places where each stands."""
        pair, x, y = np.arange(len(left)), self.roots[left], self.roots[right]
        times = np.ones(len(left), dtype=np.int64)
        for lefts, rights in reversed(self.kids):
            pair, times = np.concatenate([pair, pair]), np.concatenate([times, times])
            x, y = np.concatenate([lefts[x], rights[x]]), np.concatenate([lefts[y], rights[y]])
            base = int(max(x.max(), y.max())) + 1
            key = (pair * base + x) * base + y
            order = np.argsort(key, kind="stable")
            key = key[order]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            pair, x, y = pair[order[starts]], x[order[starts]], y[order[starts]]
            times = np.add.reduceat(times[order], starts)
        return pair, self.values[x], self.values[y], times


def pair_prices(counts: np.ndarray, totals: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of floor((p - q)^2 / q) over the columns: of each left row against
    its right one, and the other way round. ``totals``: N + V of each row."""
    trees = SharedTrees(counts)
    there, back = np.zeros(len(left), dtype=np.int64), np.zeros(len(left), dtype=np.int64)
    step = max(1, FRONTIER // counts.shape[1])
    for at in range(0, len(left), step):
        a, b = left[at:at + step], right[at:at + step]
        pair, x, y, times = trees.walk(a, b)
        p, q = share(x, totals[a[pair]]), share(y, totals[b[pair]])
        gap = (p - q) * (p - q)
        np.add.at(there, at + pair, gap // q * times)
        np.add.at(back, at + pair, gap // p * times)
    return there, back


def _block_prices(table: pa.Table) -> pa.Table:
    """(lang, source, item, value): what one block of terms adds to the pairs of two buckets of groups."""
    rows = table.to_pylist()
    rows.sort(key=lambda r: r["g"])
    width = rows[0]["width"]
    # The last block may be narrower than a power of two; trees are padded, and the padding's price taken off.
    padded = 1 << max(0, width - 1).bit_length()
    counts = np.zeros((len(rows), padded), dtype=np.int64)
    for i, r in enumerate(rows):
        if r["at"]:
            counts[i, r["at"]] = r["n"]
    totals = np.array([r["total"] for r in rows], dtype=np.int64)
    bucket = np.array([r["bucket"] for r in rows])
    left, right = np.triu_indices(len(rows), 1)
    if rows[0]["i"] != rows[0]["j"]:
        across = bucket[left] != bucket[right]
        left, right = left[across], right[across]
    there, back = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    if len(left) and width:
        there, back = pair_prices(counts, totals, left, right)
        if padded > width:
            none = np.zeros(len(left), dtype=np.int64)
            p, q = share(none, totals[left]), share(none, totals[right])
            there -= (padded - width) * ((p - q) * (p - q) // q)
            back -= (padded - width) * ((p - q) * (p - q) // p)
    names = np.array([r["source"] for r in rows], dtype=object)
    return pa.table({"lang": pa.array([rows[0]["lang"]] * (2 * len(left)), pa.string()),
                     "source": pa.array([*names[left], *names[right]], pa.string()),
                     "item": pa.array([*names[right], *names[left]], pa.string()),
                     "value": pa.array(np.concatenate([there, back]), pa.int64())})


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = 200, block_terms: int = BLOCK_TERMS,
                  bucket_groups: int = BUCKET_GROUPS) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (lang, source, text).

    A language keeps the V terms found in ``min_docs`` of its documents. A group
    (lang, source), and the language itself, gives each of them p = 1 +
    floor(1e9 (count + 1) / (N + V)), N being its number of kept occurrences. Part
    ``pair`` has each other source of the language with the sum over the kept
    terms of floor((p - q)^2 / q), q that source's; part ``term`` the
    ``top_terms`` terms that the group uses more than the language (q the
    language's) by their own such value. Ranks fall by value, ties by item.

    Null lang, source and text are empty; a group without terms has its pairs,
    one that is alone in its language has none. Repeated rows count each.
    Other columns are ignored; an empty table gives no rows.

    A hot group is counted in every task before its counts meet; what comes
    after the counts has a row a term and group at most. The pairs are the
    result itself: ``bucket_groups`` sources of a language meet as many others in
    a task, for one block of terms."""
    counts = materialise(term_counts(docs), "counts")
    seen = counts.filter("term IS NOT NULL")
    kept = (seen.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all"))
            .filter(F.col("docs") >= min_docs).select("lang", "term", "all"))
    order = [F.desc("all"), F.col("term")]
    vocabulary = running(kept, ["lang"], [F.desc("all"), F.substring("term", 1, 32)], order, name="vocabulary")
    cells = seen.join(vocabulary, ["lang", "term"]).select(
        "lang", "source", "term", "n", "all", (F.col("nth") - 1).alias("id"))
    cells = materialise(cells, "cells")

    langs = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all").alias("lang_n"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    zero = F.lit(0).cast("long")
    groups = (counts.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", F.coalesce("group_n", zero).alias("group_n"), F.coalesce("v", zero).alias("v"),
                      F.coalesce("lang_n", zero).alias("lang_n"),
                      (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("g"),
                      F.count(F.lit(1)).over(Window.partitionBy("lang")).alias("sources")))
    groups = materialise(groups, "groups")

    # A row for each group and block of terms, also where the group has none of them.
    blocks = F.greatest(F.ceil(F.col("v") / block_terms), F.lit(1))
    headers = (groups.withColumn("block", F.explode(F.sequence(zero, blocks - 1)))
               .withColumn("width", F.least(F.lit(block_terms), F.col("v") - F.col("block") * block_terms).cast("int")))
    filled = (cells.groupBy("lang", "source", F.expr(f"id div {block_terms}").alias("block"))
              .agg(F.collect_list(F.struct((F.col("id") % block_terms).cast("int").alias("at"), "n")).alias("cell")))
    bucket = F.expr(f"cast(g div {bucket_groups} as int)")
    others = F.explode(F.sequence(F.lit(0), F.expr(f"cast((sources - 1) div {bucket_groups} as int)")))
    dealt = (headers.join(filled, ["lang", "source", "block"], "left")
             .withColumn("bucket", bucket).withColumn("x", others)
             .select("lang", "block", F.least("bucket", "x").alias("i"), F.greatest("bucket", "x").alias("j"), "bucket",
                     "g", "source", "width", (F.col("group_n") + F.col("v")).alias("total"),
                     F.col("cell.at").alias("at"), F.col("cell.n").alias("n")))
    prices = dealt.groupBy("lang", "block", "i", "j").applyInArrow(
        _block_prices, "lang string, source string, item string, value long")
    pairs = prices.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    def p(count: str, total: str) -> str:
        return f"1 + (cast({SCALE} as decimal(10, 0)) * ({count} + 1)) div ({total} + v)"

    own = (cells.join(groups.select("lang", "source", "group_n", "lang_n", "v"), ["lang", "source"])
           .withColumns({"p": F.expr(p("n", "group_n")), "q": F.expr(p("`all`", "lang_n"))})
           .filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value")))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    top = own.withColumn("rank", rank).filter(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    return pairs.withColumn("rank", rank).withColumn("part", F.lit("pair")).select(*columns).union(top.select(*columns))
