"""Contiguous shards of near-equal byte size.

Law ``bytes``: rows are put in one global order, their sizes are summed as a
running total over that order, and the total is cut at equal targets. The
running total is made of per-partition totals (one small row each) and a sum
inside each partition, so no task ever sees more than its own range.

DataFrame functions only. Texts are moved once, by the range partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.common import materialise, without

_POS_BITS = 33  # monotonically_increasing_id: partition above, row below


def text_bytes(text: str = "text", overhead: int = 16) -> Column:
    """UTF-8 bytes of the text (null: none) plus a fixed overhead."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + F.lit(overhead)).cast("long")


def shard_documents(docs: DataFrame, num_shards: int = 40, size: Column | None = None,
                    order: list[str] | None = None, group: Column | None = None) -> DataFrame:
    """``docs`` with ``shard`` (0 to num_shards-1) and ``slot`` (0, 1, ... in it).

    Shards are contiguous in the order of ``order`` (default ``doc_id``; nulls
    first). With ``group`` the members of a group follow its first member, so a
    group is adjacent, and a cut inside a group no larger than the largest row
    moves to the group's start: each shard stays within the largest row of its
    target. Larger groups are cut like any rows (a hot group spans shards).

    Rows with equal ``order`` values follow their sizes; fully equal rows are
    interchangeable. A null group is no group. An empty input gives an empty
    result; with fewer rows than shards some shards stay empty. Columns of the
    input called shard or slot are replaced.
    """
    order = order or ["doc_id"]
    size = text_bytes() if size is None else size
    base = without(docs, "shard", "slot").withColumn("__size", size.cast("long"))
    if group is not None:
        base = base.withColumn("__group", group)
        first = F.min(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]))
        groups = (base.filter(F.col("__group").isNotNull()).groupBy("__group")
                  .agg(first.alias("__first"), F.sum("__size").alias("__group_size"), F.count(F.lit(1)).alias("__n"))
                  .filter("__n > 1").drop("__n"))
        # Written first, so that the join's two sides come straight from shuffles
        # (or a broadcast) and the rows of a hot group are split over tasks.
        base = base.join(materialise(groups, "groups"), "__group", "left")
        base = base.withColumn("__first", F.coalesce(
            "__first", F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])))
    else:
        base = base.withColumns({"__first": F.lit(0), "__group_size": F.lit(None).cast("long")})
    keys = ["__first", *order, "__size"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = base.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    stored = materialise(ranged.withColumns({
        "__part": F.shiftright(at, _POS_BITS), "__row": at.bitwiseAND(F.lit((1 << _POS_BITS) - 1))}), "shards")

    slim = stored.select("__part", "__row", "__size", "__first", "__group_size")
    # One row for each range partition: at most ``parts`` rows, so windows over
    # all of them and the broadcast below stay small whatever the input.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (slim.groupBy("__part")
               .agg(F.sum("__size").alias("b"), F.count(F.lit(1)).alias("n"), F.max("__size").alias("m"))
               .select("__part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("__bytes_before"),
                       F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__rows_before"),
                       F.sum("b").over(everything).alias("__total"), F.max("m").over(everything).alias("__max_size")))
    inside = Window.partitionBy("__part").orderBy("__row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (slim.withColumn("__upto", F.sum("__size").over(inside))
              .join(F.broadcast(offsets), "__part")
              .withColumn("__rank", F.col("__rows_before") + F.col("__row"))
              .withColumn("__middle2", 2 * (F.col("__bytes_before") + F.col("__upto")) - F.col("__size"))
              .withColumn("__cut", F.least(F.lit(num_shards - 1).cast("long"), F.expr(
                  f"(__middle2 * {int(num_shards)}L) div greatest(2L * __total, 1L)"))))
    # At most ``num_shards`` rows: the first row of each shard.
    starts = (placed.groupBy("__cut")
              .agg(F.min(F.struct("__rank", "__first", "__group_size", "__max_size")).alias("s"))
              .select("__cut", "s.*"))
    if group is not None:
        small = starts.filter("__group_size <= __max_size").select("__first", "__cut")
        moved = (placed.select("__first", F.col("__rank").alias("r"))
                 .join(F.broadcast(small), "__first").groupBy("__cut").agg(F.min("r").alias("__start")))
        starts = (starts.join(F.broadcast(moved), "__cut", "left")
                  .withColumn("__rank", F.coalesce("__start", "__rank")))
    cuts: dict[int, int] = {}
    for cut, rank in sorted((r["__cut"], r["__rank"]) for r in starts.select("__cut", "__rank").collect()):
        cuts = {r: c for r, c in cuts.items() if r < rank} | {rank: cut}
    cuts = cuts or {0: 0}
    ranks = F.array(*[F.lit(r).cast("long") for r in cuts])
    shards = F.array(*[F.lit(c).cast("int") for c in cuts.values()])
    nth = F.size(F.filter(ranks, lambda r: r <= F.col("__rank")))
    out = (stored.join(F.broadcast(offsets.select("__part", "__rows_before")), "__part")
           .withColumn("__rank", F.col("__rows_before") + F.col("__row"))
           .withColumn("__nth", nth)
           .withColumns({"shard": F.element_at(shards, F.col("__nth")),
                         "slot": F.col("__rank") - F.element_at(ranks, F.col("__nth"))}))
    return out.drop("__part", "__row", "__size", "__first", "__group_size", "__group", "__rows_before", "__rank",
                    "__nth")
