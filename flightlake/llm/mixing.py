"""Mixing sources to target weights.

Each source gets a budget (its share of all words by weight, at most a number
of repeats of what it has; what it cannot use is reshared by weight). Its
documents are put in a hash-random order and taken until the budget is met:
full epochs first, then a prefix of the order. The prefix ends at one cut per
source, which is found from distributed prefix sums: word totals of key ranges
first, then of the parts of the one range that holds the cut, then the rows of
the one part. Rows that are equal in all that orders them are counted before
they are summed; where the cut falls among them, as many are taken as fit.

DataFrame functions only. Texts are scanned, never shuffled; a hot source is
spread over its key ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.common import materialise, without

# Any run of characters other than blank, tab, line feed, vertical tab, form
# feed and carriage return is a word (fixed by the contract).
WORD, BLANKS = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Words of the text; null has none. ``regexp_count`` would hold every word of
    a text as a string of its own; here a word becomes one character."""
    marks = F.regexp_replace(F.regexp_replace(F.col(text), WORD, "x"), BLANKS, "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], repeats: int, budget: float = 1.0) -> DataFrame:
    """(source, source_size, target) for one row a source with ``source_size``.

    Sources in code-point order, null last, weigh ``weights`` in turn. With
    every source limited to repeats x its size, the shares fill up: sources in
    order of limit / weight are capped as long as the common level of the rest
    exceeds their own. The table has one row a source, so ordering all of it
    is cheap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    filled = (sizes.withColumn("weight", weight)
              .withColumn("cap", (F.col("source_size") * repeats).cast("double"))
              .withColumn("level", F.col("cap") / F.col("weight"))
              .withColumn("total", F.sum("source_size").over(all_rows) * F.lit(float(budget)))
              .withColumn("open_weight", F.sum("weight").over(all_rows)
                          - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
              .withColumn("open_total", F.col("total") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
              .withColumn("share", F.col("open_total") / F.col("open_weight"))
              # The first source that the level of the rest does not exceed ends the capping.
              .withColumn("fits", F.when(F.col("share") <= F.col("level"), F.col("share"))))
    level = F.first("fits", ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding,
                                                                        Window.unboundedFollowing))
    return (filled.withColumn("common", level)
            .select("source", "source_size",
                    F.coalesce(F.least(F.col("cap"), F.col("common") * F.col("weight")), F.col("cap")).alias("target")))


def _cut_range(totals: DataFrame, budgets: DataFrame, place: str) -> DataFrame:
    """(source, cut, base, rest): of each source the range (``place``) in which
    its budget ends, and the words before that range."""
    earlier = Window.partitionBy("__source").orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = totals.withColumn("upto", F.sum("words").over(earlier))
    return (upto.join(budgets, F.col("source").eqNullSafe(F.col("__source")))
            .filter((F.col("base") + F.col("upto") - F.col("words") < F.col("rest"))
                    & (F.col("base") + F.col("upto") >= F.col("rest")))
            .select("source", F.col(place).alias("cut"), (F.col("base") + F.col("upto") - F.col("words")).alias("base"), "rest"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), repeats: int = 3, seed: str = "mix",
                size: Column | None = None, key: str = "doc_id", source: str = "source", text: str = "text",
                buckets: int = 4096, budget: float = 1.0) -> DataFrame:
    """``docs`` with size, source_size, target and ``taken`` (words the mix takes).

    A document is taken whole: ``taken`` is 0, 1, ... ``repeats`` times its
    size. In the last, partial epoch the documents come in the order of (md5 of
    seed, key and text, size) and are taken while more than half of one lies
    within the budget. Rows that agree in key, text, source and size are alike:
    of these as many are taken as fit, any of them. Null sources form one source;
    null keys and texts count as empty ones in the order. Empty texts have size 0
    and take nothing. Columns of the input with the names of the results are
    replaced. Reruns give the same mix.

    The cut is narrowed twice by ``buckets`` key ranges (4,096 x 4,096 of them
    leave a task some thousand rows of 1e11), and equal rows are one row there.
    """
    own = ("size", "source_size", "target", "taken")
    # Where the input has its own column "size" it may be what ``size`` reads.
    rows = (docs.withColumn("__size", (word_count(text) if size is None else size).cast("long"))
            .withColumn("__source", F.col(source)))
    content = [F.coalesce(F.md5(F.col(text).cast("binary")), F.lit(""))] if text in docs.columns else []
    rows = without(rows, *own).withColumn("__key", F.md5(F.concat(
        F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")), *content).cast("binary")))
    place = F.conv(F.substring("__key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("__part", F.floor(place * F.lit(buckets * buckets) / F.lit(1 << 32)).cast("long"))
    slim = materialise(rows.select("__source", "__key", "__size", "__part",
                                   F.expr(f"__part div {buckets}").alias("__range")), "mix-sizes")

    per_range = slim.groupBy("__source", "__range").agg(F.sum("__size").alias("words"))
    sizes = per_range.groupBy(F.col("__source").alias("source")).agg(F.sum("words").alias("source_size"))
    targets = (source_targets(sizes, weights, repeats, budget)
               .withColumn("epochs", F.when(F.col("source_size") > 0, F.least(
                   F.floor(F.col("target") / F.col("source_size")), F.lit(repeats))).otherwise(F.lit(0)).cast("long"))
               .withColumn("rest", F.when(F.col("epochs") < repeats,
                                          F.col("target") - F.col("epochs") * F.col("source_size"))
                           .otherwise(F.lit(0.0))))
    targets = materialise(targets, "mix-targets")

    budgets = targets.select("source", "rest", F.lit(0).cast("long").alias("base"))
    same = F.col("source").eqNullSafe(F.col("__source"))
    ranges = _cut_range(per_range, budgets, "__range")  # at most one a source, as all that follows
    per_part = (slim.join(ranges, same & (F.col("__range") == F.col("cut")))
                .groupBy("__source", "__part").agg(F.sum("__size").alias("words")))
    parts = materialise(_cut_range(per_part, ranges.drop("cut"), "__part"), "mix-parts")
    alike = (slim.join(parts, same & (F.col("__part") == F.col("cut"))).filter("__size > 0")
             .groupBy("source", "base", "rest", "__key", "__size").agg(F.count(F.lit(1)).alias("copies")))
    upto = F.sum(F.col("copies") * F.col("__size")).over(
        Window.partitionBy("source").orderBy("__key", "__size").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.col("base") + upto - F.col("copies") * F.col("__size")
    # Taken while more than half of the row lies within the budget.
    fit = F.floor((F.col("rest") - before) / F.col("__size") + F.lit(0.5))
    last = (alike.withColumn("fit", F.least(fit, F.col("copies")))
            .filter("fit > 0").groupBy(F.col("source").alias("s"))
            .agg(F.max(F.struct("__key", "__size", "fit", "copies")).alias("cut")))
    ends = (targets.join(parts.select(F.col("source").alias("p"), F.col("cut").alias("__cut_part")),
                         F.col("source").eqNullSafe(F.col("p")), "left")
            .join(last, F.col("source").eqNullSafe(F.col("s")), "left"))
    ends = materialise(ends.select(
        F.col("source").alias("__name"), "source_size", "target", F.col("epochs").alias("__epochs"), "__cut_part",
        F.struct("cut.__key", "cut.__size").alias("__cut_row"), F.col("cut.fit").alias("__fit"),
        F.coalesce(F.col("cut.fit") < F.col("cut.copies"), F.lit(False)).alias("__split")), "mix-cuts")

    here = F.struct("__key", "__size")
    out = rows.join(ends, F.col("__source").eqNullSafe(F.col("__name")))
    at_cut = F.coalesce((F.col("__part") == F.col("__cut_part")) & (here == F.col("__cut_row")), F.lit(False))
    in_prefix = F.coalesce((F.col("__part") < F.col("__cut_part"))
                           | ((F.col("__part") == F.col("__cut_part")) & (here <= F.col("__cut_row"))), F.lit(False))
    out = out.withColumns({"__more": in_prefix.cast("long"), "__tied": at_cut & F.col("__split")})
    if ends.filter("__split").isEmpty():
        done = out
    else:
        done = out.filter("NOT __tied").unionByName(_first_of_equal(out.filter("__tied")))
    return (done.withColumn("taken", F.col("__size") * (F.col("__epochs") + F.col("__more")))
            .withColumnRenamed("__size", "size")
            .drop("__source", "__name", "__key", "__part", "__epochs", "__cut_part", "__cut_row", "__fit", "__split",
                  "__more", "__tied"))


def _first_of_equal(tied: DataFrame) -> DataFrame:
    """The equal rows at the sources' cuts, ``__more`` being 1 for the first
    ``__fit`` of each source. They are written and numbered: inside the partitions
    they lie in, and across these by the partitions' counts."""
    number = F.monotonically_increasing_id()
    held = materialise(tied.withColumn("__row", number).withColumn("__in", F.shiftright(F.col("__row"), 33)), "mix-ties")
    counts = held.groupBy(F.col("__source").alias("c_source"), F.col("__in").alias("c_in")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("c_source").orderBy("c_in").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("c_source", "c_in", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    nth = F.row_number().over(Window.partitionBy("__source", "__in").orderBy("__row"))
    placed = held.withColumn("nth", nth).join(
        firsts, F.col("__source").eqNullSafe(F.col("c_source")) & (F.col("__in") == F.col("c_in")))
    more = (F.col("first") + F.col("nth") <= F.col("__fit")).cast("long")
    return placed.withColumn("__more", more).select(tied.columns)


def repeat_taken(mixed: DataFrame) -> DataFrame:
    """One row for each time that the mix takes a document (taken / size)."""
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(F.lit(0))
    return (mixed.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), times)))
            .drop("__copy", "size", "source_size", "target", "taken"))
