"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
the context and only its reply is under the loss mask. The template is

    <turn>ROLE\\n TEXT </turn>\\n        (without the blanks)

Control strings inside roles and texts are escaped, reversibly: a backslash
becomes ``\\s``, ``<turn>`` becomes ``\\o``, ``</turn>`` becomes ``\\c`` and, in
roles, a line feed becomes ``\\n``. After that neither mark can occur in a role
or a text, and a backslash only begins one of these escapes.

A long conversation is cut into blocks of turns, which different tasks expand:
what precedes a block is joined to it once, as one string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>"
#: Turn numbers in a block.
BLOCK = 64


def escape(text: Column) -> Column:
    """Escape the control strings of a text (null: empty)."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for plain, coded in (("\\", "\\s"), (OPEN, "\\o"), (CLOSE, "\\c")):
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return out


def unescape(text: Column) -> Column:
    """The inverse of ``escape``: the backslash comes last."""
    for plain, coded in ((OPEN, "\\o"), (CLOSE, "\\c"), ("\\", "\\s")):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def expand_prefix_targets(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                          text: str = "text", assistant: str = "assistant", block: int = BLOCK) -> DataFrame:
    """One row for each assistant turn: (conv_id, turn, trainable, complete,
    formatted, loss_start, loss_end), the loss mask as code-point offsets of
    the reply's escaped text in ``formatted``; ``complete`` marks the row of a
    conversation that holds all of its turns.

    A conversation that does not end in an assistant turn has one more row,
    trainable false and with an empty mask, which holds all of its turns, so no
    turn is lost. Rows are ordered by turn (null first), ties by role and text
    (null first); equal rows are turns of their own. Null and empty texts give
    turns with an empty text; null roles are empty roles; a null conv_id is a
    conversation of its own. Columns other than the four are ignored.
    """
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                        F.col(text).alias("text"))
    order = [F.col("turn"), F.col("role"), F.col("text")]
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    rows = rows.select("conv_id", "turn", "role", "text",
                       F.coalesce(F.floor(F.col("turn") / block), F.lit(-1 << 62)).cast("long").alias("block"),
                       head.alias("head"), body.alias("body"),
                       F.concat(head, body, F.lit(CLOSE + "\n")).alias("piece"),
                       F.coalesce(F.col("role") == assistant, F.lit(False)).alias("trainable"))
    in_block = Window.partitionBy("conv_id", "block").orderBy(*order)
    so_far = in_block.rowsBetween(Window.unboundedPreceding, -1)
    last_of_block = F.lead(F.lit(1)).over(in_block).isNull()
    local = rows.select("conv_id", "turn", "block", "trainable", "head", "body", "piece",
                        F.concat_ws("", F.collect_list("piece").over(so_far)).alias("before"),
                        last_of_block.alias("last_of_block"))
    # Small rows: one a block. Only the blocks of conversations with several go
    # on to the join; their whole texts are what later blocks build on.
    spans = rows.groupBy("conv_id").agg(F.min("block").alias("first_block"), F.max("block").alias("last_block"))
    local = (local.filter("trainable OR last_of_block")
             .join(spans.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c"))
    # Between the blocks of a conversation, its running text.
    ends = (local.filter("last_of_block AND first_block < last_block")
            .select(F.col("conv_id").alias("c"), F.col("block").alias("b"),
                    F.concat("before", "piece").alias("block_text")))
    earlier = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    prefixes = ends.select("c", "b", F.concat_ws("", F.collect_list("block_text").over(earlier)).alias("prefix"))
    single = local.filter("first_block = last_block").withColumn("prefix", F.lit(""))
    several = (local.filter("first_block < last_block")
               .join(prefixes, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b"))
    complete = F.col("last_of_block") & (F.col("block") == F.col("last_block"))
    examples = single.unionByName(several).withColumn("complete", complete).filter("trainable OR complete")
    start = F.length("prefix") + F.length("before") + F.length("head")
    return examples.select(
        "conv_id", "turn", "trainable", "complete", F.concat("prefix", "before", "piece").alias("formatted"),
        F.when(F.col("trainable"), start).otherwise(0).alias("loss_start"),
        F.when(F.col("trainable"), start + F.length("body")).otherwise(0).alias("loss_end"))


def parse_formatted(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    pieces = F.split(formatted, CLOSE + "\n", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)  # behind the last mark is nothing
    return F.transform(pieces, lambda p: F.struct(
        unescape_role(F.substr(F.substring_index(p, "\n", 1), F.lit(len(OPEN) + 1))).alias("role"),
        unescape(F.substr(p, F.length(F.substring_index(p, "\n", 1)) + 2)).alias("text")))


def masked_text(formatted: Column, loss_start: Column, loss_end: Column) -> Column:
    """The unescaped text under the loss mask."""
    return unescape(F.substr(formatted, loss_start + 1, loss_end - loss_start))


def digest_examples(examples: DataFrame) -> DataFrame:
    """One row a conversation, read back from its examples: all turns from the
    complete one, the trained text from the masks of all."""
    turns = F.when(F.col("complete"), parse_formatted(F.col("formatted")))
    read = examples.select("conv_id", F.length("formatted").cast("long").alias("n_chars"), turns.alias("turns"),
                           masked_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    read = read.select("conv_id", "n_chars", "loss", F.size("turns").cast("long").alias("n_turns"),
                       F.when(F.col("turns").isNotNull(), F.sha2(F.concat_ws("", lines), 256)).alias("sha"))
    # A later example of a conversation is always longer.
    losses = F.sort_array(F.collect_list(F.struct("n_chars", "loss")))
    out = read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max("sha").alias("turns_sha256"),
        F.concat_ws("", F.transform(losses, lambda x: x.loss)).alias("loss"), F.sum("n_chars").alias("formatted_chars"))
    return out.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
