"""Row acceptance and normalisation of ingested state lines.

Lines arrive as one text column (from the tar scan or ``spark.read.text``);
splitting, arity checks, padding and casting are built-in array and string
expressions, so parsing runs in the JVM at scan speed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.functions import coalesce_alias, norm_key, select_existing
from flightlake.functions.columns import STATE_ALIASES
from flightlake.operators.aggregates import first_per_key
from flightlake.schemas import AIRCRAFT_COLUMNS, STATE_COLUMNS

N_FIELDS = len(STATE_COLUMNS)
# A lenient line needs at least this many fields.
MIN_LENIENT_FIELDS = 10


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _fields(parts: Column, n: int = N_FIELDS) -> list[Column]:
    return [F.coalesce(F.get(parts, i), F.lit("")).alias(STATE_COLUMNS[i]) for i in range(n)]


def is_header_or_blank(line: Column) -> Column:
    """Blank line, or a header (contains both 'time' and 'icao24')."""
    return (F.length(_strip(line)) == 0) | (line.contains("time") & line.contains("icao24"))


_ROW_TYPE = "struct<" + ",".join(f"{c}:string" for c in STATE_COLUMNS) + ">"


def accept_rows(lines: DataFrame, mode: str = "lenient", line_col: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """Split state lines into the 16 text columns.

    lenient (N1): strip, split on ',', accept when there are at least 10
    fields and field 0 is all digits; truncate to 16, pad with ''.
    strict (N2 + N3): drop blank and header lines, accept exactly 16 fields.
    ``keep`` carries extra input columns (e.g. the source file) along.

    Acceptance is a generator (``inline`` of a zero- or one-row array) over a
    projection that splits each line once; a filter would be pushed below
    that projection and split (and build) every line twice.
    """
    if mode not in ("lenient", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    keep = list(keep)
    base = lines.select(*keep, F.col(line_col).alias("_l"))
    parts = base.select(*keep, "_l", F.split(_strip(F.col("_l")), ",", -1).alias("_p"))
    p = F.col("_p")
    if mode == "lenient":
        ok = (F.size(p) >= MIN_LENIENT_FIELDS) & F.get(p, 0).rlike("^[0-9]+$")
    else:
        ok = ~is_header_or_blank(F.col("_l")) & (F.size(p) == N_FIELDS)
    row = F.struct(*_fields(p))
    rows = F.when(ok, F.array(row)).otherwise(F.array().cast(f"array<{_ROW_TYPE}>"))
    return parts.select(*keep, F.inline(rows))


def accept_members(scanned: DataFrame, mode: str = "lenient", keep: Sequence[str] = ()) -> DataFrame:
    """The 16 text columns of scanned archive members (``tarstates`` columns):
    lines by ``accept_rows``, Avro records by their field names and aliases
    (N5; lenient mode asks for a numeric time there too). Rows that only tell
    of a fault are left out; ``archive_faults`` has them."""
    lines = accept_rows(scanned.filter(F.col("line").isNotNull()), mode, "line", keep)
    names = dict.fromkeys(n for c in STATE_COLUMNS for n in (c, *STATE_ALIASES.get(c, ())))
    fields = scanned.filter(F.col("record").isNotNull()).select(*keep, *[F.col("record")[n].alias(n) for n in names])
    records = coalesce_alias(fields, STATE_COLUMNS, keep=keep)
    if mode == "lenient":
        records = records.filter(F.col("time").rlike("^[0-9]+$"))
    return lines.unionByName(records)


def _refusal(line: Column, parts: Column, mode: str) -> Column:
    """Why ``accept_rows`` does not take a line (null: it does)."""
    if mode not in ("lenient", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "lenient":
        return (F.when(F.size(parts) < MIN_LENIENT_FIELDS, "fields")
                .when(~F.get(parts, 0).rlike("^[0-9]+$"), "time"))
    return (F.when(F.length(_strip(line)) == 0, "blank").when(is_header_or_blank(line), "header")
            .when(F.size(parts) != N_FIELDS, "fields"))


def sort_out_rows(lines: DataFrame, mode: str = "lenient", line_col: str = "value",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Every line with the 16 text columns and ``reason``: null for the lines
    that ``accept_rows`` takes, else why it does not ('fields', 'time', 'blank',
    'header', 'null'); ``text`` has a rejected line. One scan for both outcomes."""
    line = F.col(line_col)
    parts = lines.select(*keep, line.alias("_l"), F.split(_strip(line), ",", -1).alias("_p"))
    reason = F.when(F.col("_l").isNull(), "null").otherwise(_refusal(F.col("_l"), F.col("_p"), mode))
    return parts.select(*keep, F.when(reason.isNotNull(), F.col("_l")).alias("text"), reason.alias("reason"),
                        *_fields(F.col("_p")))


def sort_out_members(scanned: DataFrame, mode: str = "lenient", numeric: Sequence[str] = ("velocity", "geoaltitude"),
                     required: Sequence[str] = ("velocity",)) -> DataFrame:
    """``accept_members`` and ``clean_states`` with nothing lost, in one scan:
    archive, member, position, text, reason and the typed columns of every row
    that the archives gave. ``reason`` is null for an accepted row; beside the
    rules' reasons it names the first required column that is missing after the
    cast (N7), or 'fault' where an archive or member broke off (``text`` says how).
    The text of an Avro record is JSON."""
    line, record = F.col("line"), F.col("record")
    of_record = F.array(*[F.coalesce(*[record[n] for n in dict.fromkeys((c, *STATE_ALIASES.get(c, ())))], F.lit(""))
                          for c in STATE_COLUMNS])
    parts = F.when(line.isNotNull(), F.split(_strip(line), ",", -1)).when(record.isNotNull(), of_record)
    base = scanned.select("archive", "member", "position", "line", "record", "fault", parts.alias("_p"))
    p = F.col("_p")
    late = F.when(~F.get(p, 0).rlike("^[0-9]+$"), "time") if mode == "lenient" else F.lit(None).cast("string")
    reason = (F.when(F.col("fault").isNotNull(), "fault").when(line.isNotNull(), _refusal(line, p, mode)).otherwise(late))
    typed = base.select("archive", "member", "position", "line", "record", "fault", reason.alias("reason"), *_fields(p))
    typed = typed.withColumns({c: F.col(c).try_cast(T.DoubleType()) for c in numeric})
    for c in required:
        typed = typed.withColumn("reason", F.coalesce("reason", F.when(F.col(c).isNull(), c)))
    text = F.when(F.col("reason").isNotNull(), F.coalesce("fault", "line", F.to_json("record")))
    return typed.select("archive", "member", "position", text.alias("text"), "reason", *STATE_COLUMNS)


def archive_faults(scanned: DataFrame) -> DataFrame:
    """(archive, member, fault) of what could not be read; member is null where
    an archive's list of members broke off."""
    return scanned.filter(F.col("fault").isNotNull()).select("archive", "member", "fault")


def clean_states(df: DataFrame, numeric: Sequence[str] = ("velocity", "geoaltitude"),
                 required: Sequence[str] = ("velocity",)) -> DataFrame:
    """Cast ``numeric`` text columns to double (bad text -> NULL), drop rows
    missing a ``required`` value."""
    conv = {c: F.col(c).try_cast(T.DoubleType()) for c in numeric if c in df.columns}
    out = df.withColumns(conv)
    for c in required:
        out = out.filter(F.col(c).isNotNull())
    return out


def clean_aircraft(df: DataFrame, order_col: str | None = None, normalise_key: bool = False) -> DataFrame:
    """Keep the master-data columns that exist; first row per icao24.

    "First" is by ``order_col`` (file position); without one, by the other
    columns, which is still deterministic. ``normalise_key`` de-duplicates on
    the lower-cased, stripped key instead of the raw one.
    """
    cols = [c for c in AIRCRAFT_COLUMNS if c in df.columns] + ([order_col] if order_col else [])
    d = select_existing(df, cols)
    if normalise_key:
        d = d.withColumn("icao24", norm_key("icao24"))
    order = [order_col] if order_col else [c for c in d.columns if c != "icao24"]
    out = first_per_key(d, "icao24", order)
    return out.drop(order_col) if order_col else out
