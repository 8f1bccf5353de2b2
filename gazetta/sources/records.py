"""Logical records of text files, found without reading a file in one task.

A record may go on over lines while a quoted field is open, so where a byte range
of a file starts (inside or outside quotes) depends on all ranges before it. Each
line is therefore taken as a function of that state: whether it leaves a quoted
field open if it starts outside of one, and if it starts inside. Most lines have
no quote and change nothing; the others are composed within their range (a
window over a range's lines, of fixed size), ranges are composed with each other
(one row a range), and then every line knows its state. Lines of one record are
put together within a range first, then over ranges.

Quotes follow the CSV rules: a field is quoted if it starts with a quote, ``""``
inside stands for one, the next single quote closes it, and quotes elsewhere are
data. Only ranges in which a field stays open over a line's end are sorted;
the lines of all others are records as they are.

Lines are numbered once and written to the shared scratch folder: later passes
read that copy, because a second scan of the files may cut them at other places
(the ranges depend on the number of executors).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazetta.operators.lookup import broadcast_if_bounded
from gazetta.session import stored

#: A longer record means a quote that never closes.
MAX_RECORD_CHARS = 64 << 20
#: Where a line stands: its file, the start of its byte range, its place there.
PLACE = ("file", "block", "at")


def numbered_lines(spark: SparkSession, path: str, line_break: str | None = "\n") -> DataFrame:
    """``(file, block, at, value)`` of every line, written once. ``at`` grows by
    one from line to line of a range. Lines end at ``line_break`` (None: at
    \\n, \\r or \\r\\n)."""
    reader = spark.read.option("lineSep", line_break) if line_break else spark.read
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")
    return stored(lines, "lines")


def _left_open(line: Column, sep: str) -> Column:
    """Whether a line (``""`` taken out) that starts a field leaves it quoted."""
    whole = rf'(^|{sep})"[^"]*"[^{sep}]*'
    return F.rlike(F.regexp_replace(line, whole, "$1"), F.lit(rf'(^|{sep})"'))


def _as_functions(lines: DataFrame, sep: str) -> DataFrame:
    """``outside`` / ``inside``: the state a line ends in, by the state it starts in (true: in quotes)."""
    quoted = F.contains("value", F.lit('"'))
    single = F.replace("value", F.lit('""'), F.lit(""))
    return lines.withColumns({
        "outside": F.when(quoted, _left_open(single, sep)).otherwise(F.lit(False)),
        "inside": F.when(quoted, _left_open(F.concat(F.lit('"'), single), sep)).otherwise(F.lit(True))})


def _xor(a: Column, b: Column) -> Column:
    return a != b


def _composed(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds ``fixed`` (the state after all lines so far, if it does not depend on
    the first state, else null) and ``turns`` (whether it is the first state's opposite)."""
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    constant = F.col("outside") == F.col("inside")
    flips = F.sum((F.col("outside") & ~F.col("inside")).cast("long")).over(so_far)
    last = F.last(F.when(constant, F.struct(F.col("outside").alias("value"), F.col("__flips").alias("flips"))), ignorenulls=True).over(so_far)
    odd = lambda x: F.pmod(x, F.lit(2)) == 1
    return df.withColumn("__flips", flips).withColumn("__last", last).withColumns({
        "fixed": F.when(F.col("__last").isNotNull(), _xor(F.col("__last.value"), odd(F.col("__flips") - F.col("__last.flips")))),
        "turns": odd(F.col("__flips"))}).drop("__flips", "__last")


def _after(first: Column) -> Column:
    return F.coalesce("fixed", _xor(first, F.col("turns")))


def _ranges(lines: DataFrame, sep: str) -> DataFrame:
    """``(file, block, first)`` of the ranges in which a field stays open over a
    line's end; ``first``: whether the range starts inside quotes."""
    marks = _as_functions(lines.where(F.contains("value", F.lit('"'))), sep).select(*PLACE, "outside", "inside").where("outside OR NOT inside")
    marks = _composed(marks, ["file", "block"], ["at"])
    ends = marks.groupBy("file", "block").agg(
        F.max_by(F.struct("fixed", "turns"), "at").alias("end"),
        # Open after some line, whatever the range starts with, or if it starts so.
        F.max(F.coalesce(F.col("fixed"), F.col("turns"))).alias("opens"), F.max(F.coalesce(F.col("fixed"), ~F.col("turns"))).alias("stays"))
    # One row a range, and none for a range without such lines: those keep the state.
    end = ends.select("file", "block", "opens", "stays", F.coalesce("end.fixed", F.col("end.turns")).alias("outside"),
                      F.coalesce("end.fixed", ~F.col("end.turns")).alias("inside"))
    composed = _composed(end, ["file"], ["block"]).withColumn("state", _after(F.lit(False)))
    in_order = Window.partitionBy("file").orderBy("block")
    composed = composed.withColumn("first", F.lag("state", 1, False).over(in_order)).withColumn("next", F.lead("block").over(in_order))
    marked = composed.where(F.col("opens") & ~F.col("first") | F.col("first")).select("file", "block", "first")
    # Ranges without such lines lie inside quotes after a range that ends so.
    blocks = lines.select("file", "block").distinct()
    gaps = composed.where("state").select("file", F.col("block").alias("__from"), F.col("next").alias("__to"))
    between = blocks.join(broadcast_if_bounded(gaps), "file").where("block > __from AND (__to IS NULL OR block < __to)")
    return marked.unionByName(between.select("file", "block", F.lit(True).alias("first")).distinct())


def records(lines: DataFrame, sep: str = "\t", max_chars: int = MAX_RECORD_CHARS) -> DataFrame:
    """``(file, block, at, value)`` of every record of ``numbered_lines``, placed
    where it starts; line breaks inside quotes stay as they are."""
    ranges = broadcast_if_bounded(stored(_ranges(lines, sep), "ranges"))
    plain = lines.join(ranges, ["file", "block"], "left_anti")
    rest = _composed(_as_functions(lines.join(ranges, ["file", "block"]), sep), ["file", "block"], ["at"])
    in_order = Window.partitionBy("file", "block").orderBy("at")
    rest = rest.withColumn("open", _after(F.col("first")))
    rest = rest.withColumn("begins", ~F.coalesce(F.lag("open").over(in_order), F.col("first")))
    rest = rest.withColumn("record", F.sum(F.col("begins").cast("long")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    # Record 0 of a range is the rest of one that began in a range before it.
    pieces = stored(rest.groupBy("file", "block", "record").agg(
        F.min("at").alias("at"), F.max_by("open", "at").alias("open"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]), "\n").alias("value")), "pieces")
    crossing = F.col("open") | (F.col("record") == 0)
    # At most two pieces a range; a group is one record.
    over_ranges = Window.partitionBy("file").orderBy("block", "record").rowsBetween(Window.unboundedPreceding, 0)
    parts = pieces.where(crossing).withColumn("group", F.sum((F.col("record") > 0).cast("long")).over(over_ranges))
    size = F.sum(F.length("value")).over(Window.partitionBy("file", "group"))
    parts = parts.withColumn("value", F.when(size <= max_chars, F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit("a quote never closes, or a record is too long: "), "file", F.lit(", record "), F.substring("value", 1, 80))).cast("string")))
    joined = parts.groupBy("file", "group").agg(
        F.min(F.struct("block", "at")).alias("place"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "record", "value"))), lambda x: x["value"]), "\n").alias("value"),
    ).select("file", "place.block", "place.at", "value")
    out = plain.unionByName(pieces.where(~crossing).select(*PLACE, "value")).unionByName(joined)
    # A line's own break may be \r\n.
    return out.withColumn("value", F.when(F.endswith("value", F.lit("\r")), F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value")))


def line_numbers(lines: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` (few rows with a place) with ``line``, the number of that line in
    its file, from the line counts of the ranges before it."""
    ranges = lines.groupBy("file", "block").agg(F.min("at").alias("__lowest"), F.count(F.lit(1)).alias("__lines"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__before", F.coalesce(F.sum("__lines").over(earlier), F.lit(0)))
    return found.join(ranges, ["file", "block"]).withColumn("line", F.col("__before") + F.col("at") - F.col("__lowest") + 1).drop("__before", "__lowest", "__lines")
