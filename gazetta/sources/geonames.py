"""Readers for the GeoNames tab-separated dumps, and the table sink.

Strictness: the first malformed row must abort the load. Spark's CSV source
drops lines of only blanks or tabs before its ``FAILFAST`` mode sees them, so
lines are read as text (only empty lines are no records) and parsed one by one
with ``from_csv``. ``FAILFAST`` only fails on columns that are parsed, and
column pruning skips the others, so every file is first *landed*: parsed at
full width and written as Parquet (which forces every column through the
parser), then read back. The landed copy also cuts the lineage, so later stages
never re-parse text after a lost executor. Only when a load fails are lines
numbered, to name the file and line of the first bad record.
"""

from __future__ import annotations

import logging
import os
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.operators.keys import KeyViolation, fresh
from gazetta.operators.lookup import broadcast_if_bounded
from gazetta.session import stored
from gazetta.sources import schemas
from gazetta.sources.records import PLACE, line_numbers, numbered_lines, records

# Quoting like a standard CSV reader: '"' quotes a field, '""' escapes one.
QUOTE_CSV = "csv"
# No quoting at all: every '"' is data. Fastest; identical on dumps without quotes.
QUOTE_NONE = "none"

log = logging.getLogger("gazetta")


def read_tsv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None,
    header: bool = False,
    quoting: str = QUOTE_CSV,
    multi_line: bool = False,
    comment: str | None = None,
) -> DataFrame:
    """Lazy, strict (FAILFAST) tab-separated reader with an explicit schema
    (or, with ``schema=None`` and a header, text columns named by the header).

    Every non-empty line is a record. ``multi_line=True`` lets a quoted field
    span lines; files are still read by ranges in many tasks (``records``).
    With ``header``, the first record of each file is the header, the same in
    all files; equal records further down are data. Both options number the
    lines of the files first, in a copy in the scratch folder.
    """
    rows, schema, _ = _rows(spark, path, schema, header, quoting, multi_line, comment)
    parsed = _text_for_doubles(schema)
    number = _has_numbers(schema)
    value = F.when(_blank(schema), F.raise_error(F.concat(F.lit(f"malformed line in {path}: "), "value")).cast("string")).otherwise(F.col("value"))
    row = F.from_csv(value, _ddl(parsed), _options(quoting) | {"mode": "FAILFAST"})
    if not number:
        # All fields empty: a row of texts (blanks stay as they are).
        row = F.when(_only_tabs(schema), F.struct(*(
            F.nullif(F.get(F.split("value", "\t"), F.lit(i)), F.lit("")).alias(f.name) for i, f in enumerate(parsed.fields))).cast(parsed)).otherwise(row)
    return _checked(rows.select(row.alias("r")).select("r.*"), schema)


def _options(quoting: str) -> dict[str, str]:
    return {"sep": "\t", "quote": "\u0000"} if quoting == QUOTE_NONE else {"sep": "\t", "quote": '"', "escape": '"'}


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _has_numbers(schema: T.StructType) -> bool:
    return any(not isinstance(f.dataType, T.StringType) for f in schema.fields)


def _only_tabs(schema: T.StructType) -> Column:
    """A line of blanks and tabs (the parser finds no tokens in it at all) that
    has all fields of a table of texts."""
    tabs = F.length("value") - F.length(F.replace("value", F.lit("\t"), F.lit("")))
    return F.rlike("value", F.lit(r"^[ \t]*$")) & (tabs == len(schema.fields) - 1) & F.lit(not _has_numbers(schema))


def _blank(schema: T.StructType) -> Column:
    """Any other line of blanks and tabs: malformed."""
    blank = F.rlike("value", F.lit(r"^[ \t]*$"))
    return blank if _has_numbers(schema) else blank & ~_only_tabs(schema)


def _rows(
    spark: SparkSession, path: str, schema: T.StructType | None, header: bool, quoting: str, multi_line: bool, comment: str | None,
    numbered: bool = False,
) -> tuple[DataFrame, T.StructType, DataFrame | None]:
    """The data records of the files as text (``value``, and their place if
    lines were numbered), the schema, from the header if there is none, and the
    numbered lines."""
    multi_line = multi_line and quoting != QUOTE_NONE
    if not (header or multi_line or numbered):
        rows, lines = spark.read.text(path), None
    else:
        lines = numbered_lines(spark, path, "\n" if multi_line else None)
        rows = records(lines) if multi_line else lines
    rows = rows.where(F.col("value") != "")
    if comment:
        rows = rows.where(~F.startswith("value", F.lit(comment)))
    if header:
        # The first record of each file; one row a file.
        first = rows.groupBy("file").agg(F.min(F.struct("block", "at", "value")).alias("__first"))
        first = stored(first.select(F.col("file").alias("__file"), "__first.*"), "headers")
        seen = [r["value"] for r in first.select("value").distinct().limit(2).collect()]
        if len(seen) != 1:
            raise KeyViolation(f"{path}: " + ("files with different headers" if seen else "no header"))
        first = broadcast_if_bounded(first.select("__file", F.col("block").alias("__block"), F.col("at").alias("__at")))
        rows = rows.join(first, (F.col("file") == F.col("__file")) & (F.col("block") == F.col("__block")) & (F.col("at") == F.col("__at")), "left_anti")
        if schema is None:
            names = [x.strip('"') if quoting != QUOTE_NONE else x for x in seen[0].split("\t")]
            schema = T.StructType([T.StructField(x, T.StringType()) for x in names])
    return rows, schema, lines


def malformed_records(
    spark: SparkSession, path: str, schema: T.StructType | None, header: bool = False, quoting: str = QUOTE_CSV,
    multi_line: bool = False, comment: str | None = None, required: Sequence[str] = (), non_negative: Sequence[str] = (),
) -> DataFrame:
    """``(file, line, reason, record)`` of every record that ``read_tsv`` would
    refuse, or that lacks a required value or has a negative count. ``line`` is
    the number of the record's first line in its file, from 1."""
    rows, schema, lines = _rows(spark, path, schema, header, quoting, multi_line, comment, numbered=True)
    parsed = _text_for_doubles(schema)
    bad = "__malformed"
    options = _options(quoting) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    r = rows.withColumn("r", F.from_csv("value", f"{_ddl(parsed)}, `{bad}` string", options))
    field = lambda name: F.col(f"r.`{name}`")
    reason = F.when(_blank(schema), F.lit("a line without fields")).when(
        field(bad).isNotNull() & ~_only_tabs(schema), F.lit("wrong number of fields, or not a number"))
    for f in schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            reason = reason.when(F.coalesce(~F.rlike(field(f.name), F.lit(_DOUBLE)), F.lit(False)), F.lit(f"not a number in {f.name}"))
    for name in required:
        reason = reason.when(field(name).isNull(), F.lit(f"no {name}"))
    for name in non_negative:
        reason = reason.when(field(name) < 0, F.lit(f"negative {name}"))
    found = r.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(*PLACE, "reason", F.col("value").alias("record"))
    return line_numbers(lines, found).select("file", "line", "reason", "record")


def first_malformed(spark: SparkSession, path: str, kind: str, quoting: str = QUOTE_CSV, multi_line: bool = False, comment: str | None = None) -> str | None:
    """Where and what the first bad record of a dump file is, as a message."""
    schema = schemas.BY_KIND[kind]
    first = malformed_records(
        spark, path, schema, header=schema is None, quoting=quoting, multi_line=multi_line, comment=comment,
        required=schemas.REQUIRED.get(kind, []), non_negative=schemas.NON_NEGATIVE.get(kind, []),
    ).orderBy("file", "line").limit(1).collect()
    return f"{first[0]['file']}, line {first[0]['line']}: {first[0]['reason']}: {first[0]['record'][:200]!r}" if first else None


# Doubles are parsed here: Java's parser would also take "1.0d" or "0x1p3".
_DOUBLE = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$"


def _text_for_doubles(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DoubleType) else f.dataType, True) for f in schema.fields])


def _checked(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """Text columns that the schema calls doubles, as doubles or an error."""
    if schema is None:
        return df
    doubles = {f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)}

    def column(name: str):
        c = F.col(f"`{name}`")
        if name not in doubles:
            return c
        bad = F.raise_error(F.concat(F.lit(f"not a number in {name}: "), c)).cast("double")
        return F.when(c.isNull() | F.rlike(c, F.lit(_DOUBLE)), c.cast("double")).otherwise(bad).alias(name)

    return df.select(*(column(c) for c in df.columns))


def land(
    df: DataFrame, path: str, kind: str, place: Callable[[], str | None] | None = None,
    used: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Parse every column by writing the raw rows to Parquet; read them back.

    Raises on the first malformed row (FAILFAST sees every column here), on a
    missing required value and on a negative unsigned count; the last two are
    noted during the write. ``place`` is only called then, to say where the
    bad record is. Required text columns come back as ``''`` where the field
    was empty. ``used`` says which rows and columns later steps use: every row is
    parsed and checked, then only those are written.
    """
    t0 = time.perf_counter()
    missing, negative = schemas.REQUIRED.get(kind, []), schemas.NON_NEGATIVE.get(kind, [])
    counted = Observation()
    rules = {f"missing required value: {c}": F.col(c).isNull() for c in missing} | {f"negative count: {c}": F.col(c) < 0 for c in negative}
    names = list(rules)
    # one bit a rule: an observed row costs by the number of its columns and totals
    broken = F.lit(0)
    for i, n in enumerate(names):
        broken = broken.bitwiseOR(F.when(rules[n], F.lit(1 << i)).otherwise(F.lit(0)))
    flag, text = fresh(df.columns, "__broken"), set(schemas.REQUIRED_TEXT.get(kind, []))
    rows = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in text else F.col(c) for c in df.columns], broken.alias(flag))
    # the filter stays above the observation, so rows that it drops are parsed and checked
    watched = rows.observe(counted, F.count(F.lit(1)).alias("rows"), F.bit_or(flag).alias("broken")).drop(flag)
    kept = used(watched) if used else watched
    try:
        kept.write.mode("overwrite").parquet(path)
    except Exception as error:
        where = place() if place else None
        if where is None:
            raise
        raise KeyViolation(where) from error
    got = counted.get
    found = [n for i, n in enumerate(names) if (got.get("broken") or 0) >> i & 1]
    if found:
        raise KeyViolation((place() if place else None) or f"{found[0]} in {path}")
    log.info("landed %s: %s rows in %.2fs", path, got.get("rows"), time.perf_counter() - t0)
    return df.sparkSession.read.parquet(path)


def read_lang_codes(spark: SparkSession, path: str, quoting: str = QUOTE_CSV, multi_line: bool = False) -> DataFrame:
    """Language codes file: header row, columns bound by header *name*."""
    raw = read_tsv(spark, path, None, header=True, quoting=quoting, multi_line=multi_line)
    missing = [h for h in schemas.LANG_CODE_HEADERS if h not in raw.columns]
    if missing:
        raise KeyViolation(f"{path}: missing columns {missing}")
    return raw.select(*[F.col(f"`{h}`").alias(n) for h, n in schemas.LANG_CODE_HEADERS.items()])


def read_alt_names(spark: SparkSession, path: str, quoting: str = QUOTE_CSV, multi_line: bool = False) -> DataFrame:
    return read_tsv(spark, path, schemas.ALT_NAMES, quoting=quoting, multi_line=multi_line)


def read_admins(spark: SparkSession, path: str, quoting: str = QUOTE_CSV, multi_line: bool = False) -> DataFrame:
    return read_tsv(spark, path, schemas.ADMINS, quoting=quoting, multi_line=multi_line)


def read_countries(
    spark: SparkSession, path: str, quoting: str = QUOTE_CSV, multi_line: bool = False, comment: str | None = None,
) -> DataFrame:
    return read_tsv(spark, path, schemas.COUNTRIES, quoting=quoting, multi_line=multi_line, comment=comment)


def read_places(spark: SparkSession, path: str, quoting: str = QUOTE_CSV, multi_line: bool = False) -> DataFrame:
    """Cities file and non-country features file share this 19-column layout."""
    return read_tsv(spark, path, schemas.PLACES, quoting=quoting, multi_line=multi_line)


def write_table(
    df: DataFrame, out_dir: str, schema: str, table: str, rows: dict[str, int] | None = None,
    save: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Full rebuild of ``<out_dir>/<schema>/<table>`` as Parquet; return it re-read.

    Re-reading the written table is what later steps consume, so a downstream
    failure never recomputes the upstream plan. ``rows`` gets the number of rows
    under the table's name, counted during the write.
    """
    path = os.path.join(out_dir, schema, table)
    t0 = time.perf_counter()
    obs = Observation(f"{schema}.{table}")
    watched = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if save is None:
        watched.write.mode("overwrite").parquet(path)
        out = df.sparkSession.read.parquet(path)
    else:
        out = save(watched, path)
    n = obs.get.get("rows")
    if rows is not None:
        rows[f"{schema}.{table}"] = n
    log.info("%s.%s: %s rows in %.2fs", schema, table, n, time.perf_counter() - t0)
    return out
