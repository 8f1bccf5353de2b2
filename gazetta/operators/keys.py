"""Keys: dense surrogate ids and key assertions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazetta.session import checkpoint_dir, stored


def fresh(columns: Sequence[str], base: str) -> str:
    """``base``, lengthened until no column has that name (case-blind)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


class KeyViolation(ValueError):
    """A primary-key or not-null rule of a table is broken."""


def assert_unique(df: DataFrame, keys: Sequence[str], table: str = "table") -> DataFrame:
    """Raise ``KeyViolation`` if two rows share ``keys``; return ``df`` unchanged.

    One aggregation job that stops at the first duplicate found.
    """
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1).collect()
    if dup:
        row = dup[0].asDict()
        raise KeyViolation(f"duplicate key in {table}: {row}")
    return df


def require_not_null(df: DataFrame, cols: Sequence[str], table: str = "table") -> DataFrame:
    """Raise ``KeyViolation`` if any of ``cols`` is NULL on some row."""
    if not cols:
        return df
    bad = None
    for c in cols:
        cond = F.col(c).isNull()
        bad = cond if bad is None else bad | cond
    hit = df.where(bad).limit(1).collect()
    if hit:
        raise KeyViolation(f"missing required value in {table}: {hit[0].asDict()}")
    return df


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there.

    For a frame consumed by several branches of a later plan: without it,
    each branch recomputes the whole subtree (exchanges are only reused when
    the subtrees stay identical, which filter pushdown usually breaks). It
    also cuts the lineage, so a lost executor never recomputes upstream work.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def assign_dense_ids(
    df: DataFrame,
    order_by: Sequence[str],
    id_col: str = "id",
    start: int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Number rows ``start, start+1, ...`` in ``order_by`` order, without gaps.

    ``order_by`` must be unique per row (a business key), which makes the
    numbering deterministic and so safe to recompute after a lost executor.

    Not a global ``row_number()`` window -- that sorts everything in one
    task. Instead: range-partition on the key, sort within partitions and write
    that once as Parquet (``stored``; range bounds come from sampling, so a
    second pass over the plan could cut elsewhere). Files follow each other by
    their number, so a row's id is the rows of the files before it plus its
    index in its file. Both come from the files themselves: counts from the
    footers, the index from the reader. The offsets (one row a file) are a
    running sum over that tiny table, broadcast to the scan, so the rows are
    neither cached nor copied with extra columns, and a query reads only the
    columns it needs.
    """
    keys = [F.col(k) for k in order_by]
    # Without a number, AQE sizes the ranges by the data.
    ranges = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    files = stored(ranges.sortWithinPartitions(*keys), "ranges")
    name, first = (fresh(df.columns, x) for x in ("__file", "__first"))
    number = lambda pattern: F.regexp_extract(name, pattern, 1).cast("long")
    counts = files.select(F.col("_metadata.file_name").alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    in_order = Window.orderBy(number(r"^part-(\d+)"), number(r"-c(\d+)")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(name, F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias(first))
    rows = files.select(*df.columns, F.col("_metadata.file_name").alias(name), F.col("_metadata.row_index").alias(fresh(df.columns, "__row")))
    numbered = rows.join(F.broadcast(offsets), name)
    ident = (F.col(first) + F.col(fresh(df.columns, "__row")) + F.lit(start)).cast("long").alias(id_col)
    return numbered.select(*[ident if c == id_col else F.col(f"`{c}`") for c in df.columns], *([] if id_col in df.columns else [ident]))
