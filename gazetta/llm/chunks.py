"""Chunks of a table, and the exchange that finds hashes occurring twice.

A chunk is a row (chunk id, an Arrow stream of some rows of the table, every
column). Work on whole texts runs chunk by chunk with arrays; only hashes move
between chunks. ``recurring`` sends each chunk's *distinct* hashes to buckets
by value and returns to each chunk those that occur twice or more anywhere: a
hash held by a third of all rows still appears at most once per chunk, so no
bucket grows with a hot value, and no pairs are formed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm.util import BATCH_BYTES, forget, materialise, text_slices

#: Text bytes behind one bucket of the exchange (its task holds their hashes).
BUCKET_BYTES = 32 << 20
HASHES = "bucket int, chunk long, once binary, more binary"
FOUND = "chunk long, found binary"
#: The same with a weight (long) for each hash of ``once``, then of ``more``; and
#: those of ``found`` whose weights exceed a budget.
WEIGHED = HASHES + ", weights binary"
FOUND_HEAVY = FOUND + ", heavy binary"


def pack(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as w:
        w.write(table)
    return sink.getvalue().to_pybytes()


def unpack(data) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def to_chunks(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """(chunk, bytes, data): written once, so chunk ids are stable."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        n = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in text_slices(batch, text_col):
                # A copy: a slice would write the whole batch's buffers.
                whole = part.take(pa.array(np.arange(part.num_rows)))
                size = int(pa.compute.sum(pa.compute.binary_length(whole.column(whole.schema.get_field_index(text_col)))).as_py() or 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int64()), pa.array([size], pa.int64()), pa.array([pack(whole)], pa.binary())],
                    names=["chunk", "bytes", "data"])
                n += 1

    return materialise(df.mapInArrow(cut, "chunk long, bytes long, data binary"), name)


def bucket_count(chunks: DataFrame) -> int:
    total = chunks.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    return max(8, -(-total // BUCKET_BYTES))


def bucketed(
    chunk: int, hashes: np.ndarray, buckets: int, more: np.ndarray | None = None, weights: np.ndarray | None = None,
) -> pa.RecordBatch:
    """Rows for ``recurring`` from the hashes of a chunk. ``more``: those of
    them that count as twice already; by default, those repeated in ``hashes``.
    ``weights``: of each of ``hashes``, summed by value."""
    if weights is None:
        values, n = np.unique(hashes, return_counts=True)
    else:
        values, where, n = np.unique(hashes, return_inverse=True, return_counts=True)
        weight = np.zeros(len(values), np.int64)
        np.add.at(weight, where, weights)
    twice = n > 1 if more is None else np.isin(values, more)
    bucket = ((values >> np.uint64(24)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    values, twice, bucket = values[order], twice[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    lo, hi = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(values)]])
    if not len(values):
        lo = hi = lo[:0]
    once = [values[a:b][~twice[a:b]].tobytes() for a, b in zip(lo, hi)]
    rest = [values[a:b][twice[a:b]].tobytes() for a, b in zip(lo, hi)]
    columns = {"bucket": pa.array(bucket[lo], pa.int32()), "chunk": pa.array(np.full(len(lo), chunk), pa.int64()),
               "once": pa.array(once, pa.binary()), "more": pa.array(rest, pa.binary())}
    if weights is not None:
        weight = weight[order]
        columns["weights"] = pa.array(
            [np.concatenate([weight[a:b][~twice[a:b]], weight[a:b][twice[a:b]]]).tobytes() for a, b in zip(lo, hi)], pa.binary())
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def blob(cells) -> np.ndarray:
    """All uint64 of a column of blobs (nulls skipped)."""
    parts = [np.frombuffer(x, np.uint64) for x in cells.to_pylist() if x]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _meet(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    once = [np.frombuffer(x, np.uint64) for x in table["once"].to_pylist()]
    more = [np.frombuffer(x, np.uint64) for x in table["more"].to_pylist()]
    rows = np.arange(len(once))
    values = np.concatenate([*once, *more])
    owner = np.concatenate([np.repeat(rows, [len(x) for x in once]), np.repeat(rows, [len(x) for x in more])])
    weight = np.ones(len(values), np.int64)
    weight[sum(map(len, once)):] = 2
    order = np.argsort(values, kind="stable")
    values, owner, weight = values[order], owner[order], weight[order]
    head = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    total = np.add.reduceat(weight, head) if len(head) else head
    twice = np.repeat(total >= 2, np.diff(np.concatenate([head, [len(values)]])))
    values, owner = values[twice], owner[twice]
    order = np.argsort(owner, kind="stable")
    values, owner = values[order], owner[order]
    ends = np.searchsorted(owner, np.arange(len(once) + 1))
    some = np.flatnonzero(np.diff(ends))
    chunk = np.asarray(table["chunk"])
    return pa.table({"chunk": pa.array(chunk[some], pa.int64()),
                     "found": pa.array([values[ends[i]: ends[i + 1]].tobytes() for i in some], pa.binary())})


def recurring(hashes: DataFrame) -> DataFrame:
    """FOUND rows: for each chunk, its hashes that occur twice or more anywhere."""
    return hashes.groupBy("bucket").applyInArrow(_meet, FOUND)


def recurring_weighed(hashes: DataFrame, budget: int) -> DataFrame:
    """FOUND_HEAVY rows from WEIGHED ones: as ``recurring``, and which of them
    weigh more than ``budget`` over all chunks."""

    def meet(table: pa.Table) -> pa.Table:
        found = _meet(table)
        once, more, weights = (
            [np.frombuffer(x, kind) for x in table[c].to_pylist()]
            for c, kind in (("once", np.uint64), ("more", np.uint64), ("weights", np.int64)))
        values, where = np.unique(np.concatenate([v for pair in zip(once, more) for v in pair]), return_inverse=True)
        total = np.zeros(len(values), np.int64)
        np.add.at(total, where, np.concatenate(weights))
        heavy = values[total > budget]
        mine = [np.frombuffer(x, np.uint64) for x in found["found"].to_pylist()]
        return found.append_column("heavy", pa.array([x[np.isin(x, heavy)].tobytes() for x in mine], pa.binary()))

    return hashes.groupBy("bucket").applyInArrow(meet, FOUND_HEAVY)


def each_chunk(chunks: DataFrame, fn: Callable[[int, pa.Table], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    def run(batches):
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from fn(chunk, unpack(data.as_buffer()))

    return chunks.select("chunk", "data").mapInArrow(run, schema)


def each_chunk_with(chunks: DataFrame, found: DataFrame, fn, schema) -> DataFrame:
    """``fn(chunk id, table, the chunk's rows of found) -> pa.Table``; a chunk
    without such rows gets an empty table."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            raise ValueError("results for a chunk that does not exist")
        return fn(left["chunk"][0].as_py(), unpack(left["data"][0].as_buffer()), right)

    return (chunks.select("chunk", "data").groupBy("chunk")
            .cogroup(found.groupBy("chunk")).applyInArrow(run, schema))


__all__ = ["BATCH_BYTES", "FOUND", "HASHES", "WEIGHED", "blob", "bucket_count", "bucketed", "each_chunk", "each_chunk_with",
           "pack", "recurring", "recurring_weighed", "to_chunks", "unpack"]
