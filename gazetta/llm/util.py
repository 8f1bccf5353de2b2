"""Helpers shared by the operators: scratch tables, text batches, word hashes."""

from __future__ import annotations

import gc
import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.session import checkpoint_dir, delete_path

#: The six separators of the word pattern ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\f\r"
#: Text bytes that a Python worker turns into arrays at a time.
BATCH_BYTES = 4 << 20


# -- tables ---------------------------------------------------------------

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once an application
    (they need not have the repository on their path)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="gazetta-code-"), "gazetta.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(os.path.join(root, "gazetta")):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, root))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


_written: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(spark: SparkSession) -> list[str]:
    """The folders that this application's operators wrote so far."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def clear_scratch(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete folders that operators wrote (by default all of this application);
    lazy results over them can't be read any more. Returns how many."""
    mine = _written.get(spark.sparkContext.applicationId, [])
    paths = list(mine) if paths is None else [p for p in paths if p in mine]
    for path in paths:
        delete_path(spark, path)
        mine.remove(path)
    return len(paths)


#: Whether Spark drops shuffle files when a query over them has ended; rows that go to a Python worker at a time.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def settings(spark: SparkSession, values: dict) -> Iterator[None]:
    """Within, the session has these settings (for what is run, not only built, within)."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialise(df: DataFrame, name: str, once: bool = False, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read that copy:
    later branches and retries after a lost executor never recompute it.
    ``once``: Spark may drop the shuffle files when it is written.
    ``batch_rows``: rows that go to a Python worker at a time, where rows are large."""
    ship(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    with settings(df.sparkSession, ({CLEAN: "true"} if once else {}) | ({ARROW_ROWS: batch_rows} if batch_rows else {})):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of ids (some 50 bytes each in a hash table) that may be broadcast.
BROADCAST_IDS = 1_000_000


def few(ids: DataFrame, name: str) -> DataFrame:
    """A one-column table of ids, written; to be broadcast if it has at most
    ``BROADCAST_IDS`` rows, so that the other side of its join stays in place.
    Beyond, the planner shuffles both sides."""
    ids = materialise(ids, name)
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(columns, base: str) -> str:
    """``base``, lengthened until no column of that name exists (case-blind)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def input_bytes(df: DataFrame, text_col: str) -> int:
    """Total UTF-8 bytes of a column: one pruned aggregate over the whole table."""
    return df.agg(F.sum(F.octet_length(F.col(text_col))).alias("b")).first()["b"] or 0


# -- Python workers ---------------------------------------------------------

def _kept() -> dict:
    return sys.modules.setdefault("_gazetta_worker_memory", SimpleNamespace(by_key={})).by_key


def worker_memory(key) -> SimpleNamespace:
    """Things that a Python worker keeps from task to task, by key."""
    return _kept().setdefault(key, SimpleNamespace())


def forget() -> None:
    """Drop what operators before kept in this worker (Spark uses workers again
    and again). Called where an operator begins to read its table."""
    if _kept():
        _kept().clear()
        gc.collect()


# -- text batches -----------------------------------------------------------

def text_slices(batch: pa.RecordBatch, text: str, max_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of at most ``max_bytes`` of text (one row at least)."""
    if batch.num_rows == 0:
        return
    col = batch.column(batch.schema.get_field_index(text))
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0).cast(pa.int64()))
    ends = np.cumsum(sizes)
    lo, base = 0, 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(lo, hi - lo)
        lo, base = hi, int(ends[hi - 1])


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    kind = pa.large_binary()
    col = pa.compute.fill_null(col.cast(kind), b"")
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], (offsets - offsets[0]).astype(np.int64)


_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


class Words:
    """The words of a batch of texts as arrays.

    ``start``/``end``: byte range of each word; ``first``: index of each text's
    first word (one more entry than texts).
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        space = _WS[raw]
        n = len(raw)
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0] = after[-1] = True
            before[1:] = space[:-1]
            after[:-1] = space[1:]
            inner = offsets[(offsets > 0) & (offsets < n)]
            before[inner] = True
            after[inner - 1] = True
        self.raw, self.offsets = raw, offsets
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(~space & after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return hash_ranges(self.raw, self.start, self.end - self.start, seed)

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.start))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


#: Longer ranges are hashed each as a whole, not in step with the others.
LONG_RANGE = 4096


def _hash_long(whole: np.ndarray) -> np.ndarray:
    """A sum of mixed lanes, each with its place; a megabyte at a time."""
    total = np.zeros(1, np.uint64)
    for at in range(0, len(whole), 1 << 20):
        part = whole[at: at + (1 << 20)]
        lanes = np.concatenate([part, np.zeros(-len(part) % 8, np.uint8)]).view("<u8")
        place = np.arange(at // 8, at // 8 + len(lanes), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        total = total + mix(mix(lanes ^ place) + place).sum(dtype=np.uint64)
    return total[0]


def hash_ranges(raw: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes at a time."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded.data, strides=(1,))
    h = mix(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    long = size > LONG_RANGE
    for i in np.flatnonzero(long):
        h[i] ^= _hash_long(raw[start[i]: start[i] + size[i]])
        h[i: i + 1] = mix(h[i: i + 1])
    active, done = np.flatnonzero(~long), 0
    while len(active):
        rest = size[active] - done
        lane = lanes[start[active] + done]
        part = rest < 8
        if part.any():
            keep = (np.uint64(1) << (np.uint64(8) * np.clip(rest, 0, 7).astype(np.uint64))) - np.uint64(1)
            lane = np.where(part, lane & keep, lane)
        h[active] = mix((h[active] ^ lane) * np.uint64(0xA0761D6478BD642F) + np.uint64(0x2545F4914F6CDD1D))
        done += 8
        active = active[rest > 8]
    return h


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive entries (length ``len(h)-k+1``),
    built by doubling: log2(k) passes, whatever ``k``."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, covered, power, size = None, 0, h, 1
    while True:
        if k & size:
            piece = power[covered: covered + n]
            out = piece if out is None else mix(out * np.uint64(0x9FB21C651E98DF25) + piece)
            covered += size
        if size * 2 > k:
            return out.copy() if out is power or out.base is not None else out
        power = mix(power[:-size] * np.uint64(0x9FB21C651E98DF25) + power[size:])
        size *= 2


def fresh_arrow(names, arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(arrays, names=names)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start+size)`` for all pairs."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(start - (np.cumsum(size) - size), size)
    return shift + np.arange(total)
