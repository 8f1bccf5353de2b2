"""Repeated passages by difference-cover anchors.

A window is ``window`` consecutive words of one text. With a difference cover D
modulo v, any two positions i and j have a k < v with (i+k) mod v and
(j+k) mod v both in D. So hashes of shorter windows (``window - v + 1`` words)
taken *only at cover positions* meet for any two equal windows: these anchors
(|D|/v of all positions) are exchanged first. Around anchors that recur, the
match is extended: windows that hold one at an offset below v are hashed whole
and exchanged; those that occur twice are repeated, and their words removed.

Defined results: null or empty text has no words and stays empty; null or
repeated ids are rows like any other (two rows with equal text are copies of
each other); windows are judged on the input, all copies are removed; an empty
table gives an empty result; other columns pass through unchanged; where one
has an output's name, the output's name gets ``_`` appended until it is free.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gazetta.llm.chunks import HASHES, blob, bucket_count, bucketed, each_chunk, each_chunk_with, recurring, to_chunks
from gazetta.llm.util import Words, fresh, ranges, read_table, text_bytes, window_hashes

#: Perfect difference sets: every difference modulo the period occurs.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
WINDOW = 35


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves anchors of at least 12 words (or 1, if none does)."""
    period = max([v for v in COVERS if window - v + 1 >= 12], default=1)
    return period, COVERS[period]


def _words(table: pa.Table, text_col: str) -> Words:
    return Words(*text_bytes(table[text_col]))


class _Plan:
    """What both passes compute of a chunk's words."""

    def __init__(self, window: int):
        self.window = window
        self.period, cover = cover_for(window)
        self.width = window - self.period + 1
        self.at = np.isin(np.arange(self.period), cover)

    def anchors(self, w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word positions, hashes) of the anchors."""
        place = (np.arange(len(h)) - np.repeat(w.first[:-1], w.counts)) % self.period
        pos = np.flatnonzero(self.at[place] & (w.left() >= self.width) & (np.repeat(w.counts, w.counts) >= self.window))
        return pos, window_hashes(h, self.width)[pos] if len(pos) else np.zeros(0, np.uint64)

    def candidates(self, w: Words, h: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of whole windows around anchors that recur."""
        pos, anchor = self.anchors(w, h)
        hit = np.zeros(len(h) + self.period + 1, np.int64)
        hit[pos[np.isin(anchor, found)] + 1] = 1
        total = np.cumsum(hit)
        n = len(h)
        near = total[self.period: self.period + n] - total[:n] > 0
        start = np.flatnonzero(near & (w.left() >= self.window))
        return start, window_hashes(h, self.window)[start] if len(start) else np.zeros(0, np.uint64)


def _cut(w: Words, gone: np.ndarray, joined: bool) -> pa.Array:
    """The texts without the words in ``gone``. ``joined``: words separated by
    one space; else the text between kept words stays as it is."""
    n_docs = len(w.offsets) - 1
    kept = np.flatnonzero(~gone)
    doc = w.doc[kept]
    if joined:
        size = w.end[kept] - w.start[kept] + 1
        take = ranges(w.start[kept], size)
        out = np.empty(len(take), np.uint8)
        ends = np.cumsum(size) - 1
        inside = np.ones(len(take), bool)
        inside[ends] = False
        out[inside] = w.raw[take[inside]]
        out[ends] = 32
        per_doc = np.bincount(doc, weights=size, minlength=n_docs).astype(np.int64)
        has = per_doc > 0
        last = np.cumsum(per_doc)[has] - 1  # each text's final space goes
        out = np.delete(out, last)
        per_doc[has] -= 1
    else:
        keep = np.ones(len(w.raw), bool)
        idx = np.flatnonzero(gone)
        if len(idx):
            # From a removed word to the next word, or to the end of its text.
            following = np.concatenate([w.start[1:], [len(w.raw)]])
            stop = np.where(w.left() > 1, following, w.offsets[1:][w.doc] if len(w.doc) else 0)
            keep[ranges(w.start[idx], (stop - w.start)[idx])] = False
        out = w.raw[keep]
        per_doc = np.add.reduceat(np.concatenate([keep, [False]]).astype(np.int64), w.offsets[:-1]) if n_docs else np.zeros(0, np.int64)
        per_doc = np.where(np.diff(w.offsets) > 0, per_doc, 0)
    offsets = np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(n_docs, pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())


def _spans(w: Words, gone: np.ndarray) -> pa.Array:
    """Removed runs of each text as word positions (start, end)."""
    if not len(gone):
        return pa.array([[] for _ in range(len(w.offsets) - 1)], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
    place = np.arange(len(gone)) - np.repeat(w.first[:-1], w.counts)
    before = np.concatenate([[False], gone[:-1]]) & (place > 0)
    after = np.concatenate([gone[1:], [False]]) & (w.left() > 1)
    first, last = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
    offsets = np.searchsorted(first, w.first)
    pairs = pa.StructArray.from_arrays(
        [pa.array(place[first], pa.int32()), pa.array(place[last] + 1, pa.int32())], names=["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)


def substring_dedup(
    df: DataFrame, text_col: str = "text", window: int = WINDOW, joined: bool = True,
    names: tuple[str, str, str] = ("n_words", "n_removed", "removed"),
) -> DataFrame:
    """``df`` with repeated passages cut from ``text_col``, plus columns for the
    number of words, of removed words, and the removed runs."""
    plan = _Plan(window)
    chunks = to_chunks(df, text_col, "passages")
    buckets = bucket_count(chunks)

    def first(chunk, table):
        w = _words(table, text_col)
        yield bucketed(chunk, plan.anchors(w, w.hashes())[1], buckets)

    def second(chunk, table, found):
        w = _words(table, text_col)
        return pa.Table.from_batches([bucketed(chunk, plan.candidates(w, w.hashes(), blob(found["found"]))[1], buckets)])

    n_words, n_removed, removed = (fresh(df.columns, x) for x in names)
    schema = T.StructType([*df.schema.fields, T.StructField(n_words, T.LongType()), T.StructField(n_removed, T.LongType()),
                           T.StructField(removed, T.ArrayType(T.StructType([
                               T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
    arrow = to_arrow_schema(schema)

    def third(chunk, table, found):
        w = _words(table, text_col)
        twice = blob(found["found"])
        n = len(w.start)
        gone = np.zeros(n, bool)
        if len(twice):
            h = w.hashes()
            whole = window_hashes(h, window)
            start = np.flatnonzero(np.isin(whole, twice) & (w.left()[: len(whole)] >= window))
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + window, -1)
            gone = np.cumsum(edge)[:n] > 0
        counts = np.bincount(w.doc[gone], minlength=table.num_rows)
        columns = {c: table[c] for c in table.column_names}
        columns[text_col] = _cut(w, gone, joined)
        columns |= {n_words: pa.array(w.counts, pa.int64()), n_removed: pa.array(counts, pa.int64()), removed: _spans(w, gone)}
        return pa.Table.from_arrays([columns[f.name] for f in arrow], names=[f.name for f in arrow]).cast(arrow)

    anchors = recurring(each_chunk(chunks, first, HASHES))
    windows = recurring(each_chunk_with(chunks, anchors, second, HASHES))
    return each_chunk_with(chunks, windows, third, schema)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without repeated passages; untouched texts stay byte for byte."""
    names = tuple(fresh(docs.columns, x) for x in ("__words", "__removed", "__runs"))
    out = substring_dedup(docs, joined=False, names=names).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS p FROM d WHERE len(ws) >= 35),
g AS (SELECT s.doc_id, p, md5(array_to_string(ws[p:p + 34], ' ')) AS h FROM s JOIN d ON d.doc_id = s.doc_id),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY h) AS n FROM g) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM r, range(35) AS x(k)),
k AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
wp AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT wp.doc_id, string_agg(w, ' ' ORDER BY wp.p) AS t FROM wp ANTI JOIN gone ON gone.doc_id = wp.doc_id AND gone.p = wp.p GROUP BY wp.doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
