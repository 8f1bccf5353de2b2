"""Long byte matches with earlier documents, by run-length indexes.

A match is ``length`` equal bytes that also start in a document with a smaller
id; every byte under a match goes. Strings that match share their minimizer
(the smallest-hashed ``k`` bytes in them), so:

1. minimizers are exchanged by hash; those held by one document only can't be
   in a match;
2. around the others, the text is cut into segments (the strings that have this
   occurrence as minimizer: at most ``length - k + 1`` of them), which go, equal
   ones of a chunk once, to the bucket of the minimizer; where the segments of
   one minimizer are too many for a task (a passage that very many texts go on
   from differently), each of their strings is a segment and goes to the bucket
   of its own hash, so that a group holds the versions of one string, not of a passage;
   a chunk's segments for a bucket are one row, ordered by index;
3. for each of its indexes a bucket builds a run-compressed Burrows-Wheeler transform of its distinct
   segments: run heads, the suffix-array samples at run ends, and the rows
   where suffixes stop agreeing in ``length`` bytes (thresholds) with the
   smallest document between two of them. Segments are streamed backwards
   through it, all at once, one byte a step; each step gives the row, and so
   whether the statistic "longest match in a smaller document" reaches ``length``;
4. marks go back to the chunks, which cut the bytes.

In repetitive text a bucket's index holds each version of a passage once,
however many documents have it; an equal segment reaches it once a chunk.

Defined results: null or empty text has no bytes; ids are integers, and null ids
come after all others; rows of equal id do not match each other; matches are
judged on the input and never cross texts; repeated texts of larger ids go
whole (from ``length`` bytes on); an empty table gives an empty result; other
columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gazetta.llm.chunks import WEIGHED, blob, bucket_count, bucketed, each_chunk, each_chunk_with, recurring_weighed, to_chunks
from gazetta.llm.context_mixing import _unzip, _zip
from gazetta.llm.util import fresh, hash_ranges, materialise, ranges, read_table, text_bytes

LENGTH = 50
#: Text bytes behind one index: its strings' suffixes are sorted at a time. A
#: bucket has as many indexes as it has text (``bucket_count``).
INDEX_BYTES = 1 << 17
#: Buckets of segments at least, so that a small table is work for many tasks.
LEAST_BUCKETS = 64
#: Bytes of segments (of all chunks) behind one minimizer, above which its group is split.
HEAVY_BYTES = 1 << 20
_NULL_ID = np.iinfo(np.int64).max


# -- the index ------------------------------------------------------------------

class Marks:
    """Marked rows of a range (run heads, thresholds): a bit a row, and the
    marks before each 64 of them."""

    def __init__(self, rows: np.ndarray, n: int):
        bits = np.zeros(-(-max(n, 1) // 64) * 64, np.uint8)
        bits[rows] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.searchsorted(rows, np.arange(len(self.words)) * 64).astype(np.int32)

    def last(self, row: np.ndarray) -> np.ndarray:
        """Number of the last mark at or before each row (the first mark is row 0)."""
        word = row >> 6
        upto = np.uint64(0xFFFFFFFFFFFFFFFF) >> (63 - (row & 63)).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & upto).astype(np.int64) - 1


class RunIndex:
    """Run-compressed BWT of a collection of byte strings (at most some hundred
    bytes each). Suffixes end with their string; a string's end sorts before
    all bytes, equal suffixes by the order of their strings."""

    def __init__(self, raw: np.ndarray, size: np.ndarray, document: np.ndarray, length: int):
        n_strings = len(size)
        self.n_strings, self.size, self.length = n_strings, size, length
        # Symbols from 1 (in byte order), with a 0 after each string.
        ends = np.cumsum(size)
        used = np.flatnonzero(np.bincount(raw, minlength=256))
        dense = np.zeros(256, np.uint64)
        dense[used] = np.arange(1, len(used) + 1)
        sym = np.insert(dense[raw], ends, 0)
        string = np.repeat(np.arange(n_strings), size + 1)
        n = len(sym)
        stop = np.cumsum(size + 1)  # one past each string's end symbol
        left = np.repeat(stop, size + 1) - np.arange(n)  # symbols of the suffix, its end included
        # Ranks by the first ``depth`` symbols, from as many ranks of the round before as a key holds.
        wide = len(used).bit_length()
        depth = min(length, 63 // max(wide, 1))
        key, have = sym.copy(), 1
        while have < depth:  # by doubling
            more = min(have, depth - have)
            after = np.zeros(n, np.uint64)
            after[: max(0, n - have)] = key[have:] >> np.uint64(wide * (have - more))
            after[left <= have] = 0
            key = (key << np.uint64(wide * more)) | after
            have += more
        longest = int(size.max()) + 1 if n_strings else 1
        bits, tie = n.bit_length(), np.uint64(n_strings.bit_length())
        rank, agree = self._ranks(key), (0, None)
        while True:
            if depth <= length:
                agree = (depth, rank)
            if depth >= longest:
                last = rank.astype(np.uint64)
                break
            pair = 2 * depth >= longest and 2 * bits + int(tie) <= 64
            parts = 2 if pair else max(2, 64 // bits)
            key = rank.astype(np.uint64)
            for j in range(1, parts):
                after = np.zeros(n, np.uint64)
                after[: max(0, n - j * depth)] = rank[j * depth:] + 1
                after[left <= j * depth] = 0
                key = (key << np.uint64(bits)) | after
            if pair:
                last = key
                break
            rank, depth = self._ranks(key), depth * parts
        order = np.argsort((last << tie) | string.astype(np.uint64))
        # The transform: the symbol before each suffix (a string's first suffix: its end).
        first = stop - size - 1
        before = np.concatenate([[0], sym[:-1]])[order].astype(np.int64)
        head = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        self.run_start, self.run_symbol = head, before[head]
        run_size = np.diff(np.concatenate([head, [n]]))
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        sizes = run_size[by_symbol]
        ahead = np.cumsum(sizes) - sizes  # rows of runs of smaller symbols, and of earlier runs of the same
        self.run_target = np.empty(len(head), np.int64)
        self.run_target[by_symbol] = ahead
        #: Suffix-array samples at run ends: (string, place in it).
        last = order[head + run_size - 1]
        self.sample_string, self.sample_place = string[last], last - first[string[last]]
        # Thresholds: rows whose suffix does not share its first ``length`` symbols with the row before.
        whole = left[order] > length
        new = np.ones(n, bool)
        new[1:] = ~(whole[1:] & whole[:-1])
        d, r = agree
        for at in [*range(0, length - d, d), length - d]:
            part = r[np.minimum(order + at, n - 1)]
            new[1:] |= part[1:] != part[:-1]
        self.threshold = np.flatnonzero(new)
        self.least = np.minimum.reduceat(document[string[order]], self.threshold) if n else np.zeros(0, np.int64)
        self.runs, self.blocks = Marks(head, n), Marks(self.threshold, n)
        self.jump = self.run_target - self.run_start

    @staticmethod
    def _ranks(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        ordered = key[order]
        out = np.empty(len(key), np.int64)
        out[order] = np.cumsum(np.concatenate([[0], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        return out

    def step(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix one symbol longer, for each row."""
        return self.jump[self.runs.last(row)] + row

    def stream(self):
        """Backwards through all strings at once: (strings, place, the smallest
        document that holds the ``length`` bytes there) a step."""
        row, strings = np.arange(self.n_strings), np.arange(self.n_strings)
        place = self.size.astype(np.int64).copy()
        while len(strings):
            more = place > 0
            row, strings, place = self.step(row[more]), strings[more], place[more] - 1
            whole = self.size[strings] - place >= self.length
            if whole.any():
                yield strings[whole], place[whole], self.least[self.blocks.last(row[whole])]


# -- segments ---------------------------------------------------------------------

def gram_hashes(raw: np.ndarray, k: int, places: np.ndarray | None = None) -> np.ndarray:
    """Hash of the ``k`` >= 8 bytes from each place that has so many, or from ``places``."""
    n = len(raw) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    lanes = np.ndarray((len(raw) - 7,), "<u8", np.ascontiguousarray(raw).data, strides=(1,))
    h = np.zeros(n if places is None else len(places), np.uint64)
    for at in [*range(0, k - 8, 8), k - 8]:
        h += lanes[at: at + n] if places is None else lanes[places + at]
        h *= np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


#: Strings whose minimizers are looked for at a time.
BLOCK = 1 << 16


class Segments:
    """Minimizer segments of a chunk: ``gram`` (the minimizer's hash), byte
    ``start`` and number of ``windows`` (strings) of each, and its text."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, length: int):
        k = max(16, length - 34)
        wide = length - k + 1
        ends, sizes = offsets[1:], np.diff(offsets)
        n = max(0, len(raw) - length + 1)
        place = np.empty(n, np.int32)  # of each string's minimizer
        for a in range(0, n, BLOCK):
            b = min(n, a + BLOCK)
            # Hash above, place below: the leftmost of equal minima.
            least = gram_hashes(raw[a: b + length - 1], k) & np.uint64(0xFFFFFFFF00000000)
            least |= np.arange(len(least), dtype=np.uint64)
            size = 1
            while size * 2 <= wide:
                least = np.minimum(least[:-size], least[size:])
                size *= 2
            if wide > size:
                least = np.minimum(least[: size - wide], least[wide - size:])
            place[a:b] = least & np.uint64(0xFFFFFFFF)
            place[a:b] += a
        # Strings that reach over the end of their text do not count.
        whole = np.ones(n + 1, bool)
        whole[-1] = False
        short = np.minimum(sizes, length - 1)
        over = ranges(ends - short, short)
        whole[over[over < len(whole)]] = False
        change = np.ones(n + 1, bool)
        change[1:-1] = (place[1:] != place[:-1]) | ~whole[: n - 1] if n else change[1:-1]
        head = np.flatnonzero(whole & change)
        last = np.flatnonzero(whole[:-1] & (change[1:] | ~whole[1:]))
        self.gram, self.start, self.windows = gram_hashes(raw, k, place[head]), head, last - head + 1
        self.doc = np.searchsorted(offsets, head, side="right") - 1

    def only(self, keep: np.ndarray) -> "Segments":
        self.gram, self.start, self.windows, self.doc = self.gram[keep], self.start[keep], self.windows[keep], self.doc[keep]
        return self

    def split(self, heavy: np.ndarray, raw: np.ndarray, length: int) -> "Segments":
        """Each of the ``heavy`` segments as one segment a string, under the
        hash of that string in place of its minimizer's."""
        times = np.where(heavy, self.windows, 1)
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        own = np.repeat(heavy, times)
        self.gram, self.start, self.windows, self.doc = (np.repeat(x, times) for x in (self.gram, self.start, self.windows, self.doc))
        self.start += at
        self.windows[own] = 1
        self.gram[own] = hash_ranges(raw, self.start[own], np.full(own.sum(), length, np.int64))
        return self


def _ids(table: pa.Table, id_col: str) -> np.ndarray:
    return np.asarray(pa.compute.fill_null(table[id_col].combine_chunks().cast(pa.int64()), _NULL_ID))


def _anchors(chunk: int, table: pa.Table, id_col: str, text_col: str, length: int, buckets: int):
    raw, offsets = text_bytes(table[text_col])
    s = Segments(raw, offsets, length)
    _, number = np.unique(_ids(table, id_col), return_inverse=True)
    # Hashes that two documents of the chunk hold count as found already.
    order = np.lexsort((number[s.doc], s.gram))
    gram, doc = s.gram[order], number[s.doc][order]
    twice = gram[1:][(gram[1:] == gram[:-1]) & (doc[1:] != doc[:-1])]
    # The bytes that would follow each hash to its group: those of equal segments once.
    size = s.windows + length - 1
    weight = size.copy()
    order = np.argsort(s.gram, kind="stable")
    same = s.gram[order][1:] == s.gram[order][:-1]
    again = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(order) else order
    key = hash_ranges(raw, s.start[again], size[again])
    by = np.lexsort((key, s.gram[again]))
    equal = (key[by][1:] == key[by][:-1]) & (s.gram[again][by][1:] == s.gram[again][by][:-1])
    weight[again[by][1:][equal]] = 0
    yield bucketed(chunk, s.gram, buckets, more=np.unique(twice), weights=weight)


class _Chosen:
    """A chunk's segments around found minimizers (heavy ones: a segment a
    string), equal ones once, by index."""

    def __init__(self, table, found: np.ndarray, heavy: np.ndarray, id_col, text_col, length, indexes):
        self.raw, self.offsets = text_bytes(table[text_col])
        s = Segments(self.raw, self.offsets, length)
        s = s.only(np.isin(s.gram, found))
        if len(heavy):
            s = s.split(np.isin(s.gram, heavy), self.raw, length)
        self.all = s
        self.id = _ids(table, id_col)[s.doc]
        size = s.windows + length - 1
        key = hash_ranges(self.raw, s.start, size)
        order = np.lexsort((self.id, key))
        head = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(order) else order
        #: The segment of the smallest id of each group of equal ones, by index.
        self.first = order[head]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(np.isin(np.arange(len(order)), head)) - 1 if len(order) else 0
        index = ((s.gram[self.first] >> np.uint64(24)) % np.uint64(indexes)).astype(np.int64)
        by = np.lexsort((key[self.first], index))
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        self.first, self.group = self.first[by], place[group] if len(by) else group
        #: Segments of each index.
        self.count = np.bincount(index, minlength=indexes).astype(np.int32)

    def by_bucket(self, each: int):
        """(bucket of ``each`` indexes, its range of ``first``), empty ones left out."""
        cut = np.concatenate([[0], np.cumsum(self.count)])[::each]
        some = np.flatnonzero(np.diff(cut))
        return zip(some.tolist(), cut[some].tolist(), cut[some + 1].tolist())


#: ``counts``: segments of each of the bucket's indexes (int32).
SEGMENTS = "bucket int, chunk long, counts binary, windows binary, id binary, raw binary"
MARKS = "chunk long, bucket int, marks binary"


def _send(chunk, table, found, id_col, text_col, length, buckets, each) -> pa.Table:
    c = _Chosen(table, blob(found["found"]), blob(found["heavy"]), id_col, text_col, length, buckets * each)
    out = []
    for b, lo, hi in c.by_bucket(each):
        i = c.first[lo:hi]
        windows = c.all.windows[i]
        out.append((b, chunk, c.count[b * each: (b + 1) * each].tobytes(), _zip(windows.astype(np.uint8)), _zip(c.id[i]),
                    _zip(c.raw[ranges(c.all.start[i], windows + length - 1)])))
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*out)) or [()] * 6, kinds)], names=[x.split()[0] for x in SEGMENTS.split(", ")])


def _index_marks(key: np.ndarray, start: np.ndarray, size: np.ndarray, ids: np.ndarray, raw: np.ndarray, length: int) -> np.ndarray:
    """Bit p of a segment's mark: its string at place p is in a smaller document."""
    key, first, where = np.unique(key, return_index=True, return_inverse=True)
    least = np.full(len(key), _NULL_ID)
    np.minimum.at(least, where, ids)
    marks = np.zeros(len(ids), np.uint64)
    index = RunIndex(raw[ranges(start[first], size[first])], size[first], least, length)
    members = np.argsort(where, kind="stable")
    count = np.bincount(where, minlength=len(key))
    at = np.cumsum(count) - count
    for strings, place, smallest in index.stream():
        i = members[ranges(at[strings], count[strings])]
        lower = np.repeat(smallest, count[strings]) < ids[i]
        marks[i[lower]] |= np.uint64(1) << np.repeat(place, count[strings])[lower].astype(np.uint64)
    return marks


def _mark(length: int, each: int):
    def run(table: pa.Table) -> pa.Table:
        count = np.array([np.frombuffer(x.as_buffer(), np.int32) for c in table["counts"].chunks for x in c], np.int64)

        def column(name, kind):
            return np.concatenate([_unzip(x.as_buffer(), kind) for c in table[name].chunks for x in c])

        size = column("windows", np.uint8).astype(np.int64) + (length - 1)
        ids, raw = column("id", np.int64), column("raw", np.uint8)
        start = np.cumsum(size) - size
        key = hash_ranges(raw, start, size)
        # The segments of an index, chunk by chunk: all chunks have theirs in the order of the indexes.
        of = np.argsort(np.repeat(np.tile(np.arange(each, dtype=np.int32), len(count)), count.ravel()), kind="stable")
        marks = np.zeros(len(ids), np.uint64)
        for own in np.split(of, np.cumsum(count.sum(axis=0))[:-1]):
            if len(own):
                marks[own] = _index_marks(key[own], start[own], size[own], ids[own], raw, length)
        ends = np.cumsum(count.sum(axis=1))
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"],
                         "marks": pa.array([_zip(x) for x in np.split(marks, ends[:-1])], pa.binary())})

    return run


def _under(n: int, start: np.ndarray, windows: np.ndarray, marks: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` bytes are under a marked string of these segments (all
    strings of all segments start at different places)."""
    edge = np.zeros(n + 1, np.int32)
    marks = marks & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (64 - windows).astype(np.uint64))
    every = np.bitwise_count(marks) == windows
    edge[start[every]] += 1
    edge[start[every] + windows[every] + length - 1] -= 1
    some = np.flatnonzero(~every & (marks != 0))
    seg = np.repeat(some, windows[some])
    place = ranges(np.zeros(len(some), np.int64), windows[some])
    at = (start[seg] + place)[(marks[seg] >> place.astype(np.uint64)) & np.uint64(1) == 1]
    edge[at] += 1
    edge[at + length] -= 1
    return np.cumsum(edge[:n], dtype=np.int32) > 0


def remove_matches(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    names: tuple[str, str, str] = ("n_bytes", "n_removed", "removed"), heavy_bytes: int = HEAVY_BYTES,
) -> DataFrame:
    """``df`` with ``text_col`` as the bytes that remain, plus columns for the
    number of bytes, of removed bytes, and the removed runs (start, end).
    ``heavy_bytes``: segment bytes beyond which a minimizer's group is split;
    the result does not depend on it."""
    if length < 24:
        raise ValueError("matches must have at least 24 bytes")
    chunks = to_chunks(df, text_col, "bytes")
    buckets = bucket_count(chunks)
    anchors = each_chunk(chunks, lambda c, t: _anchors(c, t, id_col, text_col, length, buckets), WEIGHED)
    found = materialise(recurring_weighed(anchors, heavy_bytes), "minimizers", once=True)
    groups = max(LEAST_BUCKETS, buckets)
    each = max(1, -(-(chunks.agg(F.sum("bytes")).first()[0] or 0) // (groups * INDEX_BYTES)))
    sent = each_chunk_with(chunks, found, lambda c, t, f: _send(c, t, f, id_col, text_col, length, groups, each), SEGMENTS)
    marks = sent.groupBy("bucket").applyInArrow(_mark(length, each), MARKS)

    n_bytes, n_removed, removed = (fresh(df.columns, x) for x in names)
    fields = [T.StructField(f.name, T.BinaryType()) if f.name == text_col else f for f in df.schema.fields]
    schema = T.StructType([*fields, T.StructField(n_bytes, T.LongType()), T.StructField(n_removed, T.LongType()),
                           T.StructField(removed, T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    arrow = to_arrow_schema(schema)

    def cut(chunk, table, right):
        c = _Chosen(table, blob(right["found"]), blob(right["heavy"]), id_col, text_col, length, groups * each)
        mark = np.zeros(len(c.first), np.uint64)
        returned = {b: data for b, data in zip(right["bucket"].to_pylist(), right["marks"].to_pylist()) if data}
        for b, lo, hi in c.by_bucket(each):
            mark[lo:hi] = _unzip(returned[b], np.uint64)
        n = len(c.raw)
        own = mark[c.group]
        # An equal segment of a larger id: the one of the smallest id holds all its strings.
        own[c.id > c.id[c.first][c.group]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        gone = _under(n, c.all.start, c.all.windows, own, length)
        texts = len(c.offsets) - 1
        kept = np.concatenate([np.zeros(1, np.int32), np.cumsum(~gone, dtype=np.int32)])[c.offsets]
        doc_start = np.zeros(n + 1, bool)
        doc_start[c.offsets] = True
        begin = np.flatnonzero(gone & (doc_start[:n] | ~np.concatenate([[False], gone[:-1]])))
        end = np.flatnonzero(gone & (doc_start[1:] | ~np.concatenate([gone[1:], [False]]))) + 1
        runs = np.searchsorted(begin, c.offsets)
        base = np.repeat(c.offsets[:-1], np.diff(runs))
        kind = arrow.field(removed).type
        pairs = pa.StructArray.from_arrays([pa.array(begin - base, pa.int64()), pa.array(end - base, pa.int64())], fields=list(kind.value_type))
        columns = {x: table[x] for x in table.column_names}
        columns[text_col] = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), texts, [None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(c.raw[~gone])]).cast(pa.binary())
        columns |= {n_bytes: pa.array(np.diff(c.offsets), pa.int64()), n_removed: pa.array(np.diff(c.offsets) - np.diff(kept), pa.int64()),
                    removed: pa.ListArray.from_arrays(pa.array(runs, pa.int32()), pairs, type=kind)}
        return pa.Table.from_arrays([columns[f.name] for f in arrow], names=arrow.names).cast(arrow)

    both = found.unionByName(marks, allowMissingColumns=True)
    return each_chunk_with(chunks, both, cut, schema)


def op6_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_matches(docs)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"))
