"""Periodic runs of words by Baier grouping.

A run is a longest stretch of words with smallest period q, so that words q
apart are equal. Every run holds a Lyndon root: a stretch of q words that is
the longest Lyndon word at its place, under the order of words or under the
reverse order, followed by itself. So:

1. The grouping phase of Baier's suffix sorter (suffixes in groups by what is
   known of them; the highest group left hands its context to the nearest lower
   suffix before each of its members) gives the Lyndon arrays, for both orders
   directly: a suffix's group is final when its turn comes, and its context is
   the longest Lyndon word there. Suffixes are never sorted within groups.
2. Two equal Lyndon words in a row (same group) are extended left and right by
   longest common extensions into a run (a run of three periods has such two).

All stretches of a batch go through the phase side by side: a step takes the
highest group left of every stretch, so steps follow the longest stretch and
not the number of texts.

A run of at least ``min_length`` words and ``min_exponent`` periods lies within
words whose windows of ``min_length - min_length // min_exponent`` words occur
twice or more in the text. Only such stretches can hold a run, and only they are
grouped; the bound is exact.

Defined results: null or empty text has no words and no runs; runs never reach
over texts; null or repeated ids are rows like any other; an empty table gives
an empty result; other columns pass through unchanged; an output whose name the
input has already gets underscores behind it. A text is worked on
whole in one task; it takes some 30 bytes a byte there.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gazetta.llm.util import Words, forget, fresh, mix, ranges, read_table, ship, text_bytes, text_slices, window_hashes

MIN_LENGTH, MIN_EXPONENT = 24, 3
RUN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])


# -- grouping ---------------------------------------------------------------

def _ends_of_chains(link: np.ndarray, inside: np.ndarray, local: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For members of a group linked to each other: the member at the end of
    each one's chain (by pointer doubling), and what that one is linked to."""
    end = np.arange(len(link))
    if inside.any():
        end[inside] = local[link[inside]]
        while True:
            further = end[end]
            if np.array_equal(further, end):
                break
            end = further
    return end, link[end]


def lyndon_groups(rank: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(length of the longest Lyndon word at each place, its final group) of the
    strings ``rank[first[k]:first[k+1]]``, none of them empty. Places of a string
    with equal Lyndon words have the same group."""
    n = len(rank)
    string = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((rank, string))  # members of a group stand together, groups ascending
    slot = np.empty(n, np.int64)
    slot[order] = np.arange(n)
    head = np.ones(n, bool)
    head[1:] = (rank[order][1:] != rank[order][:-1]) | (string[1:] != string[:-1])
    starts = np.flatnonzero(head)
    group = np.empty(n, np.int64)  # a group is named by its first slot
    group[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    stop = np.zeros(n + 1, np.int64)  # and ends before this slot
    stop[starts] = np.append(starts[1:], n)
    # The places not yet taken, as a list linked both ways; n is past either end.
    before, after = np.arange(-1, n), np.arange(1, n + 2)
    before[first[:-1]] = n
    after[first[1:] - 1] = n
    length = np.ones(n + 1, np.int64)
    taken, moved, local = np.full(n + 1, -1), np.full(n + 1, -1), np.zeros(n + 1, np.int64)
    final = np.zeros(n, np.int64)
    active, left = np.arange(len(first) - 1), first[1:].copy()
    step = 0
    while len(active):
        step += 1
        end = left[active]
        top = order[end - 1]
        begin = group[top]
        size = end - begin
        if len(active) == len(size) == int(size.sum()):  # one member each, as most groups have
            member, known = top, length[top]
            final[member] = begin
            heads, low, high = slice(None), before[member], after[member]
            times = 1
        else:
            member = order[ranges(begin, size)]
            final[member] = np.repeat(begin, size)
            known = np.repeat(length[top], size)
            taken[member] = step
            local[member] = np.arange(len(member))
            low, high = before[member], after[member]
            in_low, in_high = taken[low] == step, taken[high] == step
            chain, low = _ends_of_chains(low, in_low, local)
            _, high = _ends_of_chains(high, in_high, local)
            heads = ~in_low
            times = np.bincount(chain, minlength=len(member))[heads]
        after[low] = high
        before[high] = low
        left[active] = begin
        active = active[begin > first[active]]
        # The nearest lower places take on the context, once for each member of their chain.
        target, grown = low[heads], times * known[heads]
        real = target < n
        if not real.any():
            continue
        target, grown = target[real], grown[real]
        times = times[real] if isinstance(times, np.ndarray) else np.ones(len(target), np.int64)
        length[target] += grown
        # Each one's group is split: those that took more go further up.
        old = group[target]
        by = np.lexsort((times, old))
        target, old, times = target[by], old[by], times[by]
        new_old = np.append(True, old[1:] != old[:-1])
        lead = np.flatnonzero(new_old)
        count = np.diff(np.append(lead, len(old)))
        border = stop[old[lead]] - count
        place = ranges(border, count)
        moved[target] = step
        sitting = order[place]
        staying = sitting[moved[sitting] != step]
        if len(staying):
            own = slot[target]
            free = own[own < np.repeat(border, count)]
            order[free] = staying
            slot[staying] = free
        order[place] = target
        slot[target] = place
        lead_slot = old[lead]
        rest = border > lead_slot
        stop[lead_slot[rest]] = border[rest]
        part = np.flatnonzero(new_old | np.append(True, times[1:] != times[:-1]))
        part_size = np.diff(np.append(part, len(old)))
        group[target] = np.repeat(place[part], part_size)
        stop[place[part]] = place[part] + part_size
    return length[:n], final


# -- runs --------------------------------------------------------------------

def _extension(word: np.ndarray, at: np.ndarray, other: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` and from ``other`` on agree, going by ``step``
    (1 or -1), up to ``room``: compared in blocks that grow."""
    found = np.zeros(len(at), np.int64)
    active, block = np.flatnonzero(room > 0), 8
    while len(active):
        wide = max(1, min(block, (1 << 20) // len(active)))
        reach = found[active][:, None] + np.arange(wide)
        inside = reach < room[active][:, None]
        reach = np.where(inside, reach, 0) * step
        same = inside & (word[at[active][:, None] + reach] == word[other[active][:, None] + reach])
        whole = same.all(axis=1)
        found[active] += np.where(whole, wide, np.argmin(same, axis=1))
        active, block = active[whole], block * 2
    return found


def runs_of(word: np.ndarray, first: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """Rows (string, start in ``word``, length, period), ascending, of the
    strings of word numbers ``word[first[k]:first[k+1]]``, none of them empty."""
    n, out = len(word), []
    if not n:
        return np.zeros((0, 4), np.int64)
    both = np.concatenate([word, word.max() - word])  # the reverse order, beside
    length, group = lyndon_groups(both, np.concatenate([first, first[1:] + n]))
    end = np.repeat(first[1:], np.diff(first))
    begin = np.repeat(first[:-1], np.diff(first))
    place = np.arange(n)
    for shift in (0, n):
        root, g = length[shift: shift + n], group[shift: shift + n]
        ahead, behind = np.minimum(place + root, n - 1), np.maximum(place - root, 0)
        twice = (place + root < end) & (g[ahead] == g)
        # A row of equal Lyndon words is one run: take its first.
        i = np.flatnonzero(twice & ~((place - root >= begin) & (g[behind] == g)))
        q = root[i]
        right = _extension(word, i + q, i, end[i] - i - q, 1)
        back = _extension(word, i - 1, i - 1 + q, i - begin[i], -1)
        size = q + right + back
        good = (size >= min_length) & (size >= min_exponent * q)
        out.append(np.stack([np.searchsorted(first, i[good], side="right") - 1, (i - back)[good], size[good], q[good]], axis=1))
    return np.unique(np.concatenate(out), axis=0)


def _numbers(w: Words, at: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words (by 128 bits of hash), for the words ``at``."""
    sub = Words.__new__(Words)
    sub.raw, sub.start, sub.end = w.raw, w.start[at], w.end[at]
    a, b = sub.hashes(), sub.hashes(seed=1)
    _, head, number = np.unique(a, return_index=True, return_inverse=True)
    if (b != b[head][number]).any():
        number = np.unique(np.stack([a, b], axis=1), axis=0, return_inverse=True)[1].reshape(-1)
    return number.astype(np.int64)


def text_runs(w: Words, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (text, first word's number in its text, length, period), ascending."""
    n, width = len(w.start), min_length - min_length // min_exponent
    h = window_hashes(w.hashes(), width)
    if not len(h):
        return np.zeros((0, 4), np.int64)
    inside = np.flatnonzero(w.left()[: len(h)] >= width)
    key = mix(h[inside] + w.doc[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(key)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    where = np.minimum(np.searchsorted(again, key), max(len(again) - 1, 0))
    hit = inside[again[where] == key] if len(again) else inside[:0]
    edge = np.zeros(n + 1, np.int64)
    edge[hit] += 1
    edge[hit + width] -= 1
    kept = np.flatnonzero(np.cumsum(edge)[:n] > 0)
    if not len(kept):
        return np.zeros((0, 4), np.int64)
    # Stretches: consecutive words of one text, long enough for a run.
    cut = np.flatnonzero((np.diff(kept) > 1) | (w.doc[kept][1:] != w.doc[kept][:-1])) + 1
    lo, hi = np.append(0, cut), np.append(cut, len(kept))
    fits = hi - lo >= min_length
    kept = kept[ranges(lo[fits], (hi - lo)[fits])]
    first = np.append(0, np.cumsum((hi - lo)[fits]))
    found = runs_of(_numbers(w, kept), first, min_length, min_exponent)
    at = kept[found[:, 1]]
    return np.stack([w.doc[at], at - w.first[w.doc[at]], found[:, 2], found[:, 3]], axis=1)


def _collapsed(w: Words, gone: np.ndarray) -> pa.Array:
    """Each text's words that are not in ``gone``, joined by one space."""
    kept = np.flatnonzero(~gone)
    size = w.end[kept] - w.start[kept] + 1
    taken = ranges(w.start[kept], size)
    last = np.cumsum(size) - 1
    out = np.empty(len(taken), np.uint8)
    inner = np.ones(len(taken), bool)
    inner[last] = False
    out[inner], out[last] = w.raw[taken[inner]], 32
    words = np.concatenate([[0], np.cumsum(np.bincount(w.doc[kept], minlength=len(w.offsets) - 1))])
    ends = np.concatenate([[0], np.cumsum(size)])[words]  # of each text, with a space too many if it has words
    has = np.diff(words) > 0
    out = np.delete(out, ends[1:][has] - 1)
    offsets = ends - np.concatenate([[0], np.cumsum(has)])
    return pa.LargeStringArray.from_buffers(len(has), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def collapse_runs(
    df: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
    names: tuple[str, str, str] = ("n_words", "runs", "collapsed"),
) -> DataFrame:
    """``df`` plus each text's number of words, its runs (start, length, period;
    by start, then period) and the text without the words of a run after its
    first period (the others joined by one space)."""
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more: shorter runs need not hold their Lyndon root twice")
    ship(df.sparkSession)
    n_words, runs, collapsed = (fresh(df.columns, x) for x in names)
    schema = T.StructType([*df.schema.fields, T.StructField(n_words, T.LongType()), T.StructField(runs, T.ArrayType(RUN)),
                           T.StructField(collapsed, T.StringType())])
    arrow = to_arrow_schema(schema)
    at = df.columns.index(text_col)

    def work(batches):
        forget()
        for batch in batches:
            for part in text_slices(batch, batch.schema.names[at]):
                w = Words(*text_bytes(part.column(at)))
                found = text_runs(w, min_length, min_exponent)
                edge = np.zeros(len(w.start) + 1, np.int64)
                start = w.first[found[:, 0]] + found[:, 1]
                np.add.at(edge, start + found[:, 3], 1)
                np.add.at(edge, start + found[:, 2], -1)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(found[:, 0], np.arange(part.num_rows + 1)), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(found[:, k], pa.int64()) for k in (1, 2, 3)], names=["start", "length", "period"]))
                new = [pa.array(w.counts, pa.int64()), lists, _collapsed(w, np.cumsum(edge)[:-1] > 0)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*part.columns, *new], arrow)], names=arrow.names)

    return df.mapInArrow(work, schema)


# -- query -------------------------------------------------------------------

def _cycled(docs: DataFrame) -> DataFrame:
    """The contract's input: words from some place on repeat in some texts."""

    def work(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                w = Words(*text_bytes(part.column(1)))
                source = np.arange(len(w.start))
                for k, doc in enumerate(part.column(0).to_pylist()):
                    h, n = zlib.crc32(str(doc).encode()), int(w.counts[k])
                    if doc is None or h % 10 or not n:
                        continue
                    g = h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    at = w.first[k]
                    source[at + a: at + n] = at + a + np.arange(n - a) % p
                w.start, w.end = w.start[source], w.end[source]
                yield pa.RecordBatch.from_arrays([part.column(0), _collapsed(w, np.zeros(len(w.start), bool))], names=["doc_id", "text"])

    return docs.mapInArrow(work, docs.schema)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _cycled(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = collapse_runs(docs).select("doc_id", "n_words", "runs", "collapsed")
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    none = F.lit(None).cast(RUN)
    best = F.aggregate(  # by exact length / period; runs are in order, so the first of equals stays
        "runs", none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    return out.withColumn("best", best).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


#: Runs by islands of equal 16-word windows q words apart.
ORACLE = r"""
WITH tab AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS x(i)),
raw AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM documents, tab),
num AS (SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS cycled, h // 10 AS g FROM raw),
par AS (SELECT *, CASE WHEN cycled THEN g % n END AS a FROM num),
d AS (SELECT *, CASE WHEN cycled THEN 1 + (n - a) // (3 + g % 8) END AS p FROM par),
w AS (SELECT doc_id, n, CASE WHEN cycled THEN list_transform(range(n), lambda i: ws[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1]) ELSE ws END AS ws FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + 16], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(n - 15)) AS i FROM w WHERE n >= 24)),
pair AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM win x JOIN win y ON x.doc_id = y.doc_id AND x.k = y.k AND x.i < y.i),
isle AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM pair),
cand AS (SELECT doc_id, min(i) AS start, count(*) + 15 + q AS length, q AS period FROM isle GROUP BY doc_id, q, isle),
run AS (
  SELECT doc_id, start, length, min(period) AS period FROM cand
  WHERE length >= 24 AND length >= 3 * period GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) AS t
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(n)) AS i FROM w) x ANTI JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i GROUP BY x.doc_id),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS rank FROM run),
agg AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t FROM run GROUP BY doc_id)
SELECT w.doc_id, w.n::BIGINT AS n_words, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length,
  best.period::BIGINT AS period, (1000 * best.length // best.period)::BIGINT AS exponent_milli,
  sha256(coalesce(agg.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM w LEFT JOIN best ON best.doc_id = w.doc_id AND rank = 1 LEFT JOIN agg ON agg.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id
"""
