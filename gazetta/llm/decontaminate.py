"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
   The n-grams of the test items are counted over all documents (documents that
   hold each), map-side first.
2. An item's seeds are its rarer n-grams: those up to the ``seed_share``
   quantile of its own counts. Rarity is relative to the item, so an item that
   leaked into a third of all documents still has seeds.
3. Where a document holds a seed, the item is aligned with the words around it
   (match 2, mismatch -1, gap -1, local). ``score`` is the alignment's share of
   a perfect one; a pair is a match from ``threshold`` on.

Test items are a stated query set: they are taken in blocks of bounded size,
each sent to all tasks, and every document is compared with every block.

Defined results: null or empty texts and items match nothing; items shorter
than an n-gram use their whole word sequence as seed; repeated documents, and
equal items under other ids, each give their own matches; null ids are carried
along; empty tables give an empty result; other columns pass through ``flag``;
where one has the name of its output, the output's name gets ``_`` appended
until it is free.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gazetta.llm.util import Words, forget, fresh, lower_ascii, mix, ranges, read_table, ship, text_bytes, text_slices, window_hashes

NGRAM = 3
SEED_SHARE = 0.75
THRESHOLD = 0.5
#: UTF-8 bytes of test items that are sent to the tasks at once.
BLOCK_BYTES = 8 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
_CELLS = 1 << 18

_AS_WORD = np.full(256, 32, np.uint8)
_AS_WORD[0x80:] = np.arange(0x80, 256)
for _a, _b in ((48, 58), (97, 123)):
    _AS_WORD[_a:_b] = np.arange(_a, _b)


def _words(col: pa.Array) -> tuple[Words, np.ndarray]:
    raw, offsets = text_bytes(col)
    w = Words(_AS_WORD[lower_ascii(raw)], offsets)
    return w, w.hashes()


class _Items:
    """A block of test items: word hashes, and n-grams sorted by hash."""

    def __init__(self, texts: pa.Array, n: int):
        w, self.words = _words(texts)
        self.first, self.size = w.first[:-1], w.counts
        grams, item, place = [], [], []
        whole = window_hashes(self.words, n)
        for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:])):
            if b - a >= n:
                grams.append(whole[a: b - n + 1])
            elif b > a:
                grams.append(short_gram(self.words[a:b]))
            else:
                continue
            item.append(np.full(len(grams[-1]), i))
            place.append(np.arange(len(grams[-1])))
        join = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        self.gram, self.item, self.place = join(grams, np.uint64), join(item, np.int64), join(place, np.int64)
        #: Lengths of items shorter than an n-gram.
        self.short = sorted({int(s) for s in self.size if 0 < s < n})
        self._sort()

    def _sort(self):
        order = np.argsort(self.gram, kind="stable")
        self.gram, self.item, self.place = self.gram[order], self.item[order], self.place[order]
        self.keys = np.unique(self.gram)

    def keep_rare(self, count: dict[int, int], share: float):
        """Keeps of each item the n-grams up to the quantile ``share`` of its counts."""
        n = np.array([count.get(int(g), 0) for g in self.gram.view(np.int64)], np.int64)
        keep = np.zeros(len(n), bool)
        for i in np.unique(self.item):
            at = np.flatnonzero(self.item == i)
            keep[at] = n[at] <= np.quantile(n[at], share, method="lower")
        self.gram, self.item, self.place = self.gram[keep], self.item[keep], self.place[keep]
        self._sort()


def short_gram(h: np.ndarray) -> np.ndarray:
    return mix(window_hashes(h, len(h)) + np.uint64(len(h)))


def _hits(w: Words, h: np.ndarray, items: _Items, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(word positions, index into items.keys) of n-grams that items hold."""
    pos, key = [], []
    for size in [n, *items.short]:
        grams = window_hashes(h, size)
        if size != n:
            grams = mix(grams + np.uint64(size))
        inside = np.flatnonzero(w.left()[: len(grams)] >= size)
        grams = grams[inside]
        if not len(grams) or not len(items.keys):
            continue
        at = np.minimum(np.searchsorted(items.keys, grams), len(items.keys) - 1)
        hit = items.keys[at] == grams
        pos.append(inside[hit])
        key.append(at[hit])
    if not pos:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(pos), np.concatenate(key)


def align(item_words: np.ndarray, item_size: np.ndarray, doc_words: np.ndarray, doc_size: np.ndarray) -> tuple:
    """Best local alignment of each (padded) row of words with its row of
    document words: (score, first, end) in document words.

    One pass a row of the table, for all pairs at once. Cells hold the score and,
    in their low bits, where the alignment began; gaps along a row are a running
    maximum."""
    pairs, width = doc_words.shape
    shift = np.int64(1) << 24
    j = np.arange(width, dtype=np.int64)
    slope = -GAP * j * shift
    inside = j[None, :] < doc_size[:, None]
    above = np.tile(j, (pairs, 1))  # score 0, beginning here
    fresh_cell = above.copy()
    best = np.zeros(pairs, np.int64)
    best_end = np.zeros(pairs, np.int64)
    for i in range(item_words.shape[1]):
        same = (doc_words == item_words[:, i: i + 1]) & inside
        diag = np.empty_like(above)
        diag[:, 0] = 0
        diag[:, 1:] = above[:, :-1]
        # A cell's alignment from its left upper neighbour; an empty one begins here.
        diag = np.where(diag < shift, fresh_cell, diag)
        cell = np.maximum(diag + np.where(same, MATCH, MISMATCH) * shift, above + GAP * shift)
        cell = np.maximum.accumulate(np.where(cell >= shift, cell, fresh_cell) + slope, axis=1) - slope
        cell = np.where(cell >= shift, cell, fresh_cell)
        cell = np.where(inside & (i < item_size)[:, None], cell, fresh_cell)
        top = cell.argmax(axis=1)
        value = cell[np.arange(pairs), top]
        better = (value // shift) > (best // shift)
        best, best_end = np.where(better, value, best), np.where(better, top + 1, best_end)
        above = np.where((i < item_size)[:, None], cell, above)
    return best // shift, best % shift, best_end


def _matches(w: Words, h: np.ndarray, items: _Items, n: int, threshold: float) -> dict[str, np.ndarray]:
    pos, key = _hits(w, h, items, n)
    lo = np.searchsorted(items.gram, items.keys[key], side="left") if len(key) else key
    hi = np.searchsorted(items.gram, items.keys[key], side="right") if len(key) else key
    seed = ranges(lo, hi - lo)
    pos = np.repeat(pos, hi - lo)
    item, doc = items.item[seed], w.doc[pos]
    size = items.size[item]
    slack = np.maximum(6, size // 3)
    begin = pos - items.place[seed]  # where the item would begin
    _, one = np.unique(np.stack([doc, item, begin // slack]), axis=1, return_index=True)
    doc, item, begin, size, slack = doc[one], item[one], begin[one], size[one], slack[one]
    first, last = w.first[doc], w.first[doc + 1]
    a, b = np.maximum(first, begin - slack), np.minimum(last, begin + size + 2 * slack)
    order = np.argsort(size, kind="stable")
    found = []
    while len(order):
        many = max(1, _CELLS // int(size[order[0]] * 3 + 40))
        rows, order = order[:many], order[many:]
        deep, wide = int(size[rows].max()), int((b - a)[rows].max())
        x = np.zeros((len(rows), deep), np.uint64)
        y = np.zeros((len(rows), wide), np.uint64)
        x[np.arange(deep)[None, :] < size[rows][:, None]] = items.words[ranges(items.first[item[rows]], size[rows])]
        y[np.arange(wide)[None, :] < (b - a)[rows][:, None]] = h[ranges(a[rows], (b - a)[rows])]
        score, start, end = align(x, size[rows], y, (b - a)[rows])
        share = score / (MATCH * size[rows])
        good = share >= threshold
        r = rows[good]
        found.append(np.stack([doc[r], item[r], (a[r] - first[r]) + start[good], (a[r] - first[r]) + end[good], share[good]]))
    all_found = np.concatenate(found, axis=1) if found else np.zeros((5, 0))
    # The best alignment of each (document, item).
    order = np.lexsort((all_found[2], -all_found[4], all_found[1], all_found[0]))
    all_found = all_found[:, order]
    head = np.ones(all_found.shape[1], bool)
    head[1:] = (all_found[0, 1:] != all_found[0, :-1]) | (all_found[1, 1:] != all_found[1, :-1])
    names = ("doc", "item", "start", "end", "score")
    return {k: v if k == "score" else v.astype(np.int64) for k, v in zip(names, all_found[:, head])}


def _counts(docs: DataFrame, text_col: str, items, n: int) -> dict[int, int]:
    """Documents that hold each n-gram of a block of items (bounded by the block)."""

    def run(batches):
        forget()
        total = np.zeros(len(items.value.keys), np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                w, h = _words(part.column(0))
                pos, key = _hits(w, h, items.value, n)
                held = np.unique(w.doc[pos] * np.int64(len(total) + 1) + key)
                total += np.bincount(held % (len(total) + 1), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(items.value.keys[some].view(np.int64), pa.int64()), pa.array(total[some], pa.int64())], names=["gram", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r.gram: r.n for r in rows.toLocalIterator()}


def flag(
    docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    out: str = "matches", keep_text: bool = True, ngram: int = NGRAM, seed_share: float = SEED_SHARE, threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` plus ``out``: its matches, array of (item, score, start, end);
    start and end in words of the document."""
    spark = docs.sparkSession
    ship(spark)
    out = fresh(docs.columns, out)
    items = bench.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    items = items.withColumn("block", F.pmod(F.xxhash64("text", "item"), F.lit(blocks)))
    item_type = bench.schema[item_col].dataType
    one = T.StructType([T.StructField("item", item_type), T.StructField("score", T.DoubleType()),
                        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    prepared = []
    for i in range(blocks):
        table = items.where(F.col("block") == i).drop("block").toArrow()
        block = _Items(table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string()), ngram)
        counts = _counts(docs, text_col, spark.sparkContext.broadcast(block), ngram)
        block.keep_rare(counts, seed_share)
        prepared.append((spark.sparkContext.broadcast(block), table["item"].combine_chunks() if table.num_rows else table["item"]))

    def with_block(df: DataFrame, block, names) -> DataFrame:
        first = out not in df.columns
        schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(one))]) if first else df.schema
        arrow = to_arrow_schema(schema)
        kind = arrow.field(out).type.value_type

        def run(batches):
            for batch in batches:
                for part in text_slices(batch, text_col):
                    w, h = _words(part.column(part.schema.get_field_index(text_col)))
                    m = _matches(w, h, block.value, ngram, threshold)
                    cells = pa.StructArray.from_arrays(
                        [names.take(pa.array(m["item"])).cast(kind.field(0).type) if len(m["item"]) else pa.array([], kind.field(0).type),
                         pa.array(m["score"], pa.float64()), pa.array(m["start"], pa.int64()), pa.array(m["end"], pa.int64())],
                        fields=[kind.field(i) for i in range(4)])
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(m["doc"], np.arange(part.num_rows + 1)), pa.int32()), cells, type=arrow.field(out).type)
                    if not first:
                        old = part.column(part.schema.get_field_index(out)).to_pylist()
                        lists = pa.array([a + b for a, b in zip(old, lists.to_pylist())], arrow.field(out).type)
                    yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(f.name)) if f.name != out else lists for f in arrow)], names=arrow.names)

        return df.mapInArrow(run, schema)

    df = docs
    for block, names in prepared:
        names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
        df = with_block(df, block, names)
    return df if keep_text else df.drop(text_col)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each (document, benchmark item) match with its score and place in words."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = flag(docs, read_table(spark, sf_dir, "benchmark"), keep_text=False)
    return out.select("doc_id", F.explode("matches").alias("m")).select(
        "doc_id", F.col("m.item").alias("item_id"), "m.score", F.col("m.start").alias("start_word"), F.col("m.end").alias("end_word"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that match no benchmark item."""
    out = fresh(docs.columns, "__matches")
    return flag(docs, read_table(spark, sf_dir, "benchmark"), out=out).where(F.size(out) == 0).select(*docs.columns)
