"""Token ids of a corpus as Parquet files, and reading them back.

Rows are range-partitioned by ``order_col`` and sorted, so file after file they
are in ascending order. A row holds ``part`` (its file's number), ``start``
(ids before it in its file), ``n_tokens`` and ``ids`` (a list of ints, with
the end id). Ids are dictionary-encoded (a dictionary a row group, bit-packed
references) or delta-encoded; row groups and pages have set sizes, and Spark's
Parquet writer adds column and offset indexes, so that a reader of some rows or
of the metadata columns skips the other pages.

Ids are the library's with its defaults: a string of an added token in a text
(``<|endoftext|>``) becomes that token.

Defined results: null or empty text has the end id alone; rows of equal order
value follow each other by text; null order values come first; an empty table
gives no files and reads back as no rows; other columns are kept in the files,
and one that has a name of the format (``part``, ``start``, ``n_tokens``,
``ids``) gets ``_`` appended to its own until that is free.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.llm.pieces import _Pool, cuts, per_group
from gazetta.llm.util import fresh, hash_ranges, ranges, read_table, scratch_path, ship, text_bytes, text_slices, worker_memory

END_ID = 2
#: Distinct cuts whose ids a worker keeps.
MOST_CUTS = 1_500_000
#: Files of an index that is broadcast (one row of two numbers each).
BROADCAST_FILES = 1_000_000
LAYOUT = {
    "dictionary": {"parquet.enable.dictionary": "true"},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"},
}


class _Cuts:
    """Ids of texts without added tokens. The ids of every cut seen so far are
    kept in the worker, found by its hash in a sorted array (some 60 bytes a cut,
    and all are forgotten beyond ``MOST_CUTS``)."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.forget()

    def forget(self):
        self.keys, self.codes, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), _Pool()

    def of(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, ids per text)."""
        start, per_text = cuts(raw, offsets)
        size = np.diff(np.append(start, len(raw)))
        keys, first, where = np.unique(hash_ranges(raw, start, size), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > MOST_CUTS:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        new = np.flatnonzero(~known)
        if len(new):
            data, lo, n = raw.tobytes(), start[first[new]], size[first[new]]
            ids, sizes = self.encode([data[a:b].decode() for a, b in zip(lo.tolist(), (lo + n).tolist())])
            codes = self.pool.n + np.arange(len(new))
            self.pool.add(ids, sizes)
            self.keys, self.codes = np.insert(self.keys, at[new], keys[new]), np.insert(self.codes, at[new], codes)
        ids, sizes = self.pool.get(self.codes[np.searchsorted(self.keys, keys)][where])
        return ids, per_group(sizes, per_text)


class _Texts:
    """Ids of texts as the library gives them: added tokens are found first, what
    lies between them is encoded alone."""

    def __init__(self, plain: _Cuts, tokenizer):
        self.plain, self.tokenizer = plain, tokenizer
        added = tokenizer.get_added_tokens_decoder()
        self.ids = {t.content.encode(): i for i, t in added.items()}
        # An added token that takes white space or looks at its neighbours is left to the library.
        self.simple = not any(t.lstrip or t.rstrip or t.single_word for t in added.values())
        longest_first = sorted(self.ids, key=lambda c: (-len(c), c))
        self.find = re.compile(b"|".join(map(re.escape, longest_first))) if self.ids else None

    def of(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = raw.tobytes()
        if self.find is None or not self.find.search(data):
            return self.plain.of(raw, offsets)
        hits = [(m.start(), m.end(), self.ids[m.group()]) for a, b in zip(offsets.tolist(), offsets[1:].tolist()) for m in self.find.finditer(data, a, b)]
        if not self.simple:
            texts = [data[a:b].decode() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            found = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.int32), *found]), np.array([len(x) for x in found], np.int64)
        if not hits:
            return self.plain.of(raw, offsets)
        lo, hi, token = (np.array(x, np.int64) for x in zip(*hits))
        # The text between hits, as texts of their own; a hit adds its one id behind the segment before it.
        keep = np.ones(len(raw), bool)
        keep[ranges(lo, hi - lo)] = False
        gone = np.concatenate([[0], np.cumsum(~keep)])
        owner = np.searchsorted(offsets, lo, side="right") - 1
        bounds = np.sort(np.concatenate([offsets - gone[offsets], lo - gone[lo]]), kind="stable")
        # Order of bounds at one place: a text's start stands before its hits, hits before the next text's start.
        kind = np.concatenate([np.zeros(len(offsets), np.int64), np.ones(len(lo), np.int64)])
        place = np.concatenate([np.arange(len(offsets)) * 2, owner * 2 + 1])
        order = np.lexsort((np.concatenate([offsets, lo]), place))
        is_hit = kind[order] == 1
        ids, size = self.plain.of(raw[keep], bounds)
        ends = np.cumsum(size)
        # Segment k ends at bound k + 1; if that is a hit, its id comes there.
        behind = is_hit[1:]
        ids = np.insert(ids, ends[behind], token)
        per_text = np.add.reduceat(np.append(size + behind, 0), np.flatnonzero(~is_hit))[:-1]
        return ids, per_text


def _tokenizer(data: bytes) -> _Texts:
    memory = worker_memory(("token_files", hashlib.sha1(data).digest()))
    if not hasattr(memory, "texts"):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(data.decode())
        # Cuts of texts without added tokens, many in a string, never make one.
        tokenizer.encode_special_tokens = True

        # Ids whose token starts with a space.
        spaced = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), bool)
        spaced[[i for t, i in tokenizer.get_vocab(with_added_tokens=False).items() if t.startswith("Ġ")]] = True

        def encode(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """Cuts with a space at their start and nowhere else are encoded
            many in a string: the ids that start with a space part them again."""
            alone = [c[0] != " " or c.find(" ", 1) > 0 for c in new]
            plain, rest = [i for i, x in enumerate(alone) if not x], [i for i, x in enumerate(alone) if x]
            groups = [plain[a: a + 500] for a in range(0, len(plain), 500)] + [[i] for i in rest]
            found = tokenizer.encode_batch_fast(["".join([new[i] for i in g]) for g in groups], add_special_tokens=False)
            order = np.array(plain + rest, np.int64)
            parts = [np.array(e.ids, np.int32) for e in found]
            size = []
            for g, ids in zip(groups, parts):
                first = np.flatnonzero(spaced[ids]) if len(g) > 1 else np.zeros(1, int)
                if len(first) != len(g):
                    raise ValueError("a cut does not start with a token of its own")
                size.append(np.diff(np.concatenate([first, [len(ids)]])))
            ids, size = np.concatenate(parts), np.concatenate(size)
            start = np.cumsum(size) - size
            back = np.argsort(order)
            return ids[ranges(start[back], size[back])], size[back]

        memory.texts = _Texts(_Cuts(encode), Tokenizer.from_str(data.decode()))
    return memory.texts


#: Columns of the files besides the table's own.
FORMAT = ("part", "start", "n_tokens", "ids")


def write_tokens(
    df: DataFrame, path: str, tokenizer_path: str, text_col: str = "text", order_col: str = "doc_id", end_id: int = END_ID,
    encoding: str = "dictionary", row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10,
) -> None:
    """Encode ``text_col`` and write the files to ``path``."""
    spark = df.sparkSession
    ship(spark)
    with open(tokenizer_path, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())  # a vocabulary: its size does not depend on the corpus
    for c in df.columns:
        if c != text_col and c.lower() in FORMAT:
            own = fresh([*df.columns, *FORMAT], c)
            df, order_col = df.withColumnRenamed(c, own), own if c == order_col else order_col
    others = [c for c in df.columns if c != text_col]
    schema = T.StructType([df.schema[c] for c in others] + [
        T.StructField("part", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        part_id, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in text_slices(batch, text_col):
                ids, size = _tokenizer(data.value).of(*text_bytes(part.column(len(others))))
                ends = np.cumsum(size)
                ids = np.insert(ids, ends, end_id)  # one end id after each text's ids
                size = size + 1
                offsets = np.concatenate([[0], np.cumsum(size)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(others))]
                    + [pa.array(np.full(part.num_rows, part_id), pa.int32()), pa.array(before + offsets[:-1], pa.int64()),
                       pa.array(size, pa.int64()),
                       pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))],
                    names=[f.name for f in schema.fields])
                before += int(offsets[-1])

    ordered = (df.select(*others, text_col).repartitionByRange(F.col(order_col).asc_nulls_first())
               .sortWithinPartitions(F.col(order_col).asc_nulls_first(), text_col))
    (ordered.mapInArrow(run, schema).write.option("compression", "zstd")
     .option("parquet.block.size", str(row_group_bytes)).option("parquet.page.size", str(page_bytes))
     .options(**LAYOUT[encoding]).parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files, ``start`` counted over all of them. Columns not
    selected and pages not wanted are not read."""
    rows = spark.read.parquet(path)
    files = rows.groupBy("part").agg(F.max(F.col("start") + F.col("n_tokens")).alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part, shift = fresh(rows.columns, "__part"), fresh(rows.columns, "__before")
    index = files.select(F.col("part").alias(part), before.alias(shift))  # a row a file
    if files.count() <= BROADCAST_FILES:
        index = F.broadcast(index)
    return rows.join(index, rows.part == F.col(part)).withColumn("start", F.col("start") + F.col(shift)).drop("part", part, shift)


def with_crc32(df: DataFrame, ids_col: str = "ids", out: str = "ids_crc32") -> DataFrame:
    """``ids_col`` replaced by the crc32 of its ids as little-endian unsigned 32-bit integers."""
    others = [c for c in df.columns if c != ids_col]
    out = fresh(others, out)
    schema = T.StructType([df.schema[c] for c in others] + [T.StructField(out, T.LongType())])

    def run(batches):
        for batch in batches:
            col = batch.column(len(others))
            flat = np.asarray(col.flatten()).astype("<u4")
            ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.list_value_length(col), 0)))
            crc = [zlib.crc32(flat[a:b].data) for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(others))), pa.array(crc, pa.int64())], names=[*others, out])

    return df.select(*others, ids_col).mapInArrow(run, schema)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return with_crc32(read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids"))
