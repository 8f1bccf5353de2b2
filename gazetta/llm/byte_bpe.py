"""Byte-level BPE in DuckDB, one small database in memory per Python worker.

Encoding: rows (word, position, token) of the words that a partition holds join
the merge table; each round of one recursive query contracts each word's
leftmost pair of minimum rank, until no word has a pair in the table. Words of
more than ``LONG`` bytes contract all (non-overlapping) occurrences of that
pair in a round, which gives the same tokens in fewer rounds, and their rounds
change one table in place, so a word of any length takes memory by its length
(beyond the limit, DuckDB spills to the worker's temp folder). A word that is a
token itself is that token. Each distinct word of a partition is encoded once.
Decoding: token rows join the vocabulary, and an ordered aggregate strings the
bytes together.

The vocabulary file (base64 token and rank a line) is read on the driver and
sent to the executors; it has a fixed size, whatever the corpus.

Defined results: null or empty text has no tokens, and no tokens decode to
empty bytes; null ids in a token list are an error of the caller; ids outside
the vocabulary raise; other columns pass through; repeated rows are rows. Where
a column has an output's name, the output's name gets ``_`` appended until it is free.
"""

from __future__ import annotations

import base64
import hashlib
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.llm.pieces import TextIds, by_match
from gazetta.llm.util import fresh, ranges, read_table, ship, text_bytes, text_slices, worker_memory

LONG = 48
#: Words and tokens that one query of a worker's database handles.
BLOCK_BYTES, BLOCK_TOKENS = 250_000, 300_000

_LAST = """SELECT w, id FROM (SELECT step.*, last FROM step JOIN (SELECT w, max(round) AS last FROM step GROUP BY w) USING (w))
WHERE round = last ORDER BY w, pos"""
# Positions stay dense, so the next token of a word is the one at pos + 1.
ENCODE = f"""
WITH RECURSIVE step(w, pos, id, round) AS (
  SELECT w, pos, id, 0 FROM start
  UNION ALL
  (WITH least AS (SELECT a.w, min((m.rank::BIGINT << 32) | a.pos) AS best
                  FROM step AS a JOIN step AS b ON b.w = a.w AND b.pos = a.pos + 1
                  JOIN merges AS m ON m.a = a.id AND m.b = b.id GROUP BY a.w),
        pair AS (SELECT w, (best & 4294967295)::INTEGER AS spot, (best >> 32)::INTEGER AS merged FROM least)
   SELECT s.w, CASE WHEN s.pos > spot THEN s.pos - 1 ELSE s.pos END, CASE WHEN s.pos = spot THEN merged ELSE s.id END, round + 1
   FROM step AS s JOIN pair ON pair.w = s.w WHERE s.pos <> spot + 1)
)
{_LAST}
"""
# Long words, a round at a time in one table of their present tokens (``pos`` and
# ``nxt`` count over all words; ``rank``: that of the pair with the next token).
START_LONG = """CREATE OR REPLACE TABLE step AS SELECT s.w, s.pos, s.id, s.nxt, m.rank
FROM (SELECT w, pos, id, lead(pos) OVER (PARTITION BY w ORDER BY pos) AS nxt, lead(id) OVER (PARTITION BY w ORDER BY pos) AS after FROM start) AS s
LEFT JOIN merges AS m ON m.a = s.id AND m.b = s.after"""
#: Occurrences of each word's pair of minimum rank, and the token after each.
LEAST_LONG = """SELECT h.pos, h.nxt AS gone, n.nxt AS after, h.rank AS merged
FROM (SELECT s.* FROM step AS s JOIN (SELECT w, min(rank) AS rank FROM step GROUP BY w) AS best ON best.w = s.w AND best.rank = s.rank) AS h
JOIN step AS n ON n.pos = h.nxt ORDER BY h.pos"""
ROUND_LONG = (
    "UPDATE step SET id = k.merged, nxt = k.after FROM kept AS k WHERE step.pos = k.pos",
    "DELETE FROM step WHERE pos IN (SELECT gone FROM kept)",
    """UPDATE step SET rank = x.rank FROM (
    SELECT s.pos, m.rank FROM (SELECT * FROM step WHERE pos IN (SELECT pos FROM kept) OR nxt IN (SELECT pos FROM kept)) AS s
    LEFT JOIN step AS n ON n.pos = s.nxt LEFT JOIN merges AS m ON m.a = s.id AND m.b = n.id) AS x WHERE step.pos = x.pos""",
)
DECODE = "SELECT doc, string_agg(token, '' ORDER BY pos) AS text FROM tokens JOIN vocab ON vocab.id = tokens.id GROUP BY doc ORDER BY doc"


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class _Bpe:
    """A worker's database and its memory of words."""

    def __init__(self, data: bytes):
        import duckdb

        self.ranks = read_ranks(data)
        pairs = [(a, b, r) for t, r in self.ranks.items() for i in range(1, len(t))
                 if (a := self.ranks.get(t[:i])) is not None and (b := self.ranks.get(t[i:])) is not None]
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.con = duckdb.connect(":memory:", config={
            "threads": 1, "memory_limit": "150MB", "temp_directory": os.path.join(tempfile.gettempdir(), f"gazetta-duckdb-{uuid.uuid4().hex}")})
        a, b, r = (pa.array(x, pa.int32()) for x in zip(*pairs)) if pairs else (pa.array([], pa.int32()),) * 3
        self._table("merges", {"a": a, "b": b, "rank": r})
        # Bytes as Latin-1 characters: text functions then work byte by byte.
        self._table("vocab", {"id": pa.array(list(self.ranks.values()), pa.int32()),
                              "token": pa.array([t.decode("latin-1") for t in self.ranks], pa.string())})
        self.known = np.zeros(max(self.ranks.values()) + 1, bool)
        self.known[list(self.ranks.values())] = True
        self.texts = TextIds(by_match(self._matches))

    def _table(self, name: str, columns: dict):
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _contract(self, words: list[bytes], long: bool) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(w) for w in words])
        first = np.cumsum(size) - size
        raw = np.frombuffer(b"".join(words), np.uint8)
        self.con.register("start", pa.table({"w": pa.array(np.repeat(np.arange(len(words)), size), pa.int32()),
                              "pos": pa.array(np.arange(len(raw)) - (0 if long else np.repeat(first, size)), pa.int32()),
                              "id": pa.array(self.byte[raw], pa.int32())}))
        out = self._rounds() if long else self.con.sql(ENCODE).fetchnumpy()
        return out["id"].astype(np.int32), np.bincount(out["w"], minlength=len(words))

    def _rounds(self) -> dict:
        """Contracts the long words in ``start``; only the latest round is held."""
        self.con.execute(START_LONG)
        while True:
            hits = self.con.sql(LEAST_LONG).to_arrow_table()
            if not hits.num_rows:
                break
            # A run of overlapping occurrences (aaaa) contracts at its 1st, 3rd, ... place.
            pos, gone, at = np.asarray(hits["pos"]), np.asarray(hits["gone"]), np.arange(hits.num_rows)
            head = np.concatenate([[True], pos[1:] != gone[:-1]])
            self.con.register("kept", hits.filter(pa.array((at - np.maximum.accumulate(np.where(head, at, 0))) % 2 == 0)))
            self.con.begin()
            for sql in ROUND_LONG:
                self.con.execute(sql)
            self.con.commit()
        out = self.con.execute("SELECT w, id FROM step ORDER BY pos").fetchnumpy()
        self.con.execute("DROP TABLE step")
        return out

    def _matches(self, matches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = [m.encode() for m in matches]
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int32)
        order = [np.flatnonzero(whole >= 0)]
        parts, sizes = [whole[order[0]]], [np.ones(len(order[0]), np.int64)]
        length = np.array([len(w) for w in words])
        for long, some in ((False, length <= LONG), (True, length > LONG)):
            at = np.flatnonzero(some & (whole < 0))
            block = np.cumsum(length[at]) // BLOCK_BYTES
            for i in np.unique(block):
                here = at[block == i]
                ids, size = self._contract([words[j] for j in here.tolist()], long)
                order.append(here)
                parts.append(ids)
                sizes.append(size)
        order, ids, size = np.concatenate(order), np.concatenate(parts), np.concatenate(sizes)
        start = np.cumsum(size) - size
        back = np.argsort(order)
        return ids[ranges(start[back], size[back])], size[back]

    def decode(self, ids: np.ndarray, size: np.ndarray) -> list[bytes]:
        """The bytes of each text's tokens, ``BLOCK_TOKENS`` or one text at a time."""
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.known) and self.known[ids].all()):
            raise ValueError("token id outside the vocabulary")
        ends, out, lo = np.cumsum(size), [b""] * len(size), 0
        while lo < len(size):
            base = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + BLOCK_TOKENS, side="right")))
            n = int(ends[hi - 1]) - base
            self.con.register("tokens", pa.table({"doc": pa.array(np.repeat(np.arange(lo, hi), size[lo:hi]), pa.int32()),
                                                  "pos": pa.array(np.arange(n), pa.int32()), "id": pa.array(ids[base: base + n], pa.int32())}))
            for d, t in self.con.sql(DECODE).fetchall():
                out[d] = t.encode("latin-1")
            lo = hi
        return out


def _bpe(data) -> _Bpe:
    memory = worker_memory(("byte_bpe", hashlib.sha1(data).digest()))
    if not hasattr(memory, "bpe"):
        memory.bpe = _Bpe(data)
    return memory.bpe


def _vocabulary(spark: SparkSession, path: str):
    ship(spark)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, text_col: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with ``text_col`` replaced by its token ids, column ``out``
    (array<int>); with ``decoded``, also a binary column of the bytes that these
    ids decode to (in the same worker, which then holds one database)."""
    data = _vocabulary(df.sparkSession, path)
    others = [c for c in df.columns if c != text_col]
    out = fresh(others, out)
    decoded = fresh([*others, out], decoded) if decoded else None
    schema = T.StructType([df.schema[c] for c in others] + [T.StructField(out, T.ArrayType(T.IntegerType()))]
                          + ([T.StructField(decoded, T.BinaryType())] if decoded else []))

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text_col):
                bpe = _bpe(data.value)
                ids, size = bpe.texts.of(*text_bytes(part.column(len(others))))
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                columns = [*(part.column(i) for i in range(len(others))), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))]
                if decoded:
                    columns.append(pa.array(bpe.decode(ids, size), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return df.select(*others, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with a binary column ``out``: the bytes of the tokens in ``ids_col``."""
    data = _vocabulary(df.sparkSession, path)
    out = fresh(df.columns, out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])
    at = df.columns.index(ids_col)

    def run(batches):
        for batch in batches:
            size = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(batch.column(at)), 0)).astype(np.int64)
            texts = _bpe(data.value).decode(np.asarray(batch.column(at).flatten()), size)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def production_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _sha_of_ids(c: str) -> Column:
    return F.sha2(F.array_join(F.col(c).cast("array<string>"), ",").cast("binary"), 256)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = production_path()
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode(docs, path, decoded="decoded")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), _sha_of_ids("ids").alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: each document's id, token ids and their number.
    A document whose tokens do not decode to its text raises."""
    path = production_path()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha"))
    out = encode(rows, path, decoded="decoded")
    same = F.when(F.sha2("decoded", 256) == F.col("sha"), F.size("ids").cast("long")).otherwise(
        F.raise_error(F.lit("tokens do not decode to the text")).cast("long"))
    return out.select("doc_id", same.alias("n_tokens"), "ids")
