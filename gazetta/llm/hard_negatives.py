"""Hard negatives by angular triangle filtering.

Vectors become integers (``floor(scale * x)``), a score is an integer inner
product. Each row stores its norm and its angles to some reference directions.
For an anchor at angle a and a row at angle b to a reference, the angle between
them lies in [|a - b|, min(a + b, 2 pi - a - b)] (triangle inequality on the
sphere); the tightest cosine interval of all references, times both norms and
widened by more than any rounding, bounds the score. Rows are scored only where
that interval overlaps the window of scores that still count:

* positives (same label): from the anchor's fifth best score so far upwards;
* negatives (other labels): between ``low`` and ``high`` percent of a positive's
  score, and from the tenth best so far in that window upwards.

Rows lie in blocks, ordered by (label, nearest reference, angle to it), so that
a group of rows has narrow angle ranges and is first tried as a whole.

Anchors are taken ``ANCHORS`` at a time; each portion (its size does not grow
with the input) is sent to the tasks, which read all blocks of rows. Partial
lists (at most ``positives`` or ``negatives`` rows a task and window) are merged
by Spark. The references are fitted on a bounded sample (``SAMPLE`` rows); they
only decide how many rows are tried, never a result.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; vectors of different lengths are never
compared; a zero vector scores 0 with all; rows of equal score follow each
other by id; rows that carry the anchor's own id are never its positives or
negatives, other repeated ids are rows of their own (an anchor's repeated rows
are anchors each, with a list each); an empty table gives no rows. Columns other than the three named are ignored, whatever
their names. Norms beyond 2**23 (after scaling) are refused with an error, so
that scores stay exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazetta.llm.chunks import pack, unpack
from gazetta.llm.util import forget, materialise, read_table, scratch_path, ship

#: Anchors sent to the tasks at a time (some 600 bytes each at 64 dimensions).
ANCHORS = 16_384
#: Rows that the reference directions are fitted on, and how many directions.
SAMPLE, REFERENCES = 4_096, 16
#: Rows of a block, of a group tried as a whole, and anchors worked on at a time.
BLOCK, GROUP, TILE = 4_096, 256, 512
#: Angles are stored as 32-bit floats; a cosine bound is widened by far more than
#: their rounding and that of its computation.
SLACK = 1e-5
MOST_NORM = 2.0 ** 23
NONE = np.iinfo(np.int64).min
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
FLAT = "label long, cell int, near float, id long, norm double, angles array<float>, q array<long>"


# -- angles ------------------------------------------------------------------

def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x, dtype=np.float64), where=norm > 0)


def fit_references(x: np.ndarray, k: int = REFERENCES, rounds: int = 8) -> np.ndarray:
    """At most ``k`` unit directions for the rows of ``x``: farthest points first,
    then means of the nearest rows."""
    x = _unit(x)
    x = x[np.abs(x).sum(axis=1) > 0]
    if not len(x):
        return np.zeros((0, x.shape[1]))
    chosen, best = [0], x @ x[0]
    while len(chosen) < min(k, len(x)) and best.min() < 1 - 1e-9:
        chosen.append(int(best.argmin()))
        best = np.maximum(best, x @ x[chosen[-1]])
    out = x[chosen]
    for _ in range(rounds):
        of = (x @ out.T).argmax(axis=1)
        mean = np.zeros_like(out)
        np.add.at(mean, of, x)
        mean = _unit(mean)
        out = np.where(np.abs(mean).sum(axis=1, keepdims=True) > 0, mean, out)
    return out


def angles_to(q: np.ndarray, norm: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles in [0, pi]; a zero vector has a right angle to everything."""
    cosine = (q @ references.T) / np.where(norm > 0, norm, 1)[:, None]
    return np.arccos(np.clip(cosine, -1, 1)).astype(np.float32)


def row_bounds(a: np.ndarray, a_norm: np.ndarray, b: np.ndarray, b_norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) score of every anchor (rows) with every row (columns)."""
    ca, sa, cb, sb = np.cos(a, dtype=np.float64), np.sin(a, dtype=np.float64), np.cos(b, dtype=np.float64), np.sin(b, dtype=np.float64)
    low, high = np.full((len(a), len(b)), -1.0), np.full((len(a), len(b)), 1.0)
    for r in range(a.shape[1]):  # cos(x -+ y) = cos x cos y +- sin x sin y
        both, cross = np.multiply.outer(ca[:, r], cb[:, r]), np.multiply.outer(sa[:, r], sb[:, r])
        np.minimum(high, both + cross, out=high)
        np.maximum(low, both - cross, out=low)
    norms = np.multiply.outer(a_norm, b_norm)
    return (low - SLACK) * norms, (high + SLACK) * norms


def group_bounds(a: np.ndarray, a_norm: np.ndarray, least: np.ndarray, most: np.ndarray,
                 min_norm: np.ndarray, max_norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for groups of rows, given the ranges of their angles and norms."""
    low, high = np.full((len(a), len(least)), -1.0), np.full((len(a), len(least)), 1.0)
    a = a.astype(np.float64)
    for r in range(a.shape[1]):
        x, b, c = a[:, r][:, None], least[:, r].astype(np.float64)[None, :], most[:, r].astype(np.float64)[None, :]
        near = np.maximum(0, np.maximum(x - c, b - x))
        far = np.where(x + c <= np.pi, x + c, np.where(x + b >= np.pi, 2 * np.pi - x - b, np.pi))
        np.minimum(high, np.cos(near), out=high)
        np.maximum(low, np.cos(far), out=low)
    low, high = low - SLACK, high + SLACK
    big, small = a_norm[:, None] * max_norm[None, :], a_norm[:, None] * min_norm[None, :]
    return np.where(low < 0, low * big, low * small), np.where(high > 0, high * big, high * small)


# -- rows --------------------------------------------------------------------

def quantised(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """(id, label, q, norm) of the rows that take part."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    fit = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(
        F.col(vector_col), lambda v: F.coalesce((v == v) & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")), F.lit(False)))
    # Beyond 2**53 a component is refused below, by its norm; the cast must not fail on rows that take no part.
    safe = F.transform(x, lambda v: F.when(F.abs(v) * F.lit(float(scale)) < F.lit(2.0 ** 53), F.floor(v * F.lit(float(scale)))).otherwise(F.lit(2 ** 53)))
    return (df.where(fit).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), safe.alias("q"))
            .withColumn("norm", F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))))


def _matrix(col: pa.Array, dtype) -> np.ndarray:
    """A list column of one length as a matrix."""
    flat = np.asarray(col.flatten()).astype(dtype)
    return flat.reshape(len(col), -1) if len(flat) else np.zeros((len(col), 0), dtype)


def _by_length(table: pa.Table):
    """(length, row numbers) of the vectors of a table."""
    size = np.asarray(pa.compute.list_value_length(table["q"]))
    return [(int(n), np.flatnonzero(size == n)) for n in np.unique(size)]


def angular_blocks(rows: DataFrame, references: dict[int, np.ndarray], name: str) -> DataFrame:
    """Rows with their angles, ordered and packed: (block, data), written once."""

    def measure(batches):
        forget()
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if table.num_rows and (np.asarray(table["norm"]) > MOST_NORM).any():
                raise ValueError(f"a vector's norm after scaling is beyond {MOST_NORM:.0f}: scores would not be exact")
            for n, at in _by_length(table):
                part = table.take(pa.array(at)).combine_chunks()
                q, norm = _matrix(part["q"].chunk(0), np.float64), np.asarray(part["norm"])
                ref = references.get(n, np.zeros((0, n)))
                angles = angles_to(q, norm, ref)
                cell = angles.argmin(axis=1) if len(ref) else np.zeros(len(at), int)
                near = angles[np.arange(len(at)), cell] if len(ref) else np.zeros(len(at), np.float32)
                yield pa.RecordBatch.from_arrays(
                    [part["label"].chunk(0), pa.array(cell, pa.int32()), pa.array(near, pa.float32()), part["id"].chunk(0), part["norm"].chunk(0),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * angles.shape[1], pa.int32()), pa.array(angles.reshape(-1))),
                     part["q"].chunk(0)], names=["label", "cell", "near", "id", "norm", "angles", "q"])

    def block(batches):
        n = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                whole = part.take(pa.array(np.arange(part.num_rows)))
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([pack(whole)], pa.binary())], names=["block", "data"])
                n += 1

    # By length and label first: a task's rows have few labels. The id splits any number of equal vectors.
    keys = [F.size("q"), "label", "cell", "near", "id"]
    flat = rows.select("label", "id", "q", "norm").mapInArrow(measure, FLAT)
    return materialise(flat.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(block, "block long, data binary"), name)


class _Rows:
    """A block's vectors of one length, as arrays, with its groups."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.id, self.label, self.norm = (np.asarray(table[c]) for c in ("id", "label", "norm"))
        self.q = _matrix(table["q"].chunk(0), np.float64)
        self.angles = _matrix(table["angles"].chunk(0), np.float32)
        self.first = np.arange(0, len(self.id), GROUP)
        self.least, self.most = np.minimum.reduceat(self.angles, self.first), np.maximum.reduceat(self.angles, self.first)
        self.min_norm, self.max_norm = np.minimum.reduceat(self.norm, self.first), np.maximum.reduceat(self.norm, self.first)


def _blocks(batches):
    for batch in batches:
        for data in batch.column(batch.schema.get_field_index("data")):
            table = unpack(data.as_buffer())
            for n, at in _by_length(table):
                yield n, _Rows(table.take(pa.array(at)) if len(at) < table.num_rows else table)


# -- search --------------------------------------------------------------------

class _Best:
    """The best ``k`` (score, id) of each anchor and window, over blocks."""

    def __init__(self, anchors: int, windows: int, k: int):
        self.score = np.full((anchors, windows, k), NONE)
        self.id = np.zeros((anchors, windows, k), np.int64)

    def add(self, anchor: np.ndarray, window: int, score: np.ndarray, ids: np.ndarray):
        """Rows of a window: the best of each anchor are kept."""
        k = self.score.shape[2]
        order = np.lexsort((ids, -score, anchor))
        anchor, score, ids = anchor[order], score[order], ids[order]
        lead = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        place = np.arange(len(anchor)) - np.repeat(lead, np.diff(np.append(lead, len(anchor))))
        top = place < k
        who, row = anchor[lead], np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(anchor))))[top]
        new_score, new_id = np.full((len(who), k), NONE), np.zeros((len(who), k), np.int64)
        new_score[row, place[top]], new_id[row, place[top]] = score[top], ids[top]
        score, ids = np.hstack([self.score[who, window], new_score]), np.hstack([self.id[who, window], new_id])
        best = _row_order(score, ids)[:, :k]
        take = np.arange(len(who))[:, None]
        self.score[who, window], self.id[who, window] = score[take, best], ids[take, best]

    def rows(self, names: np.ndarray) -> pa.RecordBatch | None:
        a, w, k = np.nonzero(self.score != NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(names[a], pa.int64()), pa.array(w, pa.int32()), pa.array(self.score[a, w, k], pa.int64()), pa.array(self.id[a, w, k], pa.int64())],
            names=["anchor", "window", "score", "id"])


def _row_order(score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per row: places by falling score, then rising id."""
    by_id = np.argsort(ids, axis=1, kind="stable")
    by_score = np.argsort(-np.maximum(np.take_along_axis(score, by_id, 1), -(2 ** 62)), axis=1, kind="stable")
    return np.take_along_axis(by_id, by_score, 1)


def _reach(low: np.ndarray, high: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) score that still counts in any window of each anchor,
    given the windows and the last of the best rows so far."""
    least = np.maximum(low, last)
    real = least <= high
    return (np.where(real, least, np.iinfo(np.int64).max).min(axis=1).astype(np.float64),
            np.where(real, high, NONE).max(axis=1).astype(np.float64))


def _search(anchors: dict, rows: _Rows, best: _Best, same: bool, low: np.ndarray, high: np.ndarray):
    """Try a block against anchors (arrays of one vector length). ``low``/``high``:
    (anchor, window) bounds of scores; ``same``: whether labels must agree."""
    # With equal labels wanted, anchors whose label the block does not hold are left out.
    labels = np.unique(rows.label)
    wanted = np.flatnonzero(np.isin(anchors["label"], labels)) if same else (
        np.flatnonzero(anchors["label"] != labels[0]) if len(labels) == 1 else np.arange(len(anchors["label"])))
    for lo in range(0, len(wanted), TILE):
        at = wanted[lo: lo + TILE]
        slot = anchors["slot"][at]
        a, norm = anchors["angles"][at], anchors["norm"][at]
        g_low, g_high = group_bounds(a, norm, rows.least, rows.most, rows.min_norm, rows.max_norm)
        for g in range(len(rows.first)):
            floor, ceiling = _reach(low[slot], high[slot], best.score[slot, :, -1])
            who = np.flatnonzero((g_high[:, g] >= floor) & (g_low[:, g] <= ceiling))
            if not len(who):
                continue
            members = slice(rows.first[g], rows.first[g] + GROUP)
            r_low, r_high = row_bounds(a[who], norm[who], rows.angles[members], rows.norm[members])
            overlap = (r_high >= floor[who][:, None]) & (r_low <= ceiling[who][:, None])
            overlap &= (anchors["label"][at[who]][:, None] == rows.label[members][None, :]) == same
            overlap &= anchors["id"][at[who]][:, None] != rows.id[members][None, :]
            i, j = np.nonzero(overlap)
            if not len(i):
                continue
            x, y = anchors["q"][at[who]], rows.q[members]
            # Integer scores, exact in doubles (norms are bounded): few pairs one by one, many as a product of matrices.
            score = (np.einsum("ij,ij->i", x[i], y[j]) if 8 * len(i) < overlap.size else (x @ y.T)[i, j]).astype(np.int64)
            owner, ids = slot[who][i], rows.id[members][j]
            for w in range(low.shape[1]):
                inside = (score >= np.maximum(low[owner, w], best.score[owner, w, -1])) & (score <= high[owner, w])
                if inside.any():
                    best.add(owner[inside], w, score[inside], ids[inside])


def _scan(blocks: DataFrame, portion, low, high, k: int, same: bool) -> DataFrame:
    """(anchor, window, score, id): the best ``k`` of each task. ``portion``,
    ``low`` and ``high`` are broadcast arrays of one portion of anchors."""

    def run(batches):
        table = portion.value
        windows = low.value
        best = _Best(len(windows), windows.shape[1], k)
        by_length = {}
        for n, at in _by_length(table):
            rows = _Rows(table.take(pa.array(at)))
            by_length[n] = {"slot": at, "id": rows.id, "label": rows.label, "norm": rows.norm, "q": rows.q, "angles": rows.angles}
        for n, rows in _blocks(batches):
            if n in by_length:
                _search(by_length[n], rows, best, same, windows, high.value)
        yield best.rows(np.arange(len(windows)))

    return blocks.select("data").mapInArrow(run, "anchor long, window int, score long, id long")


def _merge(partial: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each anchor and window, ranked; a partition of the window
    holds at most ``k`` rows a task."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0, portion: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    for the rows of ``df`` where ``anchors`` holds: for each of an anchor's first
    ``positives`` other rows of its label, the first ``negatives`` rows of other
    labels whose score is ``low`` to ``high`` percent of the positive's."""
    spark = df.sparkSession
    ship(spark)
    rows = quantised(df, id_col, vector_col, label_col, scale)
    sample = rows.select("q").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()["q"]  # bounded: SAMPLE rows
    lengths = {len(q) for q in sample}
    references = {n: fit_references(np.stack([q for q in sample if len(q) == n]).astype(np.float64)) for n in lengths if n}
    blocks = angular_blocks(rows, references, "angles")
    chosen = angular_blocks(quantised(df.where(anchors), id_col, vector_col, label_col, scale), references, "anchors")
    path = scratch_path(spark, "negatives")
    spark.createDataFrame([], RESULT).write.parquet(path)  # a table even without anchors
    for part in _portions(chosen, portion):
        n = part.num_rows
        sent = [spark.sparkContext.broadcast(x) for x in (part, np.full((n, 1), -(2 ** 62)), np.full((n, 1), 2 ** 62))]
        found = materialise(_merge(_scan(blocks, *sent, positives, True), positives), "positives")
        # At most ``positives`` rows an anchor of the portion.
        best = found.select("anchor", "rank", "score", "id").toArrow()
        a, r = np.asarray(best["anchor"]), np.asarray(best["rank"]) - 1
        score, ids = np.full((n, positives), NONE), np.zeros((n, positives), np.int64)
        score[a, r], ids[a, r] = np.asarray(best["score"]), np.asarray(best["id"])
        # low * p <= 100 * s <= high * p in integers; no window without a positive.
        least = np.where(score == NONE, 2 ** 62, -((-low * score) // 100))
        most = np.where(score == NONE, -(2 ** 62), (high * score) // 100)
        wide = [spark.sparkContext.broadcast(x) for x in (least, most)]
        ids_of = pa.table({"anchor": np.repeat(np.arange(n), positives), "window": pa.array(np.tile(np.arange(positives), n), pa.int32()),
                           "anchor_id": np.repeat(np.asarray(part["id"]), positives), "positive_id": ids.reshape(-1), "positive_score": score.reshape(-1)})
        names = F.broadcast(spark.createDataFrame(ids_of))  # one row a window of the portion
        merged = _merge(_scan(blocks, sent[0], *wide, negatives, False), negatives)
        merged.join(names, ["anchor", "window"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.mode("append").parquet(path)
        for x in [*sent, *wide]:
            x.destroy()
    return spark.read.schema(RESULT).parquet(path)


def _portions(chosen: DataFrame, portion: int):
    """The anchors in tables of at most ``portion`` rows, one at a time."""
    held, n = [], 0
    for row in chosen.select("data").toLocalIterator():
        table = unpack(row["data"])
        while table.num_rows:
            part = table.slice(0, portion - n)
            held.append(part)
            n += part.num_rows
            table = table.slice(part.num_rows)
            if n == portion:
                yield pa.concat_tables(held).combine_chunks()
                held, n = [], 0
    if held:
        yield pa.concat_tables(held).combine_chunks()


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", "embedding", label.alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLE = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CASE WHEN len(a.q) = len(b.q) THEN list_inner_product(a.q, b.q)::BIGINT END AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0 AND len(a.q) > 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same AND score IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank, id AS negative_id,
  positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
