"""Near duplicates: universal hash minima, banding, verification, components.

1. A text's set is its distinct ``shingle``-word shingles. Equal sets are one
   group at once (by a 128-bit fingerprint); one representative goes on.
2. ``BANDS x ROWS`` universal hash minima a set; equal bands make buckets.
   Two sets of similarity 0.8 share no bucket with probability 3e-6.
3. Each bucket tests its members against one of them, the one that shares most
   buckets (a group's original rather than one of its variants). A pair is first
   judged by its signatures (pairs five standard errors below the threshold
   go), then by its full sets, computed from whole texts.
4. Buckets that then still hold members of different components are settled by
   full sets: their members, by that middle member, are dealt into blocks of
   bounded size, and every two blocks meet in one task, which tests the pairs
   of different components. Blocks of the largest component do not meet each
   other. No pair that shares a bucket and could join two components goes
   untested; there is no cap, and no pairs are written out.
5. Links become components by alternating large-star and small-star.

Defined results: null or empty text has an empty set and is linked with
nothing; a text of fewer words than a shingle has its whole word sequence as
its one shingle; repeated ids are separate rows, linked if their texts are
alike; null ids take part, and the smallest non-null id names a component; an
empty table gives an empty result; other columns pass through ``keep_one``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm.components import components
from gazetta.llm.util import Words, few, forget, fresh, lower_ascii, materialise, mix, read_table, text_bytes, text_slices, window_hashes

BANDS, ROWS = 32, 5
#: Members and shingles of a block of sets (a task holds two blocks).
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1 << 17
_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (A-Z lower-cased)."""
    w = Words(lower_ascii(raw), offsets)
    h = w.hashes()
    grams = window_hashes(h, k)
    out = []
    for a, b in zip(w.first[:-1], w.first[1:]):
        if b - a >= k:
            out.append(np.unique(grams[a: b - k + 1]))
        elif b > a:
            out.append(mix(window_hashes(h[a:b], int(b - a)) + np.uint64(b - a)))
        else:
            out.append(h[:0])
    return out


def signature(values: np.ndarray) -> np.ndarray:
    """The minima of a*x+b over the set, for every (a, b); high 32 bits."""
    best = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 1024):
        np.minimum(best, (_A[:, None] * values[None, at: at + 1024] + _B[:, None]).min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def _sets(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(rid, id, n, f1, f2, sig) of each row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        forget()
        for batch in batches:
            for part in text_slices(batch, "text"):
                n, f1, f2, sig = [], [], [], []
                for s in shingle_sets(*text_bytes(part.column(2)), k):
                    n.append(len(s))
                    f1.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                    f2.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                    sig.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                     pa.array(f2, pa.int64()), pa.array(sig, pa.binary())], names=["rid", "id", "n", "f1", "f2", "sig"])

    rows = docs.select("rid", F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"rid long, id {id_type}, n long, f1 long, f2 long, sig binary")


def _alike(pairs: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    """The pairs whose signatures agree in at least ``least`` of their places."""

    def run(batches):
        for batch in batches:
            a = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, len(_A))
            b = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint32).reshape(-1, len(_A))
            yield batch.select(["u", "v"]).filter(pa.array((a == b).mean(axis=1) >= least))

    both = (pairs.join(sigs.select(F.col("rid").alias("v"), F.col("sig").alias("sig_v")), "v")
            .join(sigs.select(F.col("rid").alias("u"), F.col("sig").alias("sig_u")), "u"))
    return both.select("u", "v", "sig_u", "sig_v").mapInArrow(run, "u long, v long")


def _candidate_sets(docs: DataFrame, text_col: str, k: int) -> DataFrame:
    """(rid, n, values) of rows (rid, text); values: the sorted set as bytes."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                sets = shingle_sets(*text_bytes(part.column(1)), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())],
                    names=["rid", "n", "values"])

    return docs.select("rid", F.col(text_col).alias("text")).mapInArrow(run, "rid long, n long, values binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose full sets have |A & B| >= threshold * |A | B|."""
    percent = round(100 * threshold)

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                common = int((a[at] == b).sum())
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    both = (pairs.join(sets.select(F.col("rid").alias("v"), F.col("values").alias("values_v")), "v")
            .join(sets.select(F.col("rid").alias("u"), F.col("values").alias("values_u")), "u"))
    return both.select("u", "v", "values_u", "values_v").mapInArrow(run, "u long, v long")


def _incidence(cells: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    out = np.zeros((len(cells), len(vocabulary)), np.float32)
    for i, x in enumerate(cells):
        at = np.minimum(np.searchsorted(vocabulary, x), len(vocabulary) - 1)
        out[i, at[vocabulary[at] == x]] = 1
    return out


def _meet(percent: int):
    """Links between two blocks of sets (or within one), by products of their
    incidence matrices, some columns at a time."""

    def run(table: pa.Table) -> pa.Table:
        block = np.asarray(table["block"])
        rid, comp, n = (np.asarray(table[c]) for c in ("rid", "comp", "n"))
        cells = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["values"].combine_chunks()]
        left = np.flatnonzero(block == block.min())
        right = np.flatnonzero(block == block.max())
        a, b = [cells[i] for i in left], [cells[i] for i in right]
        vocabulary = np.intersect1d(np.concatenate(a), np.concatenate(b))
        common = np.zeros((len(a), len(b)), np.float32)
        step = max(256, (4 << 20) // (len(a) + len(b)))
        for at in range(0, len(vocabulary), step):
            part = vocabulary[at: at + step]
            common += _incidence(a, part) @ _incidence(b, part).T
        common = common.astype(np.int64)
        union = n[left][:, None] + n[right][None, :] - common
        i, j = np.nonzero((100 * common >= percent * union) & (comp[left][:, None] != comp[right][None, :]))
        u, v = rid[left][i], rid[right][j]
        return pa.table({"u": pa.array(np.minimum(u, v), pa.int64()), "v": pa.array(np.maximum(u, v), pa.int64())})

    return run


def _settled(members: DataFrame, comps: DataFrame, sets: DataFrame, threshold: float) -> DataFrame | None:
    """The links that join different components within buckets; None if no
    bucket of more than two members holds different components."""
    now = members.where("m > 2").join(comps, members.rid == comps.node, "left").select(
        "key", "rid", "center", F.coalesce("root", "rid").alias("comp"))
    unsettled = (now.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("key"))
    now = materialise(now.join(unsettled, "key", "left_semi").select("center", "rid", "comp").distinct(), "open")
    if now.isEmpty():
        return None
    now = now.join(sets, "rid")
    sizes = now.groupBy("center", "comp").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    main = sizes.groupBy("center").agg(F.max_by("comp", F.struct("members", "comp")).alias("main"))
    sides = (sizes.join(main, "center").groupBy("center", (F.col("comp") == F.col("main")).alias("in_main"), "main")
             .agg(F.sum("members").alias("members"), F.sum("shingles").alias("shingles")))
    deal = lambda side: F.max(F.when(side, F.greatest(
        F.ceil(F.col("members") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)))).alias
    blocks = materialise(sides.groupBy("center", "main").agg(deal(F.col("in_main"))("n_main"), deal(~F.col("in_main"))("n_rest"))
                         .na.fill(0, ["n_main", "n_rest"]), "blocks")
    dealt = now.join(blocks, "center")
    # Rest blocks are numbered 0 .. n_rest-1, those of the main component follow.
    draw = F.xxhash64("rid", "center")
    rest = F.col("comp") != F.col("main")
    block = F.when(rest, F.pmod(draw, F.col("n_rest"))).otherwise(F.col("n_rest") + F.pmod(draw, F.greatest(F.col("n_main"), F.lit(1))))
    dealt = dealt.withColumn("block", block)
    others = F.when(rest, F.sequence(F.lit(0).cast("long"), F.col("n_rest") + F.col("n_main") - 1)).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("n_rest") - 1))
    dealt = dealt.where("n_rest > 0").select("center", "rid", "comp", "n", "values", "block", F.explode(others).alias("other"))
    tasks = dealt.groupBy("center", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return tasks.applyInArrow(_meet(round(100 * threshold)), "u long, v long")


def _links(docs: DataFrame, sets: DataFrame, reps: DataFrame, text_col: str, k: int, threshold: float) -> DataFrame:
    """(node, root) of the components among representatives."""
    size = 4 * ROWS
    keys = F.array(*(F.xxhash64(F.substring("sig", 1 + size * i, size), F.lit(i)) for i in range(BANDS)))
    sigs = materialise(sets.join(few(reps, "representatives"), F.col("rid") == F.col("rep"), "left_semi").select("rid", "sig"), "signatures")
    rows = sigs.select("rid", F.explode(keys).alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    members = materialise(rows.join(shared, "key"), "buckets")
    degrees = materialise(members.groupBy("rid").agg(F.sum("m").alias("degree")), "degrees")
    chosen = few(degrees.select("rid"), "members")
    sigs = materialise(sigs.join(chosen, "rid", "left_semi"), "signatures")
    full = materialise(_candidate_sets(docs.join(chosen, "rid", "left_semi"), text_col, k), "candidates")

    best = F.max(F.struct("degree", (-F.col("rid")).alias("r")))
    center = members.join(degrees, "rid").groupBy("key").agg((-best["r"]).alias("center"))
    members = materialise(members.join(center, "key"), "members")
    pairs = members.where("rid <> center").select(F.least("center", "rid").alias("u"), F.greatest("center", "rid").alias("v")).distinct()
    least = threshold - 5 * math.sqrt(threshold * (1 - threshold) / len(_A))
    near = materialise(_alike(pairs, sigs, least), "alike")
    links = materialise(_confirmed(near, full, threshold), "links")
    comps = components(links)
    more = _settled(members, comps, full, threshold)
    if more is None:
        return comps
    # The stars stand for the links that made them.
    return components(comps.select(F.col("node").alias("u"), F.col("root").alias("v")).union(materialise(more, "links")))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, threshold: float = 0.8,
) -> tuple[DataFrame, DataFrame]:
    """``docs`` written with a row id as its last column (``rid``, with underscores
    behind it if ``docs`` has a column of that name), and (rid, id, n, root,
    component_id) for each of its rows; rows of one root are near duplicates."""
    docs = materialise(docs.withColumn(fresh(docs.columns, "rid"), F.monotonically_increasing_id()), "documents")
    rows = docs.select(F.col(docs.columns[-1]).alias("rid"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sets = materialise(_sets(rows, "id", "text", shingle), "sets")
    filled = sets.where("n > 0")
    groups = materialise(filled.groupBy("f1", "f2", "n").agg(F.min("rid").alias("rep")), "groups")
    comps = _links(rows, filled, groups.select("rep"), "text", shingle, threshold)
    rooted = (sets.join(groups, ["f1", "f2", "n"], "left")
              .join(comps, F.col("rep") == F.col("node"), "left")
              .select("rid", "id", "n", F.coalesce("root", "rep", "rid").alias("root")))
    rooted = materialise(rooted, "rooted")
    names = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    return docs, rooted.join(names, "root").select("rid", "id", "n", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id, with its columns."""
    all_rows, found = near_duplicates(docs, id_col, text_col, shingle, threshold)
    rid = all_rows.columns[-1]
    best = F.min_by("rid", F.struct(F.col("id").isNull(), "id", "rid")).alias("best")
    first = found.groupBy("root").agg(best, F.count(F.lit(1)).alias("n")).where("n > 1").select("root", "best")
    gone = found.join(first, "root").where("rid <> best").select(F.col("rid").alias(rid))
    return all_rows.join(few(gone, "gone"), rid, "left_anti").drop(rid)


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    _, found = near_duplicates(docs, shingle=2)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                        (F.col("id") == F.col("component_id")).alias("kept"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near duplicates."""
    return keep_one(docs).select(*docs.columns)
