"""Quality classifier by positive-unlabelled learning.

Trusted positives are texts labelled good; everything else is unlabelled web
text (labels of bad texts are not used). The class prior comes from the best
bin estimate: a plain positive-against-unlabelled model orders held-back texts,
and the smallest ratio of the two groups' shares above a cut, with its
confidence margin, bounds the share of positives among the unlabelled. An
additive logistic model then minimises the non-negative unbiased risk
``prior * Rp(+) + max(0, Ru(-) - prior * Rp(-))``. Its scores become
probabilities by the same two samples: along the score, the prior times the
positives' share over the unlabelled texts' share, made monotone.

The model is fitted on bounded samples (``max_positives``, ``max_unlabelled``
texts, drawn by hash of the id); every text is scored. Inputs are counts of the
text alone: character-class transitions, word and line repetition, lengths.

Defined results: null and empty texts have the features of a text without
words and get a score like any other; ids labelled twice are positives if all
their labels are 1; with no positive, or no unlabelled text, every score is 0.5;
repeated rows are scored alike; an empty table gives an empty result; other
columns pass through; where one has an output's name, the output's
name gets ``_`` appended until it is free.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.llm.util import Words, fresh, hash_ranges, read_table, ship, text_bytes, text_slices, window_hashes

MAX_POSITIVES = 20_000
MAX_UNLABELLED = 30_000
FOLDS = 5
CUT = 0.3
BINS = 24

#: Character classes: lower, upper, digit, space, line end, stop marks, symbols, other ASCII, non-ASCII.
_CLASS = np.full(256, 7, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = 3, 4
_CLASS[[ord(c) for c in ".,;:'\"()-?"]] = 5
_CLASS[[ord(c) for c in "#*$%&|<>!~^@=+_"]] = 6
_CLASS[128:] = 8
_N = 9
#: Features after the transition shares.
STATS = ["words", "length", "distinct", "top", "twice", "repeats", "lines", "dup_lines", "line_length", "long_words"]


def features(col: pa.Array) -> np.ndarray:
    """One row of float32 features a text."""
    raw, offsets = text_bytes(col)
    n_docs, sizes = len(offsets) - 1, np.diff(offsets)
    doc = np.repeat(np.arange(n_docs), sizes)
    cls = _CLASS[raw]
    pair = np.zeros(n_docs * _N * _N, np.int64)
    if len(raw) > 1:
        inside = doc[1:] == doc[:-1]
        pair = np.bincount(((doc[:-1] * _N + cls[:-1]) * _N + cls[1:])[inside], minlength=n_docs * _N * _N)
    shares = pair.reshape(n_docs, _N * _N) / np.maximum(sizes, 1)[:, None]
    w = Words(raw, offsets)
    h = w.hashes()
    five = window_hashes(h, 5)
    length = w.end - w.start
    ends = np.union1d(np.flatnonzero(raw == 10), offsets[1:][sizes > 0])  # line ends and text ends
    line_from = np.concatenate([[0], ends + (ends < len(raw)) * (raw[np.minimum(ends, max(len(raw) - 1, 0))] == 10)]) if len(raw) else np.zeros(1, int)
    line_from = np.unique(np.concatenate([line_from, offsets]))
    line_from = line_from[line_from < len(raw)]
    line_size = np.diff(np.concatenate([line_from, [len(raw)]]))
    line_hash = hash_ranges(raw, line_from, line_size)
    line_at = np.searchsorted(line_from, offsets)
    stats = np.zeros((n_docs, len(STATS)))
    for i in range(n_docs):
        a, b = w.first[i], w.first[i + 1]
        n = b - a
        if not n:
            continue
        words, count = np.unique(h[a:b], return_counts=True)
        grams = five[a: max(a, b - 4)]
        lines = line_hash[line_at[i]: line_at[i + 1]]
        stats[i] = (np.log1p(n), length[a:b].mean(), len(words) / n, count.max() / n, (h[a + 1: b] == h[a: b - 1]).mean() if n > 1 else 0,
                    1 - len(np.unique(grams)) / len(grams) if len(grams) else 0, np.log1p(len(lines)),
                    1 - len(np.unique(lines)) / max(len(lines), 1), np.log1p(n / max(len(lines), 1)), (length[a:b] > 20).mean())
    return np.concatenate([shares, stats], axis=1).astype(np.float32)


class Model:
    """Additive logistic model: each feature by quantile bins and linearly."""

    def __init__(self, sample: np.ndarray):
        q = np.quantile(sample, np.linspace(0, 1, BINS + 1)[1:-1], axis=0) if len(sample) else np.zeros((BINS - 1, sample.shape[1]))
        self.edges = [np.unique(q[:, i]) for i in range(sample.shape[1])]
        self.at = np.cumsum([0] + [len(e) + 1 for e in self.edges])
        self.weights = np.zeros(self.at[-1])
        self.bias = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        """For each row, the index of its weight for every feature."""
        return np.stack([np.searchsorted(e, x[:, i], side="left") + self.at[i] for i, e in enumerate(self.edges)], axis=1)

    def logit(self, bins: np.ndarray) -> np.ndarray:
        return self.weights[bins].sum(axis=1) + self.bias

    def fit(self, positive, unlabelled, prior: float | None, epochs: int = 60, batch: int = 1024, rate: float = 0.02, decay: float = 2e-5, seed: int = 7):
        """``prior`` None: plain logistic regression of positives against unlabelled."""
        rng = np.random.default_rng(seed)
        m, v, t = np.zeros(len(self.weights) + 1), np.zeros(len(self.weights) + 1), 0
        sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        softplus = lambda z: np.logaddexp(0, z)
        steps = 50
        for epoch in range(epochs):
            for _ in range(steps):
                p = positive[rng.integers(0, len(positive), batch)]
                u = unlabelled[rng.integers(0, len(unlabelled), batch)]
                zp, zu = self.logit(p), self.logit(u)
                if prior is None:
                    gp, gu = (sigmoid(zp) - 1) / 2, sigmoid(zu) / 2
                else:
                    risk = softplus(zu).mean() - prior * softplus(zp).mean()
                    if risk >= 0:
                        gp, gu = prior * (sigmoid(zp) - 1) - prior * sigmoid(zp), sigmoid(zu)
                    else:  # the negative risk went below zero: step back from it
                        gp, gu = prior * sigmoid(zp), -sigmoid(zu)
                grad = (np.bincount(p.ravel(), np.repeat(gp, p.shape[1]), len(self.weights))
                        + np.bincount(u.ravel(), np.repeat(gu, u.shape[1]), len(self.weights))) / batch
                grad = np.append(grad + decay * self.weights, (gp.mean() + gu.mean()))
                t += 1
                m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
                step = rate * (1 - epoch / epochs) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
                self.weights -= step[:-1]
                self.bias -= step[-1]
        return self


    def calibrate(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float, bins: int = 60):
        """Monotone map from scores to probabilities (pool adjacent violators)."""
        edges = np.unique(np.quantile(unlabelled, np.linspace(0, 1, bins + 1)[1:-1]))
        count = lambda x: np.bincount(np.searchsorted(edges, x), minlength=len(edges) + 1)
        u, p = count(unlabelled) + 1e-9, count(positive)
        value = np.minimum(1, prior * (p / len(positive)) / (u / len(unlabelled)))
        blocks: list[list[float]] = []  # value, weight, bins
        for x, w in zip(value, u):
            blocks.append([x, w, 1])
            while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
                x2, w2, n2 = blocks.pop()
                x1, w1, n1 = blocks.pop()
                blocks.append([(x1 * w1 + x2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
        level = np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])
        middle = np.concatenate([[unlabelled.min()], (edges[1:] + edges[:-1]) / 2, [unlabelled.max()]]) if len(edges) > 1 else np.linspace(0, 1, len(level))
        self.curve = (middle, level)

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = self.logit(self.bins(x))
        # The raw score keeps texts of equal probability in order.
        return 0.99 * np.interp(z, *self.curve) + 0.01 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, error: float = 0.1) -> float:
    """Best bin estimate of the positives' share, from scores (higher: more positive)."""
    p, u = np.sort(positive), np.sort(unlabelled)
    cuts = np.quantile(p, np.linspace(0.0, 0.9, 91))
    qp = 1 - np.searchsorted(p, cuts, side="left") / len(p)
    qu = 1 - np.searchsorted(u, cuts, side="left") / len(u)
    margin = np.sqrt(np.log(4 / error) / (2 * len(u))) + np.sqrt(np.log(4 / error) / (2 * len(p)))
    best = np.argmin((qu + margin) / qp)
    return float(np.clip(qu[best] / qp[best], 0.01, 0.99))


def train(positive: np.ndarray, unlabelled: np.ndarray) -> Model | None:
    """A fitted model, or None if there is nothing to learn from."""
    if not len(positive) or not len(unlabelled):
        return None
    order = lambda x: x[np.random.default_rng(3).permutation(len(x))]
    positive, unlabelled = order(positive), order(unlabelled)
    model = Model(unlabelled)
    p, u = model.bins(positive), model.bins(unlabelled)
    a, b = max(1, len(p) // 2), max(1, len(u) // 2)
    plain = Model(unlabelled).fit(p[:a], u[:b], None, epochs=10)
    prior = estimate_prior(plain.logit(p[a:] if len(p) > 1 else p), plain.logit(u[b:] if len(u) > 1 else u))
    model.prior = prior
    model.fit(p, u, prior)
    model.calibrate(model.logit(p), model.logit(u), prior)
    return model


def in_fold(id_col: Column, folds: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder`` modulo ``folds`` (null ids: false)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == remainder, F.lit(False))


def _sample(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, most: int) -> np.ndarray:
    """Features of the texts of at most ``most`` ids, drawn by hash of the id."""
    ids = ids.select(F.col(id_col).alias("__id")).distinct().orderBy(F.xxhash64("__id"), "__id").limit(most)
    width = _N * _N + len(STATS)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in features(part.column(0))], pa.binary())], names=["x"])

    rows = docs.join(F.broadcast(ids), F.col(id_col) == F.col("__id"), "left_semi").select(F.col(text_col).alias("text"))
    data = rows.mapInArrow(run, "x binary").toArrow()["x"].to_pylist()
    return np.frombuffer(b"".join(sorted(data)), np.float32).reshape(-1, width)


def score_quality(
    docs: DataFrame, labels: DataFrame, train_ids: Column, id_col: str = "doc_id", text_col: str = "text", out: str = "score",
    max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED,
) -> DataFrame:
    """``docs`` (without the text) plus ``out``: the probability of a good text.
    ``train_ids``: condition on the id of rows to learn from; ``labels``: (id, quality)."""
    ship(docs.sparkSession)
    learn = docs.where(train_ids)
    good = labels.where(train_ids).groupBy(id_col).agg(F.min(F.coalesce("quality", F.lit(0))).alias("q")).where("q = 1")
    model = train(_sample(learn, good, id_col, text_col, max_positives), _sample(learn, learn, id_col, text_col, max_unlabelled))
    others = [c for c in docs.columns if c != text_col]
    out = fresh(others, out)
    schema = T.StructType([docs.schema[c] for c in others] + [T.StructField(out, T.DoubleType())])

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text_col):
                if model is None:
                    score = np.full(part.num_rows, 0.5)
                else:
                    score = model.probability(features(part.column(len(others))))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(others))), pa.array(score, pa.float64())], names=[*others, out])

    return docs.select(*others, text_col).mapInArrow(run, schema)


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = in_fold(F.col("doc_id"), FOLDS, 0)
    scored = score_quality(docs, labels, F.col("doc_id").isNotNull() & ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
