"""Learned operators: base values by brute force, held-out quality, edge cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np
from cases import lower, words
from pyspark.sql import functions as F

from gazetta.llm import context_mixing, pu_quality, quality_rules
from gazetta.llm.util import text_bytes


def measures_of(t):
    w = words(t)
    windows = [tuple(w[i: i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    hit = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(5)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t or "")),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
            "n_capitals": len(re.findall("[A-Z]", t or "")), "n_shouts": (t or "").count("!")}


def test_measures(docs, corpus):
    got = {r["doc_id"]: r["m"].asDict() for r in quality_rules.measures(docs, "text", "m").collect()}
    assert got == {i: measures_of(t) for i, t in corpus}


def test_binomial_cdf(spark):
    rows = [(k, n) for n in (1, 5, 40, 3000) for k in (0, 1, 3) if k <= n]
    df = spark.createDataFrame(rows, "k long, n long").select("k", "n", quality_rules.binomial_cdf(F.col("k"), F.col("n"), 0.03).alias("p"))
    for r in df.collect():
        want = sum(math.comb(r["n"], i) * 0.03**i * 0.97 ** (r["n"] - i) for i in range(r["k"] + 1))
        assert math.isclose(r["p"], want, rel_tol=1e-9)


def test_cutoffs_hold_their_promise(spark):
    """Good texts with a tail of symbols: the chosen cutoffs reject few, and junk goes."""
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(4000):
        good = i % 8 != 0
        n = int(rng.integers(20, 60))
        share = rng.exponential(0.002) if good else rng.uniform(0.2, 0.6)
        w = ["#" if rng.random() < share else f"word{rng.integers(9999)}" for _ in range(n)]
        rows.append((i, " ".join(w), "en" if i % 2 else None))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = quality_rules.apply_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int"), out="q")
    got = {r["doc_id"]: r["q"]["kept"] for r in out.collect()}
    good = [got[i] for i, y in labels if y]
    bad = [got[i] for i, y in labels if not y]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.35


def test_rules_without_labels(docs, empty, corpus):
    none = docs.sparkSession.createDataFrame([], "doc_id long, quality int")
    got = {r["doc_id"]: r["q"] for r in quality_rules.apply_rules(docs, none, out="q").collect()}
    for i, t in corpus:
        m = measures_of(t)
        assert got[i]["kept"] == (not got[i]["base_failed"]) == (m["n_words"] >= 10 and 100 * m["n_repeat_words"] <= 20 * m["n_words"])
    assert quality_rules.apply_rules(empty, none, out="q").count() == 0


def test_pu_quality(spark):
    """Trained on positives and unlabelled texts only; judged on held-out labels."""
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(3000):
        good = rng.random() < 0.7
        w = [f"{'abcdefgh'[j]}{rng.integers(99)}" for j in rng.integers(0, 8, 40)] if good else ["BUY!!", "NOW"] * 10 + [f"x{rng.integers(9)}" for _ in range(9)]
        rows.append((i, " ".join(w)))
        if rng.random() < 0.5:
            labels.append((i, int(good)))
    rows += [(5000, None), (5001, ""), (5001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held_out = pu_quality.in_fold(F.col("doc_id"), 5, 0)
    out = pu_quality.score_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"), ~held_out)
    got = {r["doc_id"]: r["score"] for r in out.collect()}
    assert all(0 <= s <= 1 for s in got.values()) and out.count() == len(rows)
    test = [(got[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s >= pu_quality.CUT) == bool(y) for s, y in test]) > 0.95
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in pu_quality.score_quality(docs, none, ~held_out).collect()} == {0.5}


def test_prior():
    rng = np.random.default_rng(1)
    p = rng.normal(2, 1, 5000)
    u = np.concatenate([rng.normal(2, 1, 3000), rng.normal(-2, 1, 2000)])
    assert abs(pu_quality.estimate_prior(p, u) - 0.6) < 0.06


def test_units_cover_the_text(corpus):
    import pyarrow as pa

    u = context_mixing.Units(*text_bytes(pa.array([t for _, t in corpus], pa.string())))
    at = 0
    for (_, t), n in zip(corpus, u.per_text):
        b = b"".join(u.raw[a:e].tobytes() for a, e in zip(u.start[at: at + n], u.end[at: at + n]))
        assert b == (t or "").encode() + bytes([context_mixing.END])
        at += n


def test_long_words_are_cut():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("acgt"), 1_000_000)) + " end"
    u = context_mixing.Units(*text_bytes(pa.array([text, "end"], pa.string())))
    assert (u.end - u.start).max() == context_mixing.LONGEST and u.per_text.tolist() == [15_627, 1]
    assert u.raw.tobytes() == b"".join(t.encode() + bytes([context_mixing.END]) for t in (text, "end"))
    assert (u.state[1:15_626] == 9).all() and u.state[15_626] != 9


def test_long_ranges_hash_by_content():
    from gazetta.llm.util import hash_ranges

    rng = np.random.default_rng(6)
    word = rng.integers(97, 123, 3_000_001).astype(np.uint8)
    other = word.copy()
    other[1_500_000] ^= 1
    swapped = np.concatenate([word[8:16], word[:8], word[16:]])
    raw = np.concatenate([np.zeros(3, np.uint8), word, other, swapped, word])
    n = len(word)
    h = hash_ranges(raw, np.array([3, 3 + n, 3 + 2 * n, 3 + 3 * n]), np.full(4, n))
    assert h[0] == h[3] and len(set(h[:3].tolist())) == 3


def test_bit_probabilities_sum_to_one():
    """Over all bytes that could come next, the model's probabilities sum to one."""
    rng = np.random.default_rng(2)
    n = rng.integers(0, 9, (2, context_mixing._SLOTS))
    mixer = context_mixing.Mixer(*n.astype(np.uint16))
    mixer.set_map(np.ones(256 * context_mixing.MAP_CELLS), np.zeros(256 * context_mixing.MAP_CELLS))
    prefix = np.frombuffer(b"some ", np.uint8)[:4]
    raw = np.concatenate([np.append(prefix, b) for b in range(256)]).astype(np.uint8)
    bits = context_mixing.Bits(raw, np.full(256, 5), np.zeros(256, np.int64))
    assert math.isclose((10 ** mixer.cost(bits).reshape(256, 5)[:, 4]).sum(), 1, rel_tol=1e-4)


def test_scores(docs, corpus, empty):
    learn = F.col("doc_id") % 3 != 0
    got = {r["id"]: r for r in context_mixing.score_texts(docs, learn).collect()}
    count = Counter()
    for i, t in corpus:
        if i % 3:
            count.update(words(lower(t)))
            count["\n"] += 1
    total, distinct = sum(count.values()), len(count)
    for i, t in corpus:
        tokens = [*words(lower(t)), "\n"]
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(count[x] > 0 for x in tokens), total)
        assert math.isclose(r["base_score"], sum(math.log10((count[x] + 1) / (total + distinct + 1)) for x in tokens), rel_tol=1e-9)
        assert r["score"] < 0 and r["n_bytes"] == len((t or "").encode())
    # a text of the training vocabulary costs fewer bits a byte than a stranger one
    rate = lambda i: -got[i]["score"] / got[i]["n_bytes"]
    assert rate(30) < rate(9)
    assert context_mixing.score_texts(empty, learn).count() == 0
    untrained = {r["id"]: r for r in context_mixing.score_texts(docs, F.lit(False)).collect()}
    assert math.isclose(untrained[4]["score"], -8 * 4 * math.log10(2), rel_tol=1e-6)


def plain_units(text):
    """(bytes, state) of each unit, by a loop over bytes."""
    space, out, start = b" \t\n\v\f\r", [], 0
    raw = (text or "").encode() + bytes([context_mixing.END])
    for i, x in enumerate(raw):
        if x in space or x == context_mixing.END:
            for at in range(start, i + 1, context_mixing.LONGEST):
                last = raw[at - 2] if at > 1 else context_mixing.END
                state = 9 if at > start else 0 if at == 0 else 1 + (last in b".!?:") + 2 * (raw[at - 1] != 32) + 4 * (last in space)
                out.append((raw[at: min(at + context_mixing.LONGEST, i + 1)], state))
            start = i + 1
    return out


def test_continuations(spark, corpus):
    """Of learned texts every unit is one that followed, so their scores come
    from counts alone; against dictionaries. Words out of order cost more."""
    rng = np.random.default_rng(7)
    long = max((t for _, t in corpus if t), key=lambda t: len(t) if len(t) < 20_000 else 0)
    shuffled = " ".join(rng.permutation(long.split()))
    texts = [*corpus, (1_000_001, " a  b"), (1_000_003, " a b" + "c" * 200), (1_000_005, shuffled)]
    held_out = {i for i, _ in texts if i % 3 == 0 or i == 1_000_005}
    seen, both = Counter(), Counter()
    units = {i: plain_units(t) for i, t in texts}
    for i in units.keys() - held_out:
        seen.update([None, *units[i]][:-1])
        both.update(zip([None, *units[i]], units[i]))
    cell = lambda n: math.ceil(math.log2(n + 1))
    met, known = Counter(), Counter()
    for (a, b), n in both.items():
        met[cell(seen[a] - 1)] += n
        known[cell(seen[a] - 1)] += n if n > 1 else 0
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = {r["id"]: r for r in context_mixing.score_texts(df, ~F.col("doc_id").isin(held_out)).collect()}
    for i in units.keys() - held_out:
        want = sum(math.log10((known[cell(seen[a])] + 0.5) / (met[cell(seen[a])] + 1) * both[a, b] / seen[a]) for a, b in zip([None, *units[i]], units[i]))
        assert math.isclose(got[i]["score"], want, rel_tol=1e-9)
        assert math.isclose(got[i]["bits_per_byte"], -want / math.log10(2) / max(1, got[i]["n_bytes"]), rel_tol=1e-9)
    near = next(i for i, t in corpus if t == long)
    if near not in held_out:
        assert got[1_000_005]["score"] < 1.3 * got[near]["score"]


def test_text_without_spaces(spark):
    rng = np.random.default_rng(8)
    texts = [(i, "".join(rng.choice(list("ACGT"), 2_000_000 if i == 1 else 500)), i) for i in range(1, 8)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, score long")
    got = {r["id"]: r for r in context_mixing.score_texts(docs, F.col("doc_id") != 2).collect()}
    assert got[1]["n_bytes"] == 2_000_000 and got[1]["n_tokens"] == 2
    assert 2 < got[2]["bits_per_byte"] < 4  # four letters at random: two bits each, the first bits and the end besides


def test_context_counts_are_exact(spark):
    """Every bit's counts, against a dictionary: no context shares another's, however many there are."""
    rng = np.random.default_rng(3)
    texts = [" ".join("".join(rng.choice(list("abcdefghij"), rng.integers(1, 9))) for _ in range(500)) for _ in range(40)]
    df = spark.createDataFrame([(i, t, i % 4 > 0) for i, t in enumerate(texts)], "id long, text string, learned boolean").repartition(3)
    chunks = context_mixing.to_chunks(df, "text", "texts")
    units = context_mixing.each_chunk(chunks, lambda _, t: context_mixing._chunk_units(t, "text", "learned", 8).to_batches(), context_mixing.UNITS)
    units = units.groupBy("bucket").applyInArrow(context_mixing._merge_units, context_mixing.UNITS)
    buckets = [context_mixing._counted(r) for r in context_mixing._count_contexts(context_mixing.materialise(units, "units"), 8).collect()]

    def bits(u, i, at):
        """(key of the bit, bit) for each predictor and bit of a byte."""
        start, state = at - u.size[:i].sum(), int(u.state[i])
        unit = u.raw[u.size[:i].sum():][: u.size[i]].tobytes()
        for k in range(1, 6):
            seen = (k, unit[max(0, start - k): start], state if start < k else None) if k < 5 else (k, unit[:start], state)
            byte = f"{unit[start]:08b}"
            for j in range(8):
                yield (seen, byte[:j]), int(byte[j])

    want = Counter()
    for u, _ in buckets:
        for i, at in ((i, at) for i in range(len(u.size)) for at in range(u.size[:i].sum(), u.size[: i + 1].sum())):
            if u.count[i]:
                want.update({x: int(u.count[i]) for x in bits(u, i, at)})
    unseen = 0
    for u, counts in buckets:
        for i in range(0, len(u.size), 7):
            for at in range(u.size[:i].sum(), u.size[: i + 1].sum()):
                got = np.concatenate([counts[w[at] * 8: w[at] * 8 + 8] for w in u.where])
                for n, (key, _) in zip(got.tolist(), bits(u, i, at)):
                    assert (n & 0xFFFF, n >> 16) == (want[key, 0], want[key, 1])
                    unseen += n == 0
    assert unseen


def test_counts_beyond_31_bits():
    """A unit seen more than 2^31 times keeps its counts."""
    import pyarrow as pa

    seen = (1 << 33) + 5
    row = context_mixing._pack_units(0, np.frombuffer(b"  x ", np.uint8), np.array([1, 1, 2]), np.array([5, 6, 0]), np.array([seen, seen, 1]))
    asked = pa.Table.from_batches(context_mixing._ask(1)(context_mixing._unit_rows([row]).to_batches()))
    counts = context_mixing._unzip(context_mixing._answer(asked)["slots"][0].as_py(), np.uint32)
    assert ((counts & 0xFFFF) + (counts >> 16) > 0).all()
    once = context_mixing.bit_counts(np.array([32, 32 + 256], np.uint64), np.array([seen, 1]))
    assert (np.maximum(once[0] & 0xFFFF, once[0] >> 16) > 1 << 14).all() and (np.maximum(once[1] & 0xFFFF, once[1] >> 16) == 1).all()


def test_map_counts_all_units():
    """Of small and large buckets alike, every training bit enters the map."""
    rng = np.random.default_rng(4)
    for n in (300, 150_000):  # the larger: more than 64 blocks
        size = rng.integers(1, 15, n)
        bucket = context_mixing.Bucket(rng.integers(97, 123, size.sum()).astype(np.uint8), size, np.zeros(n, np.int64), rng.integers(0, 4, n))
        pairs, total = bucket.pairs, bucket.occurrences()
        _, _, seen, ones = context_mixing.Mixer().of(context_mixing.bit_counts(pairs, total).ravel()).learn(bucket)
        assert seen.sum() == 8 * (size * bucket.count).sum() and 0 < ones.sum() < seen.sum()
