"""Benchmark decontamination against a plain Smith-Waterman table."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq

from gazetta.llm.decontaminate import NGRAM, SEED_SHARE, THRESHOLD, align, op5_decontaminate

SF = "/root/testdata/sf0.001"


def smith_waterman(item, doc):
    """Best local score: 2 for an equal word, -1 for another, -1 for a gap."""
    best, above = 0, [0] * (len(doc) + 1)
    for x in item:
        row = [0]
        for j, y in enumerate(doc):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def test_align():
    rng = random.Random(8)
    items, docs = [], []
    for _ in range(300):
        item = [rng.randint(1, 12) for _ in range(rng.randint(1, 15))]
        doc = [rng.randint(1, 12) for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.6:  # an edited copy
            at = rng.randint(0, len(doc))
            doc[at:at] = [x for x in item if rng.random() < 0.8]
        items.append(item)
        docs.append(doc)
    pad = lambda rows: np.array([r + [0] * (max(map(len, rows)) - len(r)) for r in rows], np.uint64)
    sizes = lambda rows: np.array([len(r) for r in rows])
    score, start, end = align(pad(items), sizes(items), pad(docs), sizes(docs))
    for i, (item, doc) in enumerate(zip(items, docs)):
        assert score[i] == smith_waterman(item, doc), (item, doc)
        if score[i]:
            assert 0 <= start[i] < end[i] <= len(doc)
            assert smith_waterman(item, doc[start[i]: end[i]]) == score[i]


def words(text):
    return [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())]


def grams(w):
    return [tuple(w[i: i + NGRAM]) for i in range(len(w) - NGRAM + 1)] if len(w) >= NGRAM else [tuple(w)] if w else []


def test_query(spark):
    """Every (document, item) pair that shares a rare n-gram, aligned over the whole document."""
    read = lambda name, *columns: zip(*(pq.read_table(f"{SF}/{name}.parquet")[c].to_pylist() for c in columns))
    docs = {d: words(t) for d, t in read("documents", "doc_id", "text")}
    items = {i: words(t) for i, t in read("benchmark", "item_id", "text")}
    wanted = {g for w in items.values() for g in grams(w)}
    lengths = {len(g) for g in wanted}
    held = {d: {g for n in lengths for i in range(len(w) - n + 1) if (g := tuple(w[i: i + n])) in wanted} for d, w in docs.items()}
    count = Counter(g for gs in held.values() for g in gs)
    holders = defaultdict(set)
    for d, gs in held.items():
        for g in gs:
            holders[g].add(d)
    expected = {}
    for i, w in items.items():
        n = sorted(count[g] for g in grams(w))
        rare = {g for g in grams(w) if count[g] <= n[math.floor(SEED_SHARE * (len(n) - 1))]}
        for d in set().union(*(holders[g] for g in rare)):
            score = smith_waterman(w, docs[d]) / (2 * len(w))
            if score >= THRESHOLD:
                expected[d, i] = score
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in op5_decontaminate(spark, SF).collect()}
    assert expected and got == expected
