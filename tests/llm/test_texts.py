"""Passages, bytes, near duplicates and leaks against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import lower, words
from pyspark.sql import functions as F

from gazetta.llm import run_index
from gazetta.llm.components import components
from gazetta.llm.decontaminate import flag
from gazetta.llm.minhash_dedup import keep_one, near_duplicates
from gazetta.llm.run_index import Marks, Segments, remove_matches
from gazetta.llm.substring_dedup import COVERS, substring_dedup


def test_difference_covers():
    for period, cover in COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def covered(n, starts, width):
    gone = [False] * n
    for s in starts:
        gone[s: s + width] = [True] * width
    return gone


def runs(gone):
    return [(i, next((j for j in range(i, len(gone)) if not gone[j]), len(gone))) for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1])]


def test_substring_dedup(docs, corpus):
    for width in (35, 4):
        seen = Counter()
        for _, t in corpus:
            w = words(t)
            seen.update(tuple(w[i: i + width]) for i in range(len(w) - width + 1))
        got = {r["doc_id"]: r for r in substring_dedup(docs, window=width).collect()}
        assert len(got) == len(corpus)
        for i, t in corpus:
            w = words(t)
            gone = covered(len(w), [s for s in range(len(w) - width + 1) if seen[tuple(w[s: s + width])] > 1], width)
            r = got[i]
            assert (r["n_words"], r["n_removed"]) == (len(w), sum(gone))
            assert r["text"] == " ".join(x for x, g in zip(w, gone) if not g)
            assert [(x["start"], x["end"]) for x in r["removed"]] == runs(gone)
            assert r["rid"] == 7


def test_substring_dedup_leaves_untouched_texts(docs, corpus):
    for r in substring_dedup(docs, joined=False).collect():
        if not r["n_removed"]:
            assert r["text"] == (dict(corpus)[r["doc_id"]] or "")


@pytest.mark.parametrize("length, heavy", [(50, 1 << 20), (24, 1 << 20), (90, 1 << 20), (50, 400), (24, 0)])
def test_remove_matches(docs, corpus, length, heavy):
    seen, got = set(), {r["doc_id"]: r for r in remove_matches(docs, length=length, heavy_bytes=heavy).collect()}
    assert len(got) == len(corpus)
    for i, t in corpus:
        b = (t or "").encode()
        strings = [b[s: s + length] for s in range(len(b) - length + 1)]
        gone = covered(len(b), [s for s, x in enumerate(strings) if x in seen], length)
        seen.update(strings)
        r = got[i]
        assert (r["n_bytes"], r["n_removed"]) == (len(b), sum(gone)), (length, i)
        assert bytes(r["text"]) == bytes(x for x, g in zip(b, gone) if not g)
        assert [(x["start"], x["end"]) for x in r["removed"]] == runs(gone)


def test_remove_matches_of_a_passage_with_many_ends(spark):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
    rows = [(i, "".join(rng.choice("klmnopqrst") for _ in range(40)) + passage + "".join(rng.choice("uvwxyz0123") for _ in range(40)))
            for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for heavy in (1 << 12, 1 << 20):
        got = {r["doc_id"]: (r["n_removed"], bytes(r["text"])) for r in remove_matches(frame, heavy_bytes=heavy).collect()}
        seen = set()
        for i, t in rows:
            b = t.encode()
            strings = [b[s: s + 50] for s in range(len(b) - 49)]
            gone = covered(len(b), [s for s, x in enumerate(strings) if x in seen], 50)
            seen.update(strings)
            assert got[i] == (sum(gone), bytes(x for x, g in zip(b, gone) if not g)), i


def test_remove_matches_sends_a_row_a_bucket_whatever_the_indexes(spark, monkeypatch):
    rng = random.Random(8)
    body = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    frame = spark.createDataFrame([(i, body + str(i)) for i in range(4)], "doc_id long, text string").repartition(4)
    monkeypatch.setattr(run_index, "INDEX_BYTES", 64)  # some 1250 indexes
    sent, each_chunk_with = [], run_index.each_chunk_with
    monkeypatch.setattr(run_index, "each_chunk_with", lambda *a: sent.append(each_chunk_with(*a)) or sent[-1])
    assert {r["doc_id"]: r["n_removed"] for r in remove_matches(frame).collect()} == {0: 0, 1: 20_000, 2: 20_000, 3: 20_000}
    rows = sent[0].groupBy("chunk").count().collect()
    assert rows and max(r["count"] for r in rows) <= 64


def test_heavy_segments_become_one_group_a_string():
    rng = random.Random(4)
    passage = bytes(rng.randrange(97, 123) for _ in range(100))
    texts = [bytes(rng.randrange(97, 123) for _ in range(60)) + passage + bytes(rng.randrange(97, 123) for _ in range(60)) for _ in range(500)]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    s = Segments(raw, np.arange(501) * 220, 50)
    strings = sorted(bytes(raw[a + j: a + j + 50]) for a, n in zip(s.start, s.windows) for j in range(n))
    gram, count = np.unique(s.gram, return_counts=True)
    s = s.split(np.isin(s.gram, gram[count > 100]), raw, 50)
    assert strings == sorted(bytes(raw[a + j: a + j + 50]) for a, n in zip(s.start, s.windows) for j in range(n))
    versions = {}
    for g, a, n in zip(s.gram, s.start, s.windows):
        versions.setdefault(int(g), set()).add(bytes(raw[a: a + n + 49]))
    assert max(map(len, versions.values())) <= 100


def test_segments_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(10)
    for length in (24, 50, 90):
        offsets = np.concatenate([[0], np.cumsum(rng.integers(0, 300, 12))])
        raw = rng.integers(97, 101, offsets[-1]).astype(np.uint8)
        found = []
        for block in (1 << 16, 7, 100):
            monkeypatch.setattr(run_index, "BLOCK", block)
            s = Segments(raw, offsets, length)
            found.append([x.tolist() for x in (s.gram, s.start, s.windows, s.doc)])
        assert found[0] == found[1] == found[2] and sum(found[0][2]) == np.maximum(np.diff(offsets) - length + 1, 0).sum()


def test_bytes_under_marked_strings():
    rng = np.random.default_rng(9)
    for length in (24, 50):
        windows = rng.integers(1, 36, 40)
        after = windows + rng.integers(0, 90, 40) * rng.integers(0, 2, 40)
        start = np.cumsum(after) - after
        n = int(start[-1] + windows[-1] + length - 1)
        full = (np.uint64(1) << windows.astype(np.uint64)) - np.uint64(1)
        marks = rng.integers(0, 1 << 36, 40).astype(np.uint64) * rng.integers(0, 2, 40).astype(np.uint64) | full * rng.integers(0, 2, 40).astype(np.uint64)
        starts = [int(a) + p for a, w, m in zip(start, windows, marks) for p in range(w) if int(m) >> p & 1]
        assert run_index._under(n, start, windows, marks, length).tolist() == covered(n, starts, length)


def test_marks_give_the_last_mark_at_or_before():
    rows = np.unique(np.concatenate([[0, 63, 64, 127, 128], np.random.default_rng(5).integers(0, 1000, 90)]))
    assert (Marks(rows, 1000).last(np.arange(1000)) == np.searchsorted(rows, np.arange(1000), side="right") - 1).all()


def test_remove_matches_ids(spark):
    text = "the same sixty bytes of text, in every single one of the rows here"
    rows = [(3, text), (1, text), (None, text), (1, text)]
    got = sorted((r["doc_id"] or 99, r["n_removed"]) for r in remove_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 0), (1, 0), (3, len(text)), (99, len(text))]


def groups(corpus, k):
    """(set size, smallest id reachable) of each document."""
    sets = {}
    for i, t in corpus:
        w = words(lower(t))
        sets[i] = {tuple(w[j: j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(docs, corpus):
    for k in (2, 5):
        want = groups(corpus, k)
        all_rows, found = near_duplicates(docs, shingle=k)
        assert all_rows.columns == [*docs.columns, "rid_"] and {r["rid"] for r in all_rows.collect()} == {7}  # its own column stays
        assert {r["id"]: (r["n"], r["component_id"]) for r in found.collect()} == want
        kept = keep_one(docs, shingle=k)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_near_duplicates_of_a_hot_group(spark):
    """Hundreds of variants of a text, some too far from it: pairs are settled in blocks."""
    import random

    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 4, 5))):
            w[rng.randrange(60)] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    want = groups(rows, 2)
    _, found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2)
    assert {r["id"]: (r["n"], r["component_id"]) for r in found.collect()} == want


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (7, 9), (9, 9), (5, 4), *((20, 21 + i) for i in range(50)), (70, 21), (70, 6)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {n: 1 for n in (2, 3, 4, 5)} | {8: 7, 9: 7} | {n: 6 for n in (20, 70, *range(21, 71))}
    assert got == want


def test_flag(spark, corpus):
    rows = dict(corpus)
    item = rows[25]
    w = item.split(" ")
    edited = " ".join(x for i, x in enumerate(w) if i % 9 != 4)
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "zebra quagga"), (5, item)], "item_id long, text string")
    more = [(1000, "before it " + "".join(c.upper() if c.isascii() else c for c in item) + " and after"), (1001, edited), (1002, "a Zebra, quagga!"), (1003, None), (1004, "zebra"), (None, item)]
    docs = spark.createDataFrame([*corpus, *more], "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["m"]["item"]): r["m"] for r in flag(docs, bench).select("doc_id", F.explode("matches").alias("m")).collect()}
    same = {i for i, t in corpus if t and t.lower() == item.lower()}
    assert {k for k in got if k[0] is None or k[0] >= 1000 or k[0] in same} == {
        *((d, i) for d in (25, 1000, 1001, None, *same) for i in (1, 5)), (1002, 4)}
    assert {k[0] for k in got if k[0] is not None and k[0] < 1000} == same
    assert got[(1000, 1)]["score"] == 1.0 and (got[(1000, 1)]["start"], got[(1000, 1)]["end"]) == (2, 2 + len(w))


def test_empty_tables(empty, docs):
    assert substring_dedup(empty).count() == 0
    assert remove_matches(empty).count() == 0
    assert keep_one(empty).count() == 0
    assert flag(empty, docs.select(F.col("doc_id").alias("item_id"), "text")).count() == 0
    none = flag(docs, empty.select(F.col("doc_id").alias("item_id"), "text"))
    assert none.where(F.size("matches") > 0).count() == 0 and none.count() == docs.count()


def test_hash_of_kept_text(docs, corpus):
    """The digest column of the query's contract."""
    r = substring_dedup(docs).where("doc_id = 8").select(F.sha2(F.col("text").cast("binary"), 256).alias("h")).first()
    assert r["h"] == hashlib.sha256(" ".join(words(dict(corpus)[8])).encode()).hexdigest()
