"""Periodic runs against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from cases import TRICKY, words

from gazetta.llm.periodic_runs import collapse_runs, lyndon_groups, text_runs
from gazetta.llm.util import Words, text_bytes


def lyndon(s):
    """Lengths of the longest Lyndon words: up to the next smaller suffix."""
    return [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]


def test_lyndon_arrays_of_both_orders():
    rng = random.Random(1)
    for _ in range(150):
        strings = [[rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(1, 40))] for _ in range(rng.randint(1, 6))]
        strings += [[9 - x for x in s] for s in strings]
        first = np.append(0, np.cumsum([len(s) for s in strings]))
        length, group = lyndon_groups(np.array(sum(strings, [])), first)
        assert length.tolist() == [n for s in strings for n in lyndon(s)]
        for k, s in enumerate(strings):  # one group for one Lyndon word
            g = group[first[k]: first[k + 1]]
            at = length[first[k]: first[k + 1]]
            of = {tuple(s[i: i + at[i]]): g[i] for i in range(len(s))}
            assert all(of[tuple(s[i: i + at[i]])] == g[i] for i in range(len(s))) and len(set(of.values())) == len(of)


def brute(s, least, exponent):
    found = []
    for q in range(1, len(s) // exponent + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            size = j - i + q
            run = s[i: i + size]
            if j > i and size >= max(least, exponent * q) and not any(run[x:] == run[:-x] for x in range(1, q)):
                found.append((i, size, q))
            i = j + 1
    return sorted(found)


def periodic_text(rng, n):
    s = []
    while len(s) < n:
        s += [rng.choice("abcd") for _ in range(rng.randint(1, 9))] * rng.randint(1, 6) + [rng.choice("abcdefgh") for _ in range(rng.randint(0, 5))]
    return s


@pytest.mark.parametrize("least,exponent", [(24, 3), (4, 3), (9, 3), (10, 4), (24, 5)])
def test_runs(least, exponent):
    rng = random.Random(least)
    for _ in range(80):
        texts = [periodic_text(rng, rng.randint(0, 90)) for _ in range(rng.randint(1, 5))]
        w = Words(*text_bytes(pa.array([" ".join(t) for t in texts])))
        assert [tuple(r) for r in text_runs(w, least, exponent).tolist()] == [(k, *r) for k, t in enumerate(texts) for r in brute(t, least, exponent)]


def test_collapse(spark):
    rng = random.Random(5)
    texts = [*TRICKY, "x " * 40, "\n".join(["same line here"] * 20), " ".join(periodic_text(rng, 300)), " ".join(periodic_text(rng, 9000)), "a" * 100_000]
    texts += [texts[-2]] * 3  # repeated rows
    rows = [(i % 7 if i % 5 else None, t, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3)  # `runs` clashes
    out = collapse_runs(df)
    assert out.columns == ["doc_id", "text", "runs", "n_words", "runs_", "collapsed"]
    got = {r["runs"]: r for r in out.collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        w, r = words(t), got[i]
        expected = brute(w, 24, 3) if len(w) < 1000 else [tuple(x) for x in r["runs_"]]
        assert (r["doc_id"], r["text"], r["n_words"]) == (rows[i][0], t, len(w))
        assert [tuple(x) for x in r["runs_"]] == expected
        gone = {k for s, n, q in expected for k in range(s + q, s + n)}
        assert r["collapsed"] == " ".join(x for k, x in enumerate(w) if k not in gone)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert collapse_runs(empty).collect() == []
    with pytest.raises(ValueError):
        collapse_runs(empty, min_exponent=2)


def test_a_long_text_of_one_period(spark):
    n = 120_000
    df = spark.createDataFrame([(1, "tick tock " * (n // 2))], "doc_id long, text string")
    r = collapse_runs(df).first()
    assert [tuple(x) for x in r["runs"]] == [(0, n, 2)] and r["collapsed"] == "tick tock"
