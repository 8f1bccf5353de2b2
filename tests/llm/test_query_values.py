"""Registered queries that SQL can't express, value by value against plain versions."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from cases import lower, words
from test_texts import groups
from tokenizers import Tokenizer

from gazetta.llm import byte_bpe
from gazetta.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    return dict(sorted(zip(table["doc_id"].to_pylist(), table["text"].to_pylist())))


def rows(spark, number, *columns):
    (name,) = [q for q in QUERIES if q.startswith(f"op{number}_")]
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF).collect()}


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_context_mixing_base(spark, texts):
    tokens = {d: [*words(lower(t)), None] for d, t in texts.items()}
    held_out = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    count = Counter(w for d, ws in tokens.items() if not held_out[d] for w in ws)
    n, v = sum(count.values()), len(count)
    got = rows(spark, 2, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    assert set(got) == set(texts)
    for d, ws in tokens.items():
        assert got[d][:4] == (held_out[d], len(ws), sum(count[w] > 0 for w in ws), n)
        assert got[d][4] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
        assert got[d][5] < 0


def test_run_index(spark, texts):
    got = rows(spark, 6, "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert set(got) == set(texts)
    seen = set()
    for d, t in texts.items():
        b = (t or "").encode()
        strings = [b[i: i + 50] for i in range(len(b) - 49)]
        gone = np.zeros(len(b), bool)
        for i, s in enumerate(strings):
            if s in seen:
                gone[i: i + 50] = True
        seen.update(strings)
        spans = int((gone & ~np.concatenate([[False], gone])[: len(b)]).sum())
        assert got[d] == (len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())), d


def test_byte_bpe(spark, texts):
    with open(byte_bpe.production_path(), "rb") as f:
        ranks = byte_bpe.read_ranks(f.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(spark, 7, "n_tokens", "ids_sha256", "decoded_sha256")
    ids = {d: library.encode_ordinary(t or "") for d, t in texts.items()}
    assert got == {d: (len(x), sha(",".join(map(str, x)).encode()), sha((texts[d] or "").encode())) for d, x in ids.items()}


def test_token_files(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, start = {}, 0
    for d, t in texts.items():
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        expected[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert rows(spark, 8, "start", "n_tokens", "ids_crc32") == expected


def test_near_duplicates(spark, texts):
    expected = {d: (size, root, d == root) for d, (size, root) in groups(list(texts.items()), 2).items()}
    assert rows(spark, 10, "n_shingles", "component_id", "kept") == expected
