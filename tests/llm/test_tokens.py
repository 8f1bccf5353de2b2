"""Tokenizers and archives against their libraries and exact round trips."""

import gzip
import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gazetta.llm import byte_bpe, token_files, warc

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def hard(spark, corpus):
    more = ["a" * 301, "ab" * 200, "x" * 3000, "  x  \n\n y", " \t  \r\n ", "\x1c\x1d a\x85b 　c", " !", "a  !b", "\n b\n  c", "'s's 'll(x)'s"]
    end = "<|endoftext|>"
    more += [end, end * 3, f"{end} a b", f"a {end} b", f"a b {end}", f"a{end}b\n {end}", f"<|endoftext{end}|>", "<|endoftext|", "|> b", f"é{end}é " * 50]
    rows = [*corpus, *((1000 + i, t) for i, t in enumerate(more))]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_encode_and_decode(hard):
    rows, df = hard
    with open(BPE, "rb") as f:
        ranks = byte_bpe.read_ranks(f.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in byte_bpe.encode(df, BPE, decoded="back").collect()}
    for i, t in rows:
        assert got[i]["ids"] == library.encode_ordinary(t or ""), repr(t)[:80]
        assert bytes(got[i]["back"]) == (t or "").encode()
    back = byte_bpe.decode(byte_bpe.encode(df, BPE), BPE)
    assert {r["doc_id"]: bytes(r["decoded"]) for r in back.collect()} == {i: (t or "").encode() for i, t in rows}


def test_encode_a_long_run_of_mixed_letters():
    """A match of 100,000 bytes, among others, stays within the database's memory."""
    with open(BPE, "rb") as f:
        data = f.read()
    rng = np.random.default_rng(8)
    run = lambda n, letters: "".join(rng.choice(list(letters), n))
    words = [run(100_000, "acgt"), run(20_000, "abcdefghijklmnopqrstuvwxyz"), "x" * 500, run(60, "ab")]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(data), special_tokens={})
    ids, size = byte_bpe._Bpe(data)._matches(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == [library.encode_ordinary(w) for w in words]


def test_decode_rejects_unknown_ids(spark):
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([([1, 10**6],)], "ids array<int>"), BPE).collect()


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, hard, tmp_path, encoding):
    rows, df = hard
    library = Tokenizer.from_file(JSON)
    path = str(tmp_path / encoding)
    token_files.write_tokens(df.withColumn("part", F.lit("x")).drop("part"), path, JSON, encoding=encoding, row_group_bytes=1 << 20)
    got = {r["doc_id"]: r for r in token_files.with_crc32(token_files.read_tokens(spark, path)).collect()}
    start = 0
    for i, t in sorted(rows):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert (got[i]["start"], got[i]["n_tokens"]) == (start, len(ids))
        assert got[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    column = pq.ParquetFile(os.path.join(path, files[0])).metadata.row_group(0)
    ids = next(column.column(i) for i in range(column.num_columns) if column.column(i).path_in_schema.startswith("ids"))
    assert any(("DELTA" in e) if encoding == "delta" else ("DICTIONARY" in e) for e in ids.encodings)
    assert ids.has_offset_index and ids.has_column_index


def test_token_files_of_an_empty_table(spark, empty, tmp_path):
    token_files.write_tokens(empty.select("doc_id", "text"), str(tmp_path / "t"), JSON)
    assert token_files.read_tokens(spark, str(tmp_path / "t")).count() == 0


def pages(spark):
    big = "<p>" + "x" * 2000
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, "small"), (4, "http://b/\r\nX: y", "small"), (5, "http://b/5", None),
            (6, "http://b/6", big + "é"), (7, "http://a/7", big), (None, "http://c", big)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_warc(spark, tmp_path):
    rows, df = pages(spark)
    path = str(tmp_path / "warc")
    warc.write_warc(warc.page_records(df), path)
    assert not os.path.exists(os.path.join(path, "_temporary"))
    got = {r["record_id"]: r for r in warc.read_warc(spark, path).collect()}
    assert len(got) == len(rows)
    for i, url, html in rows:
        r = got.get(f"urn:x-page:{i}" if i else None)
        data = (html or "").encode()
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == hashlib.sha1(data).hexdigest()
        again = i in (1, 2, None)
        assert r["record_type"] == ("revisit" if again else "response")
        assert r["refers_to"] == ("urn:x-page:7" if again else None)
        assert r["payload"] == (None if again else data)
    assert got["urn:x-page:3"]["target_uri"] is None
    # each record is a gzip member that any reader can open
    for f in os.listdir(path):
        with gzip.open(os.path.join(path, f)) as g:
            assert g.read().startswith(b"WARC/1.1\r\n")


def test_warc_predicates_and_splits(spark, tmp_path):
    rows, df = pages(spark)
    path = str(tmp_path / "warc")
    warc.write_warc(warc.page_records(df.coalesce(1)), path)
    plan = warc.read_warc(spark, path, payload=False, splitBytes=300).where("record_type = 'response' AND target_uri LIKE 'http://a/%' AND payload_bytes > 100")
    got = plan.collect()
    assert [r["record_id"] for r in got] == ["urn:x-page:7"] and got[0]["payload"] is None
    assert warc.read_warc(spark, path, splitBytes=50).count() == len(rows)
    assert warc.read_warc(spark, path).where("target_uri IS NULL").count() == 1
    reader = warc.WarcReader({"path": path, "payload": "false"})
    from pyspark.sql.datasource import EqualTo, Not
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), Not(EqualTo(("date",), "x"))]))
    assert len(left) == 1
    decoded = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in decoded) == 3


def test_foreign_warcs(spark, tmp_path):
    """Plain archives, and gzip ones without skip lengths."""
    parts = []
    for i in range(3):
        body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\nbody {i}".encode() * (1 if i else 1)
        parts.append(f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:{i}>\r\nContent-Type: application/http; msgtype=response\r\n"
                     f"Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n")
    for name, data in (("a.warc", b"".join(parts)), ("b.warc.gz", b"".join(gzip.compress(p) for p in parts))):
        folder = tmp_path / name
        folder.mkdir()
        (folder / name).write_bytes(data)
        got = warc.read_warc(spark, str(folder)).collect()
        assert [(r["record_id"], bytes(r["payload"])) for r in got] == [(f"urn:x:{i}", f"body {i}".encode()) for i in range(3)]
        assert warc.read_warc(spark, str(folder)).where("record_id = 'urn:x:1'").count() == 1


def test_warc_of_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_warc(warc.page_records(df), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0
