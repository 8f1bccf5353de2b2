"""Input columns that have the name of an output keep their values."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gazetta.llm import byte_bpe, decontaminate, pu_quality, quality_rules, run_index, substring_dedup, token_files

NAMES = ["score", "quality", "n_words", "n_removed", "removed", "matches", "n_bytes", "ids", "decoded", "part", "start",
         "n_tokens", "__stratum", "__cutoffs", "__part", "__before", "ids_crc32"]


@pytest.fixture(scope="module")
def crowded(spark):
    rows = [(i, f"some words of text number {i} and more of them", "en") for i in range(12)] + [(12, None, None), (13, "", "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return frame.select("*", *((F.col("doc_id") * 10 + j).cast("int").alias(c) for j, c in enumerate(NAMES)))


def kept(out, renamed=()):
    """Every column of ``crowded`` still has its values."""
    got = out.collect()
    assert sorted(r["doc_id"] for r in got) == list(range(14))
    for r in got:
        for j, c in enumerate(NAMES):
            assert r[c + "_" if c in renamed else c] == r["doc_id"] * 10 + j, c
    return {r["doc_id"]: r for r in got}


def test_scores(spark, crowded):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, quality int")
    got = kept(pu_quality.score_quality(crowded, labels, F.col("doc_id") < 9))
    assert all(0 <= r["score_"] <= 1 for r in got.values())


def test_rules(spark, crowded):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    got = kept(quality_rules.apply_rules(crowded, labels))
    assert got[12]["quality_"]["n_words"] == 0 and got[1]["quality_"]["n_words"] == 10


def test_passages(crowded):
    got = kept(substring_dedup.substring_dedup(crowded, window=15))
    assert (got[1]["n_words_"], got[1]["n_removed_"], got[12]["n_words_"]) == (10, 0, 0)


def test_bytes(crowded):
    got = kept(run_index.remove_matches(crowded, length=24))
    assert got[1]["n_bytes_"] == len("some words of text number 1 and more of them") and got[12]["n_bytes_"] == 0
    assert got[0]["n_removed_"] == 0 and got[1]["n_removed_"] > 0


def test_benchmark_items(spark, crowded):
    bench = spark.createDataFrame([(5, "some words of text number 4 and more of them")], "item_id long, text string")
    got = kept(decontaminate.flag(crowded, bench))
    assert [m["item"] for m in got[4]["matches_"]] == [5] and got[12]["matches_"] == []


def test_tokens(crowded):
    path = byte_bpe.production_path()
    got = kept(byte_bpe.encode(crowded, path, decoded="decoded"))
    again = byte_bpe.encode(crowded.drop("decoded").withColumn("copy", F.col("text")), path, text_col="copy")
    assert bytes(got[3]["decoded_"]).decode() == "some words of text number 3 and more of them"
    back = byte_bpe.decode(again.withColumn("decoded", F.lit(1)), path, ids_col="ids_").collect()
    assert all(r["decoded"] == 1 and bytes(r["decoded_"]).decode() == (r["text"] or "") for r in back)


def test_token_files(spark, crowded, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(crowded, path, public_tokenizers.path("byte_bpe_50k.json"), order_col="start")
    back = token_files.read_tokens(spark, path)
    got = kept(back, renamed=token_files.FORMAT)
    assert got[12]["ids"] == [token_files.END_ID] and got[0]["start"] == 0
    assert [got[i]["start"] for i in range(1, 14)] == [got[i]["start"] + got[i]["n_tokens"] for i in range(13)]
    assert kept(token_files.with_crc32(back).withColumnRenamed("ids_", "ids"), renamed=("part", "start", "n_tokens"))[12]["ids_crc32_"] > 0
