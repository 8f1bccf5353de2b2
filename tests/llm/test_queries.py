"""The registered queries of the subpackage: contracts, and DuckDB twins where SQL can express them."""

import duckdb
import pytest

import __spark_entry__ as entry
from gazetta.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_an_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    columns = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, res.fetchall()))


COLUMNS = {
    "op1": {"doc_id", "held_out", "score", "predicted"},
    "op2": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op6": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op7": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op8": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op10": {"doc_id", "n_shingles", "component_id", "kept"},
}


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q.split("_")[0] in COLUMNS))
def test_one_row_a_document(spark, name):
    df = QUERIES[name](spark, SF)
    assert COLUMNS[name.split("_")[0]] <= set(df.columns)
    ids = [r["doc_id"] for r in df.collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
