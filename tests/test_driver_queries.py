"""Every registered query against its DuckDB oracle on the smallest tables."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from gazetta.operators import lookup
from gazetta.plans import driver, driver_build

QUERIES = {**driver.QUERIES, **driver_build.QUERIES}
ORACLE = {**driver.ORACLE, **driver_build.ORACLE}

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.6g}"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def check(spark, duck, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    check(spark, duck, name)


@pytest.mark.parametrize("name", [
    "alt_names", "attach_alternates", "city_names", "countries", "country_names", "curate_cities", "dedupe_places", "disamb_code",
    "drop_ambiguous", "drop_min_id_dups", "drop_smaller_dups", "enrich_lookup", "enrich_lookup_first_match", "missing_default_country",
    "region_members"])
def test_query_matches_oracle_by_shuffles_only(spark, duck, name, monkeypatch):
    """No side passes a size check, and AQE broadcasts nothing."""
    monkeypatch.setattr(lookup, "_fits", lambda *a: False)
    monkeypatch.setattr(driver, "_DIM_SMALL", {})
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        check(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
