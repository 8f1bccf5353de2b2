"""Physical-plan properties that matter at scale."""

import pytest

from gazetta.plans import driver, driver_build

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "MapInArrow", "PythonUDF", "AggregateInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


QUERIES = {**driver.QUERIES, **driver_build.QUERIES}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_query(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert not any(n in p for n in PYTHON_NODES), p


def test_alt_names_plan(spark):
    df = driver.q_alt_names(spark, SF)
    p = plan(df)
    # language lookup is broadcast, never shuffled against the names
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    # languages are counted in one partially aggregated state: rows are exchanged once
    assert "partial_approx_top_k" in p
    assert p.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(id" in p
    # column pruning reaches the scan: only the three used columns are read
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in df._jdf.queryExecution().executedPlan().treeString()


def test_dedupe_rows_are_not_shuffled(spark):
    p = plan(driver.q_dedupe_places(spark, SF))
    # the duplicate-group statistics were materialised and broadcast: the rows are
    # filtered where they are, with one join and no shuffle at all
    assert p.count("Join") == 1 and "BroadcastHashJoin" in p
    assert "Exchange hashpartitioning" not in p and "SortMergeJoin" not in p


def test_dedupe_statistics_are_hash_aggregated(spark):
    from pyspark.sql import functions as F

    from gazetta.operators import dedup

    places = driver.part_places(spark, SF)
    m, i = F.col("pop"), F.col("id")
    hi = F.max(m.cast("long") * F.lit(1 << 32) + i.cast("long")).alias("hi")
    p = plan(dedup._group_stats(places, driver.PLACE_KEYS, [hi]))
    assert "SortAggregate" not in p and "partial_max" in p


def test_dimension_joins_are_broadcast(spark):
    for q in (driver.q_disamb_code, driver.q_reassign_orphans, driver.q_enrich_lookup):
        p = plan(q(spark, SF))
        assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p


def test_dense_ids_come_from_the_files(spark):
    p = plan(driver.q_surrogate_ids(spark, SF))
    # rows come from the range-partitioned copy, written once, and are not shuffled
    # again; only counts (one row a file) meet in a single partition
    assert "Scan ExistingRDD" not in p and "rangepartitioning" not in p and "SortMergeJoin" not in p
    assert p.count("Exchange SinglePartition") == 1
    assert p.count("Exchange hashpartitioning") == 1 and "partial_count" in p


def test_dense_ids_read_only_what_is_needed(spark):
    from gazetta.operators.keys import assign_dense_ids

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan(assign_dense_ids(orders, ["o_orderkey"]).select("id", "o_custkey"))
    schemas = [line.split("ReadSchema: ")[1] for line in p.splitlines() if "ReadSchema: " in line]
    # the counts come from the footers alone; the row index is the reader's own
    assert sorted(schemas) == ["struct<>", "struct<o_custkey:bigint,_tmp_metadata_row_index:bigint>"]


def test_words_of_lines_are_the_words_of_the_text(spark, tmp_path):
    """Tabs, carriage returns, runs of blanks, empty and missing texts; no regular expression, no lambda per line."""
    from gazetta.plans.driver import doc_word_alternates

    texts = ["a b", " a\tb\r\nc ", "\n\n", "", None, "\ta\t\t b", "a\r", "x\u000by  z", "one", "\r", " \n\t\r "]
    rows = [(i, t, "en" if i % 2 else "es") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = doc_word_alternates(spark, str(tmp_path))
    whole = spark.read.parquet(str(tmp_path / "documents.parquet")).selectExpr("doc_id", "explode(split(text, '[ \t\n\r]+')) AS word")
    assert sorted((r["geoname_id"], r["alternate_name"]) for r in got.collect()) == sorted(map(tuple, whole.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "]+" not in plan, plan


def test_words_per_task_are_bounded(spark, monkeypatch):
    """The tasks that count words follow the text, whatever sizes AQE aims at."""
    monkeypatch.setattr(driver, "TEXT_PER_TASK", 10_000, raising=False)
    size = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("sum(octet_length(text))").first()[0]
    words = driver.doc_word_alternates(spark, SF)
    sizes = [r["n"] for r in words.selectExpr("spark_partition_id() AS p", "octet_length(alternate_name) AS n").groupBy("p").sum("n").toDF("p", "n").collect()]
    assert size > 50_000 and len(sizes) == max(-(-size // 10_000), spark.sparkContext.defaultParallelism) and max(sizes) < 15_000
