"""Table layouts: what a join moves, what a lookup reads, the order of files."""

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from gazetta.operators.names import attach_alternates
from gazetta.plans import gazetteer
from gazetta.sources.layout import find_names, in_order, read_clustered, write_clustered, write_name_index

from fixture_dump import write_dump


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def alternates(spark, n=5000):
    return spark.range(n).select((F.col("id") % 700).cast("int").alias("id"), F.concat(F.lit("name "), F.col("id")).alias("alt_name"), F.lit("English").alias("langs"))


def test_attaching_moves_only_the_entities(spark, scratch):
    path = os.path.join(scratch, "alts")
    stored = write_clustered(alternates(spark), path, ["id"], 6, ["id", "alt_name"])
    assert len(glob.glob(f"{path}/part-*")) == 6
    cities = spark.range(1000).select(F.col("id").cast("int").alias("city_id"))
    for alts in (stored, read_clustered(spark, path)):
        joined = attach_alternates(cities, alts, entity_id="city_id", max_broadcast_rows=0)
        p = plan(joined)
        assert p.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(city_id" in p
        assert "Bucketed: true" in joined._jdf.queryExecution().toString() or "SelectedBucketsCount" in p
        plain = attach_alternates(cities, alternates(spark), entity_id="city_id")
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))


def rows_scanned(df):
    """Rows that the scan of a plan put out when it ran."""
    q = df._jdf.queryExecution()
    p = q.executedPlan()
    p.executeCollect()
    while p.children().size():
        p = p.children().apply(0)
    return p.metrics().apply("numOutputRows").value()


def test_lookup_reads_few_row_groups(spark, scratch):
    path = os.path.join(scratch, "index")
    names = spark.range(200_000).select(F.col("id"), F.concat(F.lit("place "), F.sha1(F.col("id").cast("string"))).alias("alt_name"))
    index = write_name_index(names, path, row_group_bytes=64 << 10, page_bytes=8 << 10)
    groups = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/part-*")]
    assert sum(m.num_row_groups for m in groups) > 50
    texts = names.where(F.col("id") % 20_000 == 5).select(F.concat(F.lit("  "), "alt_name", F.lit(".")).alias("text"))
    found = find_names(index, texts, "text")
    assert sorted(r["id"] for r in found.collect()) == [5 + 20_000 * k for k in range(10)]
    assert rows_scanned(found) < 200_000 / 4
    absent = find_names(index, spark.createDataFrame([("place of nowhere",), (None,)], "text string"), "text")
    assert absent.collect() == []
    assert find_names(index, texts.limit(0), "text").collect() == []


def test_many_names_are_joined(spark, scratch, monkeypatch):
    from gazetta.sources import layout

    index = write_name_index(alternates(spark), os.path.join(scratch, "index"))
    texts = alternates(spark, 300).select("alt_name")
    few = sorted(map(tuple, find_names(index, texts, "alt_name").collect()))
    monkeypatch.setattr(layout, "LOOKUP_NAMES", 10)
    joined = find_names(index, texts, "alt_name")
    assert "Join" in plan(joined) and sorted(map(tuple, joined.collect())) == few and len(few) == 300


def files_in_order(path):
    return [r for f in sorted(glob.glob(f"{path}/part-*")) for r in pq.read_table(f).to_pylist()]


def test_files_ascend(spark, scratch):
    df = alternates(spark).withColumn("key", F.xxhash64("alt_name"))
    path = os.path.join(scratch, "ordered")
    in_order(df.repartition(5), ["key"]).write.parquet(path)
    keys = [r["key"] for r in files_in_order(path)]
    assert keys == sorted(keys) and len(keys) == 5000


def test_build_layouts(spark, scratch):
    data = os.path.join(scratch, "data")
    write_dump(data)
    out = gazetteer.build_gazetteer(spark, data, os.path.join(scratch, "out"), alternate_buckets=4, index_names=True)
    root = out["src.countries"].inputFiles()[0].removeprefix("file://").rsplit("/", 3)[0]
    codes = [(r["code"], r["code_type"], r["name"]) for r in files_in_order(f"{root}/src/lang_codes")]
    assert codes == sorted(codes)
    names = [r["country_name"] for r in files_in_order(f"{root}/src/countries")]
    assert names == sorted(names) and names
    again = gazetteer.load_gazetteer(spark, os.path.join(scratch, "out"))
    plain = gazetteer.build_gazetteer(spark, data, os.path.join(scratch, "plain"))
    for table in ("geo.alt_names", "src.city_names"):
        assert sorted(map(str, again[table].collect())) == sorted(map(str, plain[table].collect()))
    assert len(glob.glob(f"{root}/geo/alt_names/part-*")) <= 4
    one = plain["src.city_names"].select(F.upper("alt_name").alias("x")).limit(0)
    assert find_names(again["src.city_names_by_name"], one, "x").collect() == []
    some = plain["src.city_names"].select("alt_name")
    assert find_names(again["src.city_names_by_name"], some, "alt_name").count() == plain["src.city_names"].count()
