"""The whole build on dumps derived from the driver tables (sf0.001)."""

import os

from pyspark.sql import functions as F

from gazetta.plans.dump import write_dump
from gazetta.plans.gazetteer import FILES, build_gazetteer
from gazetta.sources.geonames import read_alt_names


def test_build_on_derived_dump(spark, tmp_path):
    data = write_dump(spark, "/root/testdata/sf0.001", str(tmp_path / "dump"))
    out = build_gazetteer(spark, data, str(tmp_path / "out"))
    for name in ("src.cities", "src.city_names", "src.country_names", "geo.alt_names"):
        assert out[name].count() > 0, name
    cities = out["src.cities"]
    assert cities.groupBy("id").count().where("count > 1").count() == 0
    # no duplicated (name, area, country) group survives with two rows unless ids tie-break left it
    names = out["src.city_names"]
    ids = [r[0] for r in names.select("id").orderBy("id").collect()]
    assert ids == list(range(1000001, 1000001 + len(ids)))
    # every surviving ambiguous alternate with a known country is a default name
    amb = names.groupBy("country_name", "alt_name").count().where("count > 1 AND country_name IS NOT NULL")
    bad = names.join(amb, ["country_name", "alt_name"]).where(F.col("alt_name") != F.col("city_name"))
    assert bad.count() == 0
    # HK cities were re-homed to China; HK is gone from the countries
    assert out["src.countries"].where(F.col("iso_code") == "HK").count() == 0
    assert cities.where(F.col("country_code") == "HK").count() == 0
    # the reduced build (alternates semi-joined with place ids) gives the same names
    out2 = build_gazetteer(spark, data, str(tmp_path / "out2"), keep_all_alt_names=False)
    cols = ["city_id", "alt_name", "langlist"]
    assert sorted(map(tuple, out2["src.city_names"].select(cols).collect())) == sorted(
        map(tuple, names.select(cols).collect()))


def test_dumped_words_read_back_as_they_are(spark, tmp_path):
    """Quotes anywhere, control characters at the ends, a language with a tab, missing values."""
    source = "/root/testdata/sf0.001"
    (tmp_path / "in").mkdir()
    for t in ("region", "nation", "customer", "events"):
        os.symlink(f"{source}/{t}.parquet", tmp_path / "in" / f"{t}.parquet")
    text = '"A "B" C"D "" " \x1fE\x1f \x0bF\x0b G\\ \u00a0H\u00a0 #I -J'
    docs = [(30, text, "en", "src0"), (31, text, None, "src1"), (32, text, "a\tb", "src2"), (33, "", "en", "src3"), (34, None, "en", "src0")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "in" / "documents.parquet"))
    dump = write_dump(spark, str(tmp_path / "in"), str(tmp_path / "dump"))
    got = read_alt_names(spark, os.path.join(dump, FILES["alt_names"])).collect()
    words = [w for w in text.split(" ")]
    want = [(i, lang, w) for i, lang in ((30, "en"), (31, None), (32, "a\tb")) for w in words] + [(33, "link", None)]
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["geoname_id"], r["iso_language"], r["alternate_name"]) for r in got), key=key) == sorted(want, key=key)
    assert len({r["alternate_name_id"] for r in got}) == len(want)


def test_dump_is_compressed_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    """The text of the dump is several times its words; a compressed file can't be split among tasks."""
    from gazetta.plans import dump as module

    monkeypatch.setattr(module, "ROWS_PER_FILE", 700, raising=False)
    data = write_dump(spark, "/root/testdata/sf0.001", str(tmp_path / "dump"))
    for name in FILES.values():
        parts = [x for x in os.listdir(os.path.join(data, name)) if x.startswith("part-")]
        assert parts and all(x.endswith(".lz4") for x in parts), name
    rows = spark.read.text(os.path.join(data, FILES["alt_names"]))
    sizes = [r["count"] for r in rows.groupBy(F.col("_metadata.file_name")).count().collect()]
    assert max(sizes) <= 700 < sum(sizes)
    text = rows.select(F.sum(F.octet_length("value") + 1)).first()[0]
    assert sum(os.path.getsize(os.path.join(data, FILES["alt_names"], x)) for x in os.listdir(os.path.join(data, FILES["alt_names"]))) < 0.7 * text
