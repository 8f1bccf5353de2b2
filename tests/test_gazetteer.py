"""Whole build on the golden example of FIXTURES.md (part B)."""

import os

import pytest

from fixture_dump import write_dump
from gazetta.plans.gazetteer import build_gazetteer


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("gaz")
    data = write_dump(str(base / "data"))
    return {
        "latin": build_gazetteer(spark, data, str(base / "out_latin")),
        "all": build_gazetteer(spark, data, str(base / "out_all"), include_nonlatin=True),
    }


def test_lang_codes(built):
    got = rows(built["latin"]["src.lang_codes"], "code", "name", "code_type")
    assert got == [
        ("afa", "Afro-Asiatic languages", "639-2"), ("de", "German", "639-1"), ("deu", "German", "639-3"),
        ("en", "English", "639-1"), ("eng", "English", "639-3"), ("fr", "French", "639-1"),
        ("fra", "French", "639-3"),
    ]


def test_countries(built):
    got = rows(built["latin"]["src.countries"], "country_name", "rank", "languages")
    assert got == [("China", 1, None), ("Liechtenstein", 2, None), ("United Kingdom", 1, None),
                   ("Zimbabwe", 1, None)]


def test_country_names(built):
    got = rows(built["latin"]["src.country_names"], "country_name", "alt_name", "langlist")
    assert got == sorted([
        ("United Kingdom", "United Kingdom", "English"), ("China", "China", "English"),
        ("Zimbabwe", "Simbabwe", "German"), ("Zimbabwe", "Zimbabwe", ""),
        ("Liechtenstein", "Liechtenstein", ""),
    ])
    got_all = rows(built["all"]["src.country_names"], "country_name", "alt_name", "langlist")
    assert ("Zimbabwe", "Zimbabwe", "English") in got_all and ("Zimbabwe", "Zimbabwe", "") not in got_all
    ids = [r["id"] for r in built["latin"]["src.country_names"].collect()]
    assert sorted(ids) == list(range(10001, 10001 + len(ids)))


def test_cities(built):
    got = rows(built["latin"]["src.cities"], "id", "name", "disamb_type", "disamb_id", "disamb_code",
               "disamb_name", "country_id", "country_code", "country_name")
    uk, cn = (2635167, "GB", "United Kingdom"), (1814991, "CN", "China")
    assert got == [
        (1, "St. Ives", "admin2", 11609029, "GB.ENG.C6", "Cornwall", *uk),
        (2, "Newport", "admin2", 2641599, "GB.WLS.X1", "Newport City", *uk),
        (4, "Kowloon", "admin1", 7533607, "HK.KKC", "Kowloon City (HK)", *cn),
        (6, "Twin", "admin1", 2038349, "CN.22", "Beijing", *cn),
        (7, "Twin", "admin1", 2038349, "CN.22", "Beijing", *cn),
        (10, "Lone", "admin1", None, "CN.99", None, *cn),
        (11, "Lone", "admin1", None, "CN.99", None, *cn),
        (12, "Nowhere", "none", None, None, None, None, "none", None),
        (13, "Leeds", "admin2", None, "none.H3", None, *uk),
        (14, "York", "admin2", None, None, None, *uk),
        (15, "O’Town", "admin1", 3042074, "LI.01", "Balzers", 3042058, "LI", "Liechtenstein"),
        (16, "Taipa", "admin1", None, None, None, *cn),
    ]


def test_city_names(built):
    got = rows(built["latin"]["src.city_names"], "city_id", "alt_name", "langlist")
    expected = [
        (1, "St Ives", "English, French"), (1, "St. Ives", None), (2, "Newport", "English"),
        (2, "Casnewydd", None), (4, "Kowloon", "English"), (6, "Twin", "English"), (7, "Twin", "English"),
        (11, "Lone", "English"), (12, "Utopia", None), (12, "Nowhere", None), (15, "O’Town", "German"),
    ]
    assert got == sorted(expected, key=lambda r: (r[0], r[1]))
    got_all = rows(built["all"]["src.city_names"], "city_id", "alt_name", "langlist")
    more = expected + [(4, "九龍", None), (10, "Zed", "English"), (10, "Lone", None)]
    assert got_all == sorted(more, key=lambda r: (r[0], r[1]))
    ids = [r["id"] for r in built["latin"]["src.city_names"].collect()]
    assert sorted(ids) == list(range(1000001, 1000001 + len(ids)))


def test_regions(built):
    got = rows(built["latin"]["src.regions"], "id", "feature_code", "name", "members")
    assert got == [(901, "RGN", "Scandinavia", "DK,NO,SE"), (902, "CONT", "Europe", None)]


def test_tables_written(built):
    from gazetta.plans.gazetteer import TABLES

    assert set(built["latin"]) == set(TABLES)
    assert all(df.count() > 0 for df in built["latin"].values())


def test_cli_publishes_and_loads(spark, tmp_path):
    from gazetta.__main__ import main
    from gazetta.plans.gazetteer import load_gazetteer

    data = write_dump(str(tmp_path / "data"))
    out = str(tmp_path / "out")
    assert main(["--data", data, "--out", out]) == 0
    first = load_gazetteer(spark, out)
    assert first["src.city_names"].count() == 11
    # a second run with -n is published over it; the first run stays on disk untouched
    assert main(["--data", data, "--out", out, "-n"]) == 0
    second = load_gazetteer(spark, out)
    assert second["src.city_names"].count() == 14
    assert len(os.listdir(os.path.join(out, "runs"))) == 2
    assert load_gazetteer(spark, out)["geo.alt_names"].count() > first["geo.alt_names"].count()
    assert not [d for d, _, _ in os.walk(out) if d.endswith("_landed")]
    # retention: a third run keeps itself and the newest other
    assert main(["--data", data, "--out", out, "--keep-runs", "2"]) == 0
    assert len(os.listdir(os.path.join(out, "runs"))) == 2


def test_failure_before_publishing_keeps_the_last_run(spark, tmp_path, monkeypatch):
    from gazetta.plans import gazetteer

    data = write_dump(str(tmp_path / "data"))
    out = str(tmp_path / "out")
    gazetteer.build_gazetteer(spark, data, out)
    monkeypatch.setattr(gazetteer, "publish_run", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        gazetteer.build_gazetteer(spark, data, out, include_nonlatin=True)
    assert gazetteer.load_gazetteer(spark, out)["src.city_names"].count() == 11


def test_reduced_alternates_have_their_own_name(spark, tmp_path):
    from gazetta.plans.gazetteer import build_gazetteer, load_gazetteer

    data = write_dump(str(tmp_path / "data"))
    built = build_gazetteer(spark, data, str(tmp_path / "out"), keep_all_alt_names=False)
    assert "geo.alt_names" not in built and "geo.used_alt_names" in load_gazetteer(spark, str(tmp_path / "out"))


def test_build_keeps_the_job_group(spark, tmp_path):
    from gazetta.plans.gazetteer import build_gazetteer

    data = write_dump(str(tmp_path / "data"))
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    spark.sparkContext.setJobGroup("gazetteer-build", "the whole build")
    try:
        build_gazetteer(spark, data, str(tmp_path / "out"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tracker.getJobIdsForGroup("gazetteer-build")
    assert set(tracker.getJobIdsForGroup(None)) <= before
