"""Operators on small hand-made frames with known answers."""

import pytest
from pyspark.sql import functions as F

from gazetta.operators.dedup import (
    dedupe_places,
    drop_ambiguous_alternates,
    drop_min_id_duplicates,
    drop_smaller_duplicates,
)
from gazetta.operators.keys import KeyViolation, assert_unique, assign_dense_ids, require_not_null
from gazetta.operators.lookup import broadcast_if_bounded, enrich_by_lookup
from gazetta.operators.names import (
    add_missing_defaults_by_entity,
    add_missing_defaults_by_name,
    aggregate_alt_names,
    attach_alternates,
)
from gazetta.operators.sets import drop_values, reassign, union_distinct
from gazetta.plans.tables import build_lang_codes

DUP_ROWS = [
    (1, "A", "d", "c", 5), (2, "A", "d", "c", 9), (3, "A", "d", "c", 9), (4, "A", None, "c", 1),
    (5, "A", None, "c", 2), (6, "B", "d", "c", None), (7, "B", "d", "c", None), (8, "C", "d", "c", 3),
    (9, "D", "d", "c", None), (10, "E", "d", "c", 4), (11, "E", "d", "c", 4), (12, "E", "d", "c", 4),
]
KEYS = ["name", "area", "country"]


@pytest.fixture()
def dups(spark):
    return spark.createDataFrame(DUP_ROWS, "id long, name string, area string, country string, pop int")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_drop_smaller_then_min_id(dups):
    p1 = drop_smaller_duplicates(dups, KEYS, "pop")
    assert ids(p1) == [2, 3, 4, 5, 8, 9, 10, 11, 12]
    assert ids(drop_min_id_duplicates(p1, KEYS, "id")) == [3, 4, 5, 8, 9, 11, 12]


def test_fused_dedupe_equals_two_passes(dups):
    assert ids(dedupe_places(dups, KEYS, "pop", "id")) == [3, 4, 5, 8, 9, 11, 12]


def test_min_id_alone(dups):
    # groups A/d/c (1,2,3), B (6,7), E (10,11,12) lose their smallest id
    assert ids(drop_min_id_duplicates(dups, KEYS, "id")) == [2, 3, 4, 5, 7, 8, 9, 11, 12]


def test_dedupe_hot_key(spark):
    # one key holding most rows: still exact, one winner per tie rule
    n = 20000
    df = spark.range(n).select(
        F.col("id"), F.lit("Hot").alias("name"), F.lit("a").alias("area"), F.lit("c").alias("country"),
        (F.col("id") % 7).cast("int").alias("pop"),
    )
    kept = ids(dedupe_places(df, KEYS, "pop", "id"))
    at_max = [i for i in range(n) if i % 7 == 6]
    assert kept == at_max[1:]


def test_enrich_lookup_no_fan_out(spark):
    target = spark.createDataFrame([(1, "x", None), (2, "y", None), (3, "z", None)],
                                   "id int, code string, label string")
    lookup = spark.createDataFrame([(20, "x", "second"), (10, "x", None), (30, "q", "other")],
                                   "lid int, code string, label string")
    out = enrich_by_lookup(target, lookup, on={"code": "code"}, assignments={"label": "label", "lid": "lid"},
                           order_by="lid")
    got = sorted(tuple(r) for r in out.collect())
    # lowest lookup id wins and its NULL label still overwrites
    assert got == [(1, "x", None, 10), (2, "y", None, None), (3, "z", None, None)]


def test_enrich_lookup_with_condition(spark):
    target = spark.createDataFrame([(1, "admin1", "A.1", "old"), (2, "admin2", "A.1", "old")],
                                   "id int, t string, code string, name string")
    lookup = spark.createDataFrame([(7, "A.1", "Area")], "aid int, code string, name string")
    out = enrich_by_lookup(target, lookup, on={"code": "code"}, assignments={"name": "name"},
                           order_by="aid", where=F.col("t") == "admin1")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "admin1", "A.1", "Area"), (2, "admin2", "A.1", "old")]


def test_broadcast_if_bounded(spark):
    small = spark.range(5)
    big = spark.range(50)
    assert "broadcast" in broadcast_if_bounded(small, 10)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in broadcast_if_bounded(big, 10)._jdf.queryExecution().analyzed().toString().lower()


def test_aggregate_alt_names_languages(spark):
    raw = spark.createDataFrame(
        [(1, "en", "Rome"), (1, "en", "Rome"), (1, "fr", "Rome"), (1, "xx", "Rome"), (1, None, "Roma"),
         (2, "link", "http://r"), (2, "it", " Roma. "), (3, "en", "zed"), (3, "de", "Zürich")],
        "geoname_id long, iso_language string, alternate_name string")
    codes = spark.createDataFrame(
        [("en", "English", "639-1"), ("fr", "French", "639-1"), ("de", "German", "639-1"),
         ("eng", "English", "639-3")], "code string, name string, code_type string")
    got = sorted(tuple(r) for r in aggregate_alt_names(raw, codes).collect())
    assert got == [(1, "Roma", None), (1, "Rome", "English, English, French"), (2, "Roma", None)]
    got_all = sorted(tuple(r) for r in aggregate_alt_names(raw, codes, latin_only=False).collect())
    assert (3, "Zürich", "German") in got_all and (3, "zed", "English") in got_all


def test_aggregate_alt_names_hot_group(spark):
    raw = spark.range(30000).select(
        F.lit(7).cast("long").alias("geoname_id"),
        F.when(F.col("id") % 3 == 0, "fr").otherwise("en").alias("iso_language"),
        F.lit("Paris").alias("alternate_name"))
    codes = spark.createDataFrame([("en", "English", "639-1"), ("fr", "French", "639-1")],
                                  "code string, name string, code_type string")
    (row,) = aggregate_alt_names(raw, codes).collect()
    parts = row["langs"].split(", ")
    assert parts == ["English"] * 20000 + ["French"] * 10000


def test_missing_defaults_modes(spark):
    names = spark.createDataFrame(
        [(1, "Aa", "Aa", "English"), (1, "Aa", "Ab", None), (2, "Bb", "Bc", "German")],
        "id int, name string, alt_name string, langlist string")
    city = add_missing_defaults_by_entity(names, ["id", "name"], "name")
    assert sorted(tuple(r) for r in city.collect()) == [
        (1, "Aa", "Aa", "English"), (1, "Aa", "Ab", None), (2, "Bb", "Bb", None), (2, "Bb", "Bc", "German")]
    ents = spark.createDataFrame([(1, "Aa"), (2, "Bb"), (3, "Cc")], "id int, name string")
    country = add_missing_defaults_by_name(names, ents, "id", "name", "id", "name")
    got = sorted(tuple(r) for r in country.collect())
    assert (2, "Bb", "Bb", "") in got and (3, "Cc", "Cc", "") in got and len(got) == 5


def test_drop_ambiguous(spark):
    names = spark.createDataFrame(
        [(1, "X", "Twin", "Twin"), (2, "X", "Twin", "Twin"), (1, "X", "Gem", "Twin"), (2, "X", "Gem", "Twin"),
         (3, None, "Gem", "Other"), (4, None, "Gem", "Other"), (5, "X", "Solo", "Five"), (6, "Y", "Gem", "Six"),
         (7, "Z", "Dup", None), (8, "Z", "Dup", None)],
        "id int, country string, alt_name string, city_name string")
    got = sorted(tuple(r) for r in drop_ambiguous_alternates(names, "country", "alt_name", "city_name").collect())
    assert got == sorted([(1, "X", "Twin", "Twin"), (2, "X", "Twin", "Twin"), (3, None, "Gem", "Other"),
                          (4, None, "Gem", "Other"), (5, "X", "Solo", "Five"), (6, "Y", "Gem", "Six"),
                          (7, "Z", "Dup", None), (8, "Z", "Dup", None)], key=lambda r: (r[0], r[2]))


def test_attach_alternates(spark):
    ents = spark.createDataFrame([(1, "A"), (2, "B")], "id int, name string")
    alts = spark.createDataFrame([(1, "a1", "English"), (1, "a2", None), (3, "c", None)],
                                 "id int, alt_name string, langs string")
    got = sorted(tuple(r) for r in attach_alternates(ents, alts).collect())
    assert got == [(1, "A", "a1", "English"), (1, "A", "a2", None)]


def test_dense_ids(spark):
    df = spark.range(0, 5000, 3).select((F.col("id") * 7 % 5003).alias("k"))
    out = assign_dense_ids(df, ["k"], id_col="rid", start=101, num_partitions=5).toPandas().sort_values("k")
    assert list(out["rid"]) == list(range(101, 101 + len(out)))


def test_key_assertions(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    with pytest.raises(KeyViolation):
        assert_unique(df, ["id"])
    assert_unique(df, ["id", "v"])
    with pytest.raises(KeyViolation):
        require_not_null(spark.createDataFrame([(None,)], "id int"), ["id"])


def test_sets(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("z", 3)], "k string, v int")
    assert union_distinct([a, b]).count() == 3
    c = spark.createDataFrame([("Hong Kong",), ("Peru",), (None,)], "country_name string")
    assert sorted(r[0] or "" for r in drop_values(c, "country_name", ["Hong Kong", "Macao"]).collect()) == ["", "Peru"]


def test_reassign(spark):
    df = spark.createDataFrame([("HK", "Kowloon City", 5), ("MO", None, 6), ("PE", "Lima", 7)],
                               "country_code string, disamb_name string, country_id int")
    out = reassign(df, "country_code", {"HK": " (HK)", "MO": " (Macao)"}, "disamb_name",
                   {"country_id": 1814991, "country_code": "CN"})
    assert [tuple(r) for r in out.collect()] == [("CN", "Kowloon City (HK)", 1814991), ("CN", None, 1814991),
                                                 ("PE", "Lima", 7)]


def test_build_lang_codes_excludes_and_dedups(spark):
    raw = spark.createDataFrame(
        [("eng", "eng", "en", "English"), ("eng", "eng", "en", "English"), ("", "frr", "", "Frisian"),
         ("", "afa", "", "Afro")], "c3 string, c2 string, c1 string, name string")
    got = sorted(tuple(r) for r in build_lang_codes(raw).collect())
    assert got == [("afa", "Afro", "639-2"), ("en", "English", "639-1"), ("eng", "English", "639-3")]


def test_fused_dedupe_packed_int_path(spark):
    rows = [(i, n, a, c, p) for i, n, a, c, p in DUP_ROWS] + [
        (20, "F", "d", "c", -5), (21, "F", "d", "c", -5), (22, "F", "d", "c", -7),
        (-3, "G", "d", "c", 2147483647), (-4, "G", "d", "c", 2147483647), (2147483647, "H", "d", "c", -2147483648),
        (2147483646, "J", "d", "c", 2147483647), (2147483647, "J", "d", "c", 2147483647),
    ]
    df = spark.createDataFrame(rows, "id int, name string, area string, country string, pop int")
    assert ids(dedupe_places(df, KEYS, "pop", "id")) == [-3, 3, 4, 5, 8, 9, 11, 12, 21, 2147483647, 2147483647]
    plan = dedupe_places(df, KEYS, "pop", "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_hot_keys_in_name_operators(spark):
    """One (scope, alternate) / one entity holding most rows: results stay exact."""
    n = 30000
    rows = spark.range(n).select(
        (F.col("id") % 3).cast("int").alias("id"),
        F.lit("Land").alias("country"),
        F.when(F.col("id") < 20000, F.lit("Hot")).otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("alt_name"),
        F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.lit("Other")).alias("city_name"),
        F.lit(None).cast("string").alias("langlist"),
    )
    kept = drop_ambiguous_alternates(rows, "country", "alt_name", "city_name")
    hot_kept = kept.where(F.col("alt_name") == "Hot").count()
    assert hot_kept == len([i for i in range(20000) if i % 3 == 0])
    assert kept.where(F.col("alt_name") != "Hot").count() == 10000

    ents = spark.createDataFrame([(0, "Hot"), (1, "Other"), (2, "Other")], "id int, city_name string")
    alts = rows.select("id", "alt_name", F.col("langlist").alias("langs"))
    attached = attach_alternates(ents, alts)
    assert attached.count() == n
    completed = add_missing_defaults_by_entity(attached, ["id", "city_name"], "city_name")
    # entity 0 owns "Hot" already; entities 1 and 2 get their default added once each
    assert completed.count() == n + 2


def test_default_completion_is_idempotent(spark):
    names = spark.createDataFrame(
        [(1, "Aa", "Ab", "English"), (2, "Bb", "Bb", None), (3, "Cc", "x", None), (3, "Cc", "y", "German")],
        "id int, name string, alt_name string, langlist string")
    once = add_missing_defaults_by_entity(names, ["id", "name"], "name")
    twice = add_missing_defaults_by_entity(once, ["id", "name"], "name")
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    ents = spark.createDataFrame([(1, "Aa"), (2, "Bb"), (4, "Dd")], "id int, name string")
    once = add_missing_defaults_by_name(names, ents, "id", "name", "id", "name")
    twice = add_missing_defaults_by_name(once, ents, "id", "name", "id", "name")
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_language_counts_in_one_state_are_exact(spark):
    """As many languages as the bound says, unequal counts, NULLs, a hot name."""
    from gazetta.operators.names import langs_from_counts

    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), F.col("id") % 400)).alias("alt_name"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("language "), (F.col("id") * F.col("id")) % 677)).alias("l"))
    distinct = rows.select("l").where("l IS NOT NULL").distinct().count()
    assert distinct > 300
    two_level = langs_from_counts(rows, ["id", "alt_name"], "l", "langs").collect()
    one_state = langs_from_counts(rows.repartition(13), ["id", "alt_name"], "l", "langs", values=distinct).collect()
    assert sorted(map(tuple, one_state), key=str) == sorted(map(tuple, two_level), key=str) and len(two_level) > 300
    assert any(r["langs"] is None for r in langs_from_counts(rows.where("l IS NULL"), ["id", "alt_name"], "l", "langs", values=0).collect())


def test_few_languages_are_counted_in_columns_by_hashing(spark):
    """Same lists as the counting of any number of values, without a sort: names
    that are empty, hold the separator, or are known but never occur; NULLs."""
    from gazetta.operators.names import MAX_VALUE_COLUMNS, langs_from_counts

    values = ["", "a, b", "Dutch", "Zulu", "é", "\U0001f600", "\uffff"]
    rows = spark.range(20_000).select(
        (F.col("id") % 40).alias("id"), F.concat(F.lit("n"), F.col("id") % 300).alias("alt_name"),
        F.when(F.col("id") % 40 != 7, F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.hash("id"), F.lit(3)) + F.col("id") % 5 + 1).cast("int"))).alias("l"))
    assert rows.where("l = ''").count() and rows.where("l IS NULL").count()
    any_number = langs_from_counts(rows, ["id", "alt_name"], "l", "langs").collect()
    few = langs_from_counts(rows, ["id", "alt_name"], "l", "langs", known=[*values, "never", None])
    assert sorted(map(tuple, few.collect()), key=str) == sorted(map(tuple, any_number), key=str)
    assert any(r["langs"] is None for r in any_number)
    assert [r["langs"] for r in langs_from_counts(rows.where("id = 7"), ["id", "alt_name"], "l", "langs", known=[]).collect()] == [None] * few.where("id = 7").count()

    raw = rows.select(F.col("id").alias("geoname_id"), F.col("l").alias("iso_language"), F.col("alt_name").alias("alternate_name"))
    for n, operator in ((3, "HashAggregate"), (MAX_VALUE_COLUMNS + 1, "ObjectHashAggregate")):
        codes = spark.createDataFrame([(f"c{i}", f"Language {i}") for i in range(n)], "code string, name string")
        plan = aggregate_alt_names(raw, codes)._jdf.queryExecution().sparkPlan().toString()
        assert ("ObjectHashAggregate" in plan) == (operator == "ObjectHashAggregate"), plan
