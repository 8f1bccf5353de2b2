"""Builders for each gazetteer table, as DataFrame -> DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gazetta.functions.codes import disambiguation, none_to_null, rank_by_threshold
from gazetta.functions.text import clean_name, curly_apostrophe, empty_if_null
from gazetta.operators.dedup import dedupe_places, drop_ambiguous_alternates
from gazetta.operators.keys import assign_dense_ids, materialize
from gazetta.operators.lookup import enrich_by_lookup
from gazetta.operators.names import (
    add_missing_defaults_by_entity,
    add_missing_defaults_by_name,
    attach_alternates,
)
from gazetta.operators.sets import drop_values, reassign, select_features, union_distinct

# --- fixed values -----------------------------------------------------------
# 639-2 codes left out of the language table.
EXCLUDED_639_2 = ("frr", "srn", "syc", "rup")
# Countries retired from the gazetteer (with their names).
OBSOLETE_COUNTRIES = ("Serbia and Montenegro", "Macao", "Hong Kong")
# Cities of retired countries move to China, keeping their area codes; the
# area name gets a suffix naming the old country.
ORPHAN_SUFFIXES = {"HK": " (HK)", "MO": " (Macao)"}
ORPHAN_OWNER = {"country_id": 1814991, "country_code": "CN", "country_name": "China"}
# Feature codes of the region-like scopes kept from the non-country file.
REGION_FEATURES = ("RGN", "CONT")
# First surrogate ids of the names tables.
COUNTRY_NAMES_FIRST_ID = 10001
CITY_NAMES_FIRST_ID = 1000001
# Keys that identify a duplicated city.
CITY_DUP_KEYS = ("name", "disamb_name", "country_name")
# -----------------------------------------------------------------------------


def build_lang_codes(raw: DataFrame, excluded_639_2: Sequence[str] = EXCLUDED_639_2) -> DataFrame:
    """Language-code table ``(code, name, code_type)`` from (c3, c2, c1, name) rows.

    Three branches, united without duplicates: 639-2 codes of rows without a
    639-3 code (minus a few excluded ones), all 639-3 codes, all 639-1 codes.
    """
    c3, c2, c1 = F.col("c3"), F.col("c2"), F.col("c1")
    part2 = raw.where((c3 == "") & ~c2.isin(list(excluded_639_2))).select(
        c2.alias("code"), "name", F.lit("639-2").alias("code_type")
    )
    part3 = raw.where(c3 != "").select(c3.alias("code"), "name", F.lit("639-3").alias("code_type"))
    part1 = raw.where(c1 != "").select(c1.alias("code"), "name", F.lit("639-1").alias("code_type"))
    return union_distinct([part2, part3, part1])


def stage_lang_codes(raw: DataFrame) -> DataFrame:
    """(c3, c2, c1, name) staging rows: required text as '' when empty, name cleaned."""
    return raw.select(
        empty_if_null("c3").alias("c3"),
        empty_if_null("c2").alias("c2"),
        empty_if_null("c1").alias("c1"),
        clean_name(empty_if_null("name")).alias("name"),
    )


def build_admins(raw: DataFrame) -> DataFrame:
    """``(id, code, name)`` of administrative areas, name cleaned, id narrowed to int."""
    return raw.select(
        F.col("geonameid").cast("int").alias("id"),
        empty_if_null("code").alias("code"),
        clean_name(empty_if_null("name")).alias("name"),
    )


def build_countries(raw: DataFrame, threshold: int | None = None) -> DataFrame:
    """Staged countries ``(id, rank, iso_code, country_name, continent, tld, languages, capital)``."""
    rank = rank_by_threshold("population") if threshold is None else rank_by_threshold("population", threshold)
    return raw.select(
        F.col("geonameid").cast("int").alias("id"),
        rank.alias("rank"),
        empty_if_null("iso").alias("iso_code"),
        clean_name(empty_if_null("country")).alias("country_name"),
        empty_if_null("continent").alias("continent"),
        empty_if_null("tld").alias("tld"),
        empty_if_null("languages").alias("languages"),
        clean_name(empty_if_null("capital")).alias("capital"),
    )


def curate_countries(staged: DataFrame) -> DataFrame:
    """The published country table: same columns, ``languages`` left NULL."""
    return staged.withColumn("languages", F.lit(None).cast("string"))


def build_country_names(countries: DataFrame, alt_names: DataFrame, counted: Observation | None = None) -> DataFrame:
    """``(country_id, country_name, alt_name, langlist)`` before ids are assigned.

    Alternates of each country, plus the country's own name (language list
    ``''``) where it is not among them -- even for a country without any
    alternate.
    """
    ents = countries.select(F.col("id").alias("country_id"), "country_name")
    names = attach_alternates(ents, alt_names, entity_id="country_id")
    return add_missing_defaults_by_name(
        names, ents, "country_id", "country_name", "country_id", "country_name", counted=counted
    )


def stage_cities(raw: DataFrame) -> DataFrame:
    """Staged city rows from the 19-column dump: apostrophes curled, codes built."""
    dtype, dcode, cc = disambiguation("country_code", "admin1_code", "admin2_code")
    return raw.select(
        F.col("geonameid").cast("int").alias("id"),
        curly_apostrophe(empty_if_null("name")).alias("name"),
        dtype.alias("disamb_type"),
        F.lit(None).cast("int").alias("disamb_id"),
        dcode.alias("disamb_code"),
        F.lit(None).cast("string").alias("disamb_name"),
        F.lit(None).cast("int").alias("country_id"),
        cc.alias("country_code"),
        F.lit(None).cast("string").alias("country_name"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lng"),
        F.col("population").cast("int").alias("pop"),
    )


def curate_cities(staged: DataFrame, countries: DataFrame, admins: DataFrame) -> DataFrame:
    """Tie cities to their country and area, re-home orphans, remove duplicates."""
    return dedupe_places(match_cities(staged, countries, admins), list(CITY_DUP_KEYS), measure="pop", id_col="id")


def match_cities(staged: DataFrame, countries: DataFrame, admins: DataFrame) -> DataFrame:
    """Cities tied to their country and area, orphans re-homed, duplicates still in.

    ``countries`` is the curated table (retired countries already removed);
    ``admins`` holds both levels as ``(level, id, code, name)``.
    """
    cities = staged.withColumn(
        "country_id", F.when(F.col("country_code") != F.lit("none"), F.col("country_id"))
    )
    cities = enrich_by_lookup(
        cities,
        countries,
        on={"country_code": "iso_code"},
        assignments={"country_id": "id", "country_name": "country_name"},
        order_by="id",
    )
    cities = cities.withColumn("disamb_code", none_to_null("disamb_code"))
    # Both area levels in one lookup keyed on (level, code): one join, not two.
    cities = enrich_by_lookup(
        cities,
        admins,
        on={"disamb_type": "level", "disamb_code": "code"},
        assignments={"disamb_id": "id", "disamb_name": "name"},
        order_by="id",
    )
    return reassign(cities, "country_code", ORPHAN_SUFFIXES, "disamb_name", ORPHAN_OWNER)


def build_city_names(cities: DataFrame, alt_names: DataFrame) -> DataFrame:
    """``(city_id, city_name, disamb_id, disamb_name, country_id, country_name, alt_name, langlist)``.

    Alternates of each city; the city's own name added (NULL language list)
    where a city with alternates lacks it; then, where an alternate occurs
    more than once in a country, only rows where it is the city's own name.
    """
    # read twice (group counts and the rows themselves)
    return drop_ambiguous_alternates(materialize(complete_city_names(cities, alt_names)), "country_name", "alt_name", "city_name")


def complete_city_names(cities: DataFrame, alt_names: DataFrame, counted: Observation | None = None) -> DataFrame:
    """The names of ``build_city_names`` with ambiguous alternates still in."""
    ents = cities.select(
        F.col("id").alias("city_id"),
        F.col("name").alias("city_name"),
        "disamb_id",
        "disamb_name",
        "country_id",
        "country_name",
    )
    names = attach_alternates(ents, alt_names, entity_id="city_id")
    return add_missing_defaults_by_entity(names, list(ents.columns), default_col="city_name", counted=counted)


def with_ids(names: DataFrame, order_by: Sequence[str], first_id: int) -> DataFrame:
    """Prefix a dense surrogate ``id`` column numbered from ``first_id``."""
    numbered = assign_dense_ids(names, list(order_by), id_col="id", start=first_id)
    return numbered.select(F.col("id").cast("int").alias("id"), *names.columns)


def select_regions(raw: DataFrame, keep: Sequence[str] = REGION_FEATURES) -> DataFrame:
    """``(id, feature_code, name, members)`` of region-like scopes; name unchanged."""
    return select_features(
        raw,
        "feature_code",
        keep,
        {
            "id": F.col("geonameid").cast("int"),
            "feature_code": "feature_code",
            "name": empty_if_null("name"),
            "members": "cc2",
        },
    )


def drop_obsolete_countries(df: DataFrame, names: Sequence[str] = OBSOLETE_COUNTRIES) -> DataFrame:
    return drop_values(df, "country_name", names)
