"""Schemas of the GeoNames dump files, bound by position (no inference).

``REQUIRED`` lists, per file, the non-text columns that must be present on
every row: an empty field there is a malformed row, not a NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# iso-languagecodes.txt has a header row and is bound by these header names.
LANG_CODE_HEADERS = {"ISO 639-3": "c3", "ISO 639-2": "c2", "ISO 639-1": "c1", "Language Name": "name"}

ALT_NAMES = _schema(
    ("alternate_name_id", L), ("geoname_id", L), ("iso_language", S), ("alternate_name", S),
    ("is_preferred_name", I), ("is_short_name", I), ("is_colloquial", I), ("is_historic", I),
    ("yfrom", S), ("yto", S),
)

ADMINS = _schema(("code", S), ("name", S), ("asciiname", S), ("geonameid", L))

COUNTRIES = _schema(
    ("iso", S), ("iso3", S), ("iso_numeric", I), ("fips", S), ("country", S), ("capital", S),
    ("area_sqkm", D), ("population", L), ("continent", S), ("tld", S), ("currency_code", S),
    ("currency_name", S), ("phone", S), ("postal_code_format", S), ("postal_code_regex", S),
    ("languages", S), ("geonameid", L), ("neighbours", S), ("equivalent_fips_code", S),
)

PLACES = _schema(
    ("geonameid", L), ("name", S), ("asciiname", S), ("alternatenames", S), ("latitude", D),
    ("longitude", D), ("feature_class", S), ("feature_code", S), ("country_code", S), ("cc2", S),
    ("admin1_code", S), ("admin2_code", S), ("admin3_code", S), ("admin4_code", S),
    ("population", L), ("elevation", L), ("dem", L), ("timezone", S), ("mod_date", S),
)

# Schema of each kind of file (None: text columns named by the header).
BY_KIND = {"lang_codes": None, "alt_names": ALT_NAMES, "admins": ADMINS, "countries": COUNTRIES, "places": PLACES}

REQUIRED = {
    "alt_names": ["alternate_name_id", "geoname_id"],
    "admins": ["geonameid"],
    "countries": ["iso_numeric", "area_sqkm", "population", "geonameid"],
    "places": ["geonameid"],
    "lang_codes": [],
}

# Required text columns: an empty field there is the empty string, not NULL
# (Spark's reader turns every empty field into NULL).
REQUIRED_TEXT = {
    "alt_names": ["alternate_name"],
    "admins": ["code", "name", "asciiname"],
    "countries": ["iso", "iso3", "country", "continent"],
    "places": ["name", "asciiname"],
    "lang_codes": ["c3", "c2", "c1", "name"],
}

# Columns parsed as unsigned counts in the source; a negative value is malformed.
NON_NEGATIVE = {"alt_names": ["is_preferred_name", "is_short_name", "is_colloquial", "is_historic"]}
