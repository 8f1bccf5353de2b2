"""The whole build as registered queries, with their DuckDB twins.

Spark derives GeoNames-format dump files from the driver tables
(``gazetta.plans.dump``), the gazetteer is built from them exactly as from a
real dump (strict landing, every step, published run), and each published
table is one query result. One build serves all of them per session and
input folder. The SQL below states the same tables over the driver tables by
windows: rivals and defaults are counted over partitions of one scan, and
``QUALIFY`` keeps rows, unlike the aggregations and joins of the Spark build.
"""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gazetta.plans.driver import CITY_KEYS, SQL_LANGUAGES, SQL_PSEUDO, _sql_clean, sql_largest, sql_not_first
from gazetta.plans.dump import CITY_ID_OFFSET, REGION_ID_OFFSET, SQL_LANGUAGE_OF_SOURCE, write_dump
from gazetta.plans.gazetteer import build_gazetteer, load_gazetteer
from gazetta.session import checkpoint_dir, modified

_BUILDS: dict[tuple, str] = {}
_LOCK = threading.Lock()


def _published(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Tables of the build over ``d``; built once per session and state of the folder."""
    key = (spark.conf.get("spark.app.id", ""), d, *(modified(spark, f"{d}/{t}.parquet") for t in ("documents", "customer", "nation", "region", "events")))
    with _LOCK:
        if key not in _BUILDS:
            # scratch space in the shared checkpoint folder
            base = os.path.join(checkpoint_dir(spark), "gazetteer-" + uuid.uuid4().hex)
            dump = write_dump(spark, d, os.path.join(base, "dump"))
            build_gazetteer(spark, dump, os.path.join(base, "out"))
            _BUILDS[key] = os.path.join(base, "out")
        return load_gazetteer(spark, _BUILDS[key])


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, d: str) -> DataFrame:
        return _published(spark, d)[name]

    query.__name__ = "q_gazetteer_" + name.replace(".", "_")
    return query


_OFF = CITY_ID_OFFSET
_OBSOLETE = "('Serbia and Montenegro', 'Macao', 'Hong Kong')"

SQL_PREFIX = f"""WITH {SQL_LANGUAGES},
lang639 AS (
  SELECT DISTINCT d.lang AS code, {_sql_clean('COALESCE(c.name, upper(d.lang))')} AS name
  FROM documents d LEFT JOIN codes c ON d.lang = c.code),
words AS (
  SELECT doc_id AS geoname_id, {SQL_LANGUAGE_OF_SOURCE} AS iso_language,
         UNNEST(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS alternate_name
  FROM documents),
kept AS (
  SELECT geoname_id AS id, {_sql_clean('alternate_name')} AS alt_name, COALESCE(iso_language, 'none') AS lang
  FROM words
  WHERE COALESCE(iso_language, 'none') NOT IN ({SQL_PSEUDO}) AND alternate_name <= 'ZZ'),
alts AS (
  SELECT CAST(k.id AS INTEGER) AS id, k.alt_name, string_agg(l.name, ', ' ORDER BY l.name) AS langs
  FROM kept k LEFT JOIN lang639 l ON k.lang = l.code GROUP BY k.id, k.alt_name),
pop AS (SELECT c_nationkey, CAST(sum(round(c_acctbal)) AS BIGINT) AS population FROM customer GROUP BY c_nationkey),
countries_all AS (
  SELECT CAST(n_nationkey AS INTEGER) AS id,
         CASE WHEN COALESCE(p.population, 0) < 320000 THEN 2 ELSE 1 END AS rank,
         CASE WHEN n_regionkey = 2 THEN 'HK' WHEN n_regionkey = 3 THEN 'GB'
              ELSE 'C' || CAST(n_regionkey AS VARCHAR) END AS iso_code,
         {_sql_clean("CASE WHEN n_regionkey = 2 THEN 'Hong Kong' ELSE n_name END")} AS country_name,
         r_name AS continent, '' AS tld, CAST(NULL AS VARCHAR) AS languages, '' AS capital
  FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN pop p ON n_nationkey = p.c_nationkey),
kept_countries AS (SELECT * FROM countries_all WHERE country_name NOT IN {_OBSOLETE}),
base AS (
  SELECT c_custkey + {_OFF} AS gid, c_mktsegment, c_acctbal, n_nationkey, n_name, n_regionkey,
    CASE WHEN n_regionkey = 2 THEN 'HK' WHEN n_regionkey = 3 THEN 'GB' WHEN n_regionkey = 4 THEN NULL
         ELSE 'C' || CAST(n_regionkey AS VARCHAR) END AS cc,
    NULLIF(c_mktsegment, 'BUILDING') AS a1,
    NULLIF(CAST(n_nationkey AS VARCHAR), '8') AS a2
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
staged AS (
  SELECT CAST(gid AS INTEGER) AS id, replace(c_mktsegment, '''', '’') AS name,
    CASE WHEN cc IS NULL THEN 'none' WHEN cc IN ('GB', 'FR') THEN 'admin2' ELSE 'admin1' END AS disamb_type,
    CASE WHEN cc IS NULL THEN 'none'
         WHEN cc IN ('GB', 'FR') THEN
           CASE WHEN a2 IS NULL THEN 'none'
                ELSE (CASE WHEN a1 IS NULL THEN 'none' ELSE cc || '.' || a1 END) || '.' || a2 END
         ELSE CASE WHEN a1 IS NULL THEN 'none' ELSE cc || '.' || a1 END END AS disamb_code,
    COALESCE(cc, 'none') AS country_code,
    c_acctbal AS lat, CAST(n_nationkey AS DOUBLE) AS lng,
    CAST(NULLIF(CAST(floor(c_acctbal / 1000) AS BIGINT), 0) AS INTEGER) AS pop
  FROM base),
cpick AS (SELECT c.* FROM kept_countries c
          JOIN (SELECT iso_code, min(id) AS id FROM kept_countries GROUP BY iso_code) m ON c.id = m.id),
admins AS (
  SELECT 'admin1' AS level, CAST(min(gid) AS INTEGER) AS id, cc || '.' || a1 AS code, a1 || ' area' AS name
  FROM base WHERE cc IS NOT NULL AND a1 IS NOT NULL AND a1 <> 'FURNITURE' AND cc <> 'GB' GROUP BY cc, a1
  UNION ALL
  SELECT 'admin2', CAST(min(gid) AS INTEGER), cc || '.' || a1 || '.' || a2, n_name
  FROM base WHERE cc = 'GB' AND a1 IS NOT NULL AND a2 IS NOT NULL GROUP BY cc, a1, a2, n_name),
apick AS (SELECT a.* FROM admins a
          JOIN (SELECT level, code, min(id) AS id FROM admins GROUP BY level, code) m
            ON a.level = m.level AND a.code = m.code AND a.id = m.id),
step1 AS (
  SELECT s.id, s.name, s.disamb_type, NULLIF(s.disamb_code, 'none') AS disamb_code,
         cp.id AS country_id, s.country_code, cp.country_name, s.lat, s.lng, s.pop
  FROM staged s LEFT JOIN cpick cp ON s.country_code = cp.iso_code),
step2 AS (
  SELECT s.*, a.id AS disamb_id, a.name AS disamb_name
  FROM step1 s LEFT JOIN apick a ON s.disamb_type = a.level AND s.disamb_code = a.code),
city AS (
  SELECT id, name, disamb_type, disamb_id, disamb_code,
    CASE WHEN country_code = 'HK' THEN disamb_name || ' (HK)'
         WHEN country_code = 'MO' THEN disamb_name || ' (Macao)' ELSE disamb_name END AS disamb_name,
    CASE WHEN country_code IN ('HK', 'MO') THEN 1814991 ELSE country_id END AS country_id,
    CASE WHEN country_code IN ('HK', 'MO') THEN 'CN' ELSE country_code END AS country_code,
    CASE WHEN country_code IN ('HK', 'MO') THEN 'China' ELSE country_name END AS country_name,
    lat, lng, pop
  FROM step2),
largest AS (SELECT * FROM city QUALIFY {sql_largest(CITY_KEYS)}),
cities AS (SELECT * FROM largest QUALIFY {sql_not_first(CITY_KEYS)})"""

SQL_CITY_NAMES = SQL_PREFIX + """,
named AS (
  SELECT c.id AS city_id, c.name AS city_name, c.disamb_id, c.disamb_name, c.country_id, c.country_name,
         list({'a': a.alt_name, 'l': a.langs}) AS alternates, coalesce(bool_or(a.alt_name = c.name), false) AS own
  FROM alts a JOIN cities c ON c.id = a.id GROUP BY ALL),
whole AS (
  SELECT * EXCLUDE (alternates, own),
         unnest(CASE WHEN own THEN alternates ELSE list_append(alternates, {'a': city_name, 'l': NULL}) END) AS n
  FROM named),
settled AS (
  SELECT * EXCLUDE (n), n.a AS alt_name, n.l AS langlist FROM whole
  QUALIFY country_name IS NULL OR coalesce(n.a = city_name, true) OR count(*) OVER (PARTITION BY country_name, n.a) = 1)
SELECT CAST(1000000 + row_number() OVER (ORDER BY city_id, alt_name) AS INTEGER) AS id, * FROM settled"""

SQL_CITIES = SQL_PREFIX + """
SELECT id, name, disamb_type, disamb_id, disamb_code, disamb_name, country_id, country_code, country_name,
       lat, lng, pop FROM cities"""

SQL_ALT_NAMES = SQL_PREFIX + "\nSELECT id, alt_name, langs FROM alts"

SQL_COUNTRIES = SQL_PREFIX + """
SELECT id, rank, iso_code, country_name, continent, tld, languages, capital FROM kept_countries"""

SQL_COUNTRY_NAMES = SQL_PREFIX + f""",
spelled AS (SELECT c.country_name, bool_or(a.alt_name = c.country_name) AS named
            FROM countries_all c JOIN alts a ON a.id = c.id GROUP BY c.country_name),
rows AS (
  SELECT c.id AS country_id, c.country_name, a.alt_name, a.langs AS langlist FROM alts a JOIN countries_all c ON c.id = a.id
  UNION ALL
  SELECT id, country_name, country_name, '' FROM countries_all LEFT JOIN spelled USING (country_name)
  WHERE named IS DISTINCT FROM true)
SELECT CAST(10000 + row_number() OVER (ORDER BY country_id, alt_name) AS INTEGER) AS id, *
FROM rows WHERE country_name NOT IN {_OBSOLETE}"""

SQL_LANG_CODES = SQL_PREFIX + """
SELECT code || code AS code, name, '639-3' AS code_type FROM lang639
UNION
SELECT code, name, '639-1' AS code_type FROM lang639"""

SQL_REGIONS = f"""SELECT CAST(event_id + {REGION_ID_OFFSET} AS INTEGER) AS id,
       CASE WHEN event_type = 'view' THEN 'RGN' ELSE 'CONT' END AS feature_code,
       props AS name, CAST(user_id AS VARCHAR) AS members
FROM events WHERE event_type IN ('view', 'signup')"""

SQL_GEO_LANG_CODES = SQL_PREFIX + """
SELECT code || code AS c3, code || code AS c2, code AS c1, name FROM lang639"""

SQL_GEO_ADM1S = SQL_PREFIX + "\nSELECT id, code, name FROM admins WHERE level = 'admin1'"

SQL_GEO_ADM2S = SQL_PREFIX + "\nSELECT id, code, name FROM admins WHERE level = 'admin2'"

SQL_GEO_COUNTRIES = SQL_PREFIX + """
SELECT id, rank, iso_code, country_name, continent, tld, '' AS languages, capital FROM countries_all"""

SQL_GEO_CITIES = SQL_PREFIX + """
SELECT id, name, disamb_type, CAST(NULL AS INTEGER) AS disamb_id, disamb_code, CAST(NULL AS VARCHAR) AS disamb_name,
       CAST(NULL AS INTEGER) AS country_id, country_code, CAST(NULL AS VARCHAR) AS country_name, lat, lng, pop
FROM staged"""

SQL_STEP_COUNTS = SQL_PREFIX + """,
city_alts AS (SELECT c.id, c.name, c.country_name, a.alt_name FROM alts a JOIN cities c ON c.id = a.id),
lacking AS (SELECT id, name, country_name FROM city_alts GROUP BY ALL HAVING NOT coalesce(bool_or(alt_name = name), false)),
city_rows AS (SELECT name, country_name, alt_name FROM city_alts UNION ALL SELECT name, country_name, name FROM lacking),
rivals AS (SELECT *, count(*) OVER (PARTITION BY country_name, alt_name) AS n FROM city_rows),
spelled AS (SELECT country_name, bool_or(a.alt_name = country_name) AS named FROM countries_all c JOIN alts a ON a.id = c.id GROUP BY country_name)
SELECT step, CAST(rows AS BIGINT) AS rows FROM (VALUES
  ('cities matched to admin 1', (SELECT count(*) FROM city WHERE disamb_type = 'admin1' AND disamb_id IS NOT NULL)),
  ('cities matched to admin 2', (SELECT count(*) FROM city WHERE disamb_type = 'admin2' AND disamb_id IS NOT NULL)),
  ('cities deleted: smaller duplicates', (SELECT count(*) FROM city) - (SELECT count(*) FROM largest)),
  ('cities deleted: smallest id of duplicates', (SELECT count(*) FROM largest) - (SELECT count(*) FROM cities)),
  ('country names created', (SELECT count(*) FROM alts WHERE id IN (SELECT id FROM countries_all))),
  ('country names: defaults added', (SELECT count(*) FROM countries_all LEFT JOIN spelled USING (country_name) WHERE named IS DISTINCT FROM true)),
  ('city names created', (SELECT count(*) FROM city_alts)),
  ('city names: defaults added', (SELECT count(*) FROM lacking)),
  ('city names deleted: ambiguous', (SELECT count(*) FROM rivals WHERE n > 1 AND country_name IS NOT NULL AND alt_name <> name)),
  ('language codes', (SELECT count(*) FROM (SELECT DISTINCT code || code, name FROM lang639)) + (SELECT count(*) FROM lang639))
) AS t(step, rows)"""

_TABLES = {
    "gazetteer_step_counts": ("src.step_counts", SQL_STEP_COUNTS),
    "gazetteer_city_names": ("src.city_names", SQL_CITY_NAMES),
    "gazetteer_cities": ("src.cities", SQL_CITIES),
    "gazetteer_alt_names": ("geo.alt_names", SQL_ALT_NAMES),
    "gazetteer_countries": ("src.countries", SQL_COUNTRIES),
    "gazetteer_country_names": ("src.country_names", SQL_COUNTRY_NAMES),
    "gazetteer_lang_codes": ("src.lang_codes", SQL_LANG_CODES),
    "gazetteer_regions": ("src.regions", SQL_REGIONS),
    "gazetteer_geo_lang_codes": ("geo.lang_codes", SQL_GEO_LANG_CODES),
    "gazetteer_geo_adm1s": ("geo.adm1s", SQL_GEO_ADM1S),
    "gazetteer_geo_adm2s": ("geo.adm2s", SQL_GEO_ADM2S),
    "gazetteer_geo_countries": ("geo.countries", SQL_GEO_COUNTRIES),
    "gazetteer_geo_cities": ("geo.cities", SQL_GEO_CITIES),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _table(t) for k, (t, _) in _TABLES.items()}
ORACLE: dict[str, str] = {k: sql for k, (_, sql) in _TABLES.items()}
