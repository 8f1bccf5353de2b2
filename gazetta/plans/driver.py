"""Operator queries over the driver's parquet tables, with DuckDB oracles.

The driver supplies TPC-H-like tables and text tables, not gazetteer dumps,
so every operator is exercised on inputs Spark derives from those tables:
whole tables and whole texts, no id subsets or row caps. Each query has a
twin SQL statement for the DuckDB oracle with the same column names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.functions.codes import disambiguation, none_to_null
from gazetta.functions.text import (
    PSEUDO_LANGUAGES,
    WHITE_SPACE,
    clean_name,
    curly_apostrophe,
    is_latin_name,
    not_pseudo_language,
)
from gazetta.operators.dedup import (
    dedupe_places,
    drop_ambiguous_alternates,
    drop_min_id_duplicates,
    drop_smaller_duplicates,
)
from gazetta.operators.keys import assign_dense_ids, materialize
from gazetta.operators.lookup import broadcast_if_small_result, enrich_by_lookup, is_small
from gazetta.operators.names import (
    add_missing_defaults_by_entity,
    add_missing_defaults_by_name,
    aggregate_alt_names,
    attach_alternates,
)
from gazetta.operators.sets import drop_values, reassign, select_features
from gazetta.operators.resolve import explode_region_members, resolve_places
from gazetta.plans.tables import (
    ORPHAN_OWNER,
    ORPHAN_SUFFIXES,
    build_countries,
    build_lang_codes,
    CITY_NAMES_FIRST_ID,
    COUNTRY_NAMES_FIRST_ID,
    build_city_names,
    build_country_names,
    curate_cities,
    stage_cities,
    stage_lang_codes,
    with_ids,
)
from gazetta.session import checkpoint_dir
from gazetta.sources.geonames import malformed_records, read_tsv
from gazetta.sources.layout import find_names, write_clustered, write_name_index

# --- fixed values for the driver queries ------------------------------------
# Language lookup used to label alternate names in these queries.
LANGUAGES = (("en", "English"), ("fr", "French"), ("de", "German"))
# -----------------------------------------------------------------------------

# Largest dimension table broadcast without a second thought (rows).
DIM_MAX_ROWS = 100_000


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


_DIM_SMALL: dict[tuple[str, str], bool] = {}


def _dim(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A dimension table (region, nation), broadcast after its size is checked.

    Joining a fact table to a tiny dimension by sort-merge would shuffle the
    fact side; a checked broadcast hash join leaves it where it is. The check
    runs once per session and table.
    """
    key = (spark.conf.get("spark.app.id", ""), f"{d}/{name}")
    table = _t(spark, d, name)
    if key not in _DIM_SMALL:
        _DIM_SMALL[key] = is_small(table, DIM_MAX_ROWS)
    return F.broadcast(table) if _DIM_SMALL[key] else table


def _languages(spark: SparkSession) -> DataFrame:
    schema = "code string, name string"
    return spark.createDataFrame(list(LANGUAGES), schema).withColumn("code_type", F.lit("639-1"))


def _sql_str_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _sql_char_class() -> str:
    parts = []
    for ch in WHITE_SPACE:
        parts.append("\\x{%X}" % ord(ch))
    return "[" + "".join(parts) + "]"


def _sql_clean(expr: str) -> str:
    cls = _sql_char_class()
    trimmed = f"regexp_replace({expr}, '^{cls}+|{cls}+$', '', 'g')"
    return f"replace(replace({trimmed}, '.', ''), '''', '’')"


SQL_LANGUAGES = "codes(code, name) AS (VALUES " + ", ".join(f"('{c}', '{n}')" for c, n in LANGUAGES) + ")"
SQL_PSEUDO = _sql_str_list(PSEUDO_LANGUAGES)


# ---------------------------------------------------------------------------
# Alternate names from document lines: each line of a document is a name of
# that document in the document's language ('es' documents carry no language).
# ---------------------------------------------------------------------------

def doc_line_alternates(spark: SparkSession, d: str) -> DataFrame:
    """Every line of every document as a name of that document.

    The lines are rebalanced after the explode (filters on them are pushed
    below it), so even one huge document's lines are cleaned and counted by
    many tasks; AQE sizes and splits the partitions.
    """
    docs = _t(spark, d, "documents")
    lines = docs.select(
        F.col("doc_id").alias("geoname_id"),
        F.nullif(F.col("lang"), F.lit("es")).alias("iso_language"),
        F.explode(F.split(F.col("text"), "\n")).alias("alternate_name"),
    )
    return lines.hint("rebalance")


SQL_DOC_LINES = """raw AS (
  SELECT doc_id AS geoname_id, NULLIF(lang, 'es') AS iso_language,
         UNNEST(string_split(text, chr(10))) AS alternate_name
  FROM documents)"""


def _sql_alt_names(latin_only: bool, raw_cte: str = SQL_DOC_LINES) -> str:
    latin = "AND alternate_name <= 'ZZ'" if latin_only else ""
    return f"""WITH {raw_cte},
{SQL_LANGUAGES},
kept AS (
  SELECT geoname_id AS id, {_sql_clean('alternate_name')} AS alt_name,
         COALESCE(iso_language, 'none') AS lang
  FROM raw
  WHERE COALESCE(iso_language, 'none') NOT IN ({SQL_PSEUDO}) {latin})
SELECT k.id, k.alt_name, string_agg(c.name, ', ' ORDER BY c.name) AS langs
FROM kept k LEFT JOIN codes c ON k.lang = c.code
GROUP BY k.id, k.alt_name"""


def q_alt_names(spark: SparkSession, d: str) -> DataFrame:
    return aggregate_alt_names(doc_line_alternates(spark, d), _languages(spark), latin_only=True)


def q_alt_names_all_scripts(spark: SparkSession, d: str) -> DataFrame:
    return aggregate_alt_names(doc_line_alternates(spark, d), _languages(spark), latin_only=False)


# Sources whose lines are links, codes and the like, not names in a language.
PSEUDO_BY_SOURCE = {"src1": "link", "src2": "iata", "src5": "post", "src13": "abbr"}


def q_alt_names_real_languages(spark: SparkSession, d: str) -> DataFrame:
    language = F.col("lang")
    for source, code in PSEUDO_BY_SOURCE.items():
        language = F.when(F.col("source") == source, F.lit(code)).otherwise(language)
    lines = _t(spark, d, "documents").select(
        F.col("doc_id").alias("geoname_id"), language.alias("iso_language"),
        F.explode(F.split("text", "\n")).alias("alternate_name")).hint("rebalance")
    return aggregate_alt_names(lines, _languages(spark), latin_only=False)


SQL_REAL_LANGUAGES = f"""WITH lines AS (
  SELECT doc_id, CASE source {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in PSEUDO_BY_SOURCE.items())} ELSE lang END AS language,
         unnest(string_split(text, chr(10))) AS line
  FROM documents),
{SQL_LANGUAGES}
SELECT doc_id AS id, {_sql_clean('line')} AS alt_name, string_agg(codes.name, ', ' ORDER BY codes.name) AS langs
FROM lines LEFT JOIN codes ON codes.code = language
WHERE language IS NULL OR language NOT IN ({SQL_PSEUDO})
GROUP BY 1, 2"""

# Text whose words one task counts: its distinct words have to fit the hash map
# of a task, or Spark sorts the rest of them.
TEXT_PER_TASK = 16 << 20
WORD_CHARS = (" ", "\t", "\n", "\r")


def doc_word_alternates(spark: SparkSession, d: str) -> DataFrame:
    """Every word of every document as a name of that document (larger input);
    Spanish documents carry no language."""
    return doc_words(spark, d, F.nullif(F.col("lang"), F.lit("es")))


def doc_words(spark: SparkSession, d: str, language) -> DataFrame:
    """``(geoname_id, iso_language, alternate_name)`` for every word of every document.

    Same tokens as splitting each whole text on runs of white space, but
    computed per line after the lines are dealt out, so even one huge document
    is split by many tasks. Splitting lines yields the same non-empty words; the
    empty tokens of a whole-text split (one for an empty text, else one for
    leading and one for trailing white space) travel as further elements of the
    array of lines, told apart by a mark that no line can hold.
    """
    text = F.col("text")
    starts = ends = F.lit(False)
    for ch in WORD_CHARS:
        starts = starts | F.startswith(text, F.lit(ch))
        ends = ends | F.endswith(text, F.lit(ch))
    n_empty = F.when(text == "", F.lit(1)).otherwise(F.when(starts, 1).otherwise(0) + F.when(ends, 1).otherwise(0))
    lines = F.concat(F.split(text, "\n"), F.array_repeat(F.lit("\n"), n_empty))
    docs = _t(spark, d, "documents")
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    tasks = max(-(-size // TEXT_PER_TASK), spark.sparkContext.defaultParallelism)
    rows = docs.select(F.col("doc_id").alias("geoname_id"), language.alias("iso_language"), F.explode(lines).alias("line")).repartition(tasks)
    # one-character breaks are cut without a regular expression
    line = F.col("line")
    blanks = F.when(F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r")), F.translate(line, "\t\r", "  ")).otherwise(line)
    words = F.when(line == "\n", F.array(line)).otherwise(F.split(blanks, " "))
    word = F.col("alternate_name")
    rows = rows.select("geoname_id", "iso_language", F.explode(words).alias("alternate_name")).where(word != "")
    return rows.withColumn("alternate_name", F.when(word == "\n", F.lit("")).otherwise(word))


SQL_DOC_WORDS = r"""raw AS (
  SELECT doc_id AS geoname_id, NULLIF(lang, 'es') AS iso_language,
         UNNEST(regexp_split_to_array(text, '[ \t\n\r]+')) AS alternate_name
  FROM documents)"""


def q_alt_names_words(spark: SparkSession, d: str) -> DataFrame:
    return aggregate_alt_names(doc_word_alternates(spark, d), _languages(spark), latin_only=False)


# ---------------------------------------------------------------------------
# Filters and projections on whole texts
# ---------------------------------------------------------------------------

def q_latin_only(spark: SparkSession, d: str) -> DataFrame:
    conv = _t(spark, d, "conversations")
    return conv.where(is_latin_name("text")).select("conv_id", "turn", "role", "text")


SQL_LATIN_ONLY = "SELECT conv_id, turn, role, text FROM conversations WHERE text <= 'ZZ'"

EVENT_CODES_EXCLUDED = ("error", "click")


def q_exclude_codes(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("view")).alias("code"))
    kept = ev.where(not_pseudo_language("code", EVENT_CODES_EXCLUDED))
    return kept.select("event_id", "user_id", F.coalesce(F.col("code"), F.lit("none")).alias("code"))


SQL_EXCLUDE_CODES = f"""SELECT event_id, user_id, COALESCE(NULLIF(event_type, 'view'), 'none') AS code
FROM events
WHERE COALESCE(NULLIF(event_type, 'view'), 'none') NOT IN ({_sql_str_list(EVENT_CODES_EXCLUDED)})"""


def q_clean_names(spark: SparkSession, d: str) -> DataFrame:
    conv = _t(spark, d, "conversations")
    return conv.select(
        "conv_id", "turn", clean_name("text").alias("name_clean"), curly_apostrophe("text").alias("name_curly")
    )


SQL_CLEAN_NAMES = f"""SELECT conv_id, turn, {_sql_clean('text')} AS name_clean,
       replace(text, '''', '’') AS name_curly FROM conversations"""


# ---------------------------------------------------------------------------
# Duplicate places: parts as places (int ids, like cities) named p_name, in area p_type (PROMO
# parts have no area) and country LOW/HIGH by size, with population
# p_size div 10 (parts under size 10 have none).
# ---------------------------------------------------------------------------

def part_places(spark: SparkSession, d: str) -> DataFrame:
    part = _t(spark, d, "part")
    return part.select(
        F.col("p_partkey").cast("int").alias("id"),
        F.col("p_name").alias("name"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("area"),
        F.when(F.col("p_size") <= 25, F.lit("LOW")).otherwise(F.lit("HIGH")).alias("country"),
        F.nullif(F.expr("cast(p_size div 10 as int)"), F.lit(0)).alias("pop"),
    )


SQL_PART_PLACES = """city AS (
  SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name, NULLIF(p_type, 'PROMO') AS area,
         CASE WHEN p_size <= 25 THEN 'LOW' ELSE 'HIGH' END AS country,
         NULLIF(CAST(p_size // 10 AS INTEGER), 0) AS pop
  FROM part)"""

PLACE_KEYS = ["name", "area", "country"]
CITY_KEYS = ["name", "disamb_name", "country_name"]


def q_drop_smaller_dups(spark: SparkSession, d: str) -> DataFrame:
    return drop_smaller_duplicates(part_places(spark, d), PLACE_KEYS, "pop")


def sql_largest(keys: list[str]) -> str:
    """Condition: no rival by ``keys``, or a measure that no rival exceeds."""
    k = ", ".join(keys)
    return (f"({' OR '.join(x + ' IS NULL' for x in keys)}) "
            f"OR count(*) OVER (PARTITION BY {k}) = 1 OR coalesce(pop = max(pop) OVER (PARTITION BY {k}), false)")


def sql_not_first(keys: list[str]) -> str:
    """Condition: no rival by ``keys``, or not the smallest id among them."""
    k = ", ".join(keys)
    return (f"({' OR '.join(x + ' IS NULL' for x in keys)}) OR count(*) OVER (PARTITION BY {k}) = 1 "
            f"OR row_number() OVER (PARTITION BY {k} ORDER BY id) > 1")


SQL_DROP_SMALLER = f"""WITH {SQL_PART_PLACES}
SELECT * FROM city QUALIFY {sql_largest(PLACE_KEYS)}"""


def q_drop_min_id_dups(spark: SparkSession, d: str) -> DataFrame:
    return drop_min_id_duplicates(part_places(spark, d), PLACE_KEYS, "id")


SQL_DROP_MIN_ID = f"""WITH {SQL_PART_PLACES}
SELECT * FROM city QUALIFY {sql_not_first(PLACE_KEYS)}"""


def q_dedupe_places(spark: SparkSession, d: str) -> DataFrame:
    return dedupe_places(part_places(spark, d), PLACE_KEYS, "pop", "id")


SQL_DEDUPE = f"""WITH {SQL_PART_PLACES},
largest AS (SELECT * FROM city QUALIFY {sql_largest(PLACE_KEYS)})
SELECT * FROM largest QUALIFY {sql_not_first(PLACE_KEYS)}"""


# ---------------------------------------------------------------------------
# Lookup enrichment (UPDATE ... FROM)
# ---------------------------------------------------------------------------

def q_enrich_lookup(spark: SparkSession, d: str) -> DataFrame:
    cust = _t(spark, d, "customer").select(
        "c_custkey", "c_nationkey",
        F.lit(None).cast("int").alias("country_id"),
        F.col("c_mktsegment").alias("country_name"),
    )
    nations = _t(spark, d, "nation").where(F.col("n_regionkey") != 2)
    return enrich_by_lookup(
        cust, nations, on={"c_nationkey": "n_nationkey"},
        assignments={"country_id": "n_nationkey", "country_name": "n_name"}, order_by="n_nationkey",
    )


SQL_ENRICH = """SELECT c.c_custkey, c.c_nationkey,
       CASE WHEN n.n_nationkey IS NULL THEN CAST(NULL AS INTEGER) ELSE n.n_nationkey END AS country_id,
       CASE WHEN n.n_nationkey IS NULL THEN c.c_mktsegment ELSE n.n_name END AS country_name
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c.c_nationkey = n.n_nationkey"""


def q_enrich_lookup_first_match(spark: SparkSession, d: str) -> DataFrame:
    cust = _t(spark, d, "customer").select(
        "c_custkey", "c_nationkey",
        F.lit(None).cast("long").alias("supplier_id"),
        F.lit(None).cast("string").alias("supplier_name"),
    )
    sup = _t(spark, d, "supplier")
    return enrich_by_lookup(
        cust, sup, on={"c_nationkey": "s_nationkey"},
        assignments={"supplier_id": "s_suppkey", "supplier_name": "s_name"}, order_by="s_suppkey",
    )


SQL_ENRICH_FIRST = """WITH first AS (SELECT s_nationkey, min(s_suppkey) AS sid FROM supplier GROUP BY s_nationkey),
pick AS (SELECT s.s_nationkey, s.s_suppkey, s.s_name FROM supplier s JOIN first f ON s.s_suppkey = f.sid)
SELECT c.c_custkey, c.c_nationkey, p.s_suppkey AS supplier_id, p.s_name AS supplier_name
FROM customer c LEFT JOIN pick p ON c.c_nationkey = p.s_nationkey"""


# ---------------------------------------------------------------------------
# Ambiguous alternates: each part is named by its own name and by its type,
# within the scope of its brand (Brand#1 parts have no scope).
# ---------------------------------------------------------------------------

def part_names(spark: SparkSession, d: str) -> DataFrame:
    part = _t(spark, d, "part")
    scope = F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("scope")
    own = part.select(F.col("p_partkey").alias("id"), scope, F.col("p_name").alias("alt_name"),
                      F.col("p_name").alias("default_name"))
    typ = part.select(F.col("p_partkey").alias("id"), scope, F.col("p_type").alias("alt_name"),
                      F.col("p_name").alias("default_name"))
    return own.unionByName(typ)


def q_drop_ambiguous(spark: SparkSession, d: str) -> DataFrame:
    return drop_ambiguous_alternates(part_names(spark, d), "scope", "alt_name", "default_name")


SQL_DROP_AMBIGUOUS = """SELECT * FROM (
  SELECT p_partkey AS id, NULLIF(p_brand, 'Brand#1') AS scope, unnest([p_name, p_type]) AS alt_name, p_name AS default_name FROM part)
QUALIFY scope IS NULL OR alt_name IS NULL OR coalesce(alt_name = default_name, true) OR count(*) OVER (PARTITION BY scope, alt_name) = 1"""


# ---------------------------------------------------------------------------
# Language-code union: documents give (c3 = source unless Spanish, c2 = lang,
# c1 = lang for documents of 1000+ characters, name = source).
# ---------------------------------------------------------------------------

def doc_lang_rows(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents")
    return docs.select(
        F.when(F.col("lang") == "es", F.lit("")).otherwise(F.col("source")).alias("c3"),
        F.col("lang").alias("c2"),
        F.when(F.col("n_chars") < 1000, F.lit("")).otherwise(F.col("lang")).alias("c1"),
        F.col("source").alias("name"),
    )


def q_lang_codes(spark: SparkSession, d: str) -> DataFrame:
    return build_lang_codes(stage_lang_codes(doc_lang_rows(spark, d)))


SQL_LANG_CODES = """WITH raw AS (
  SELECT CASE WHEN lang = 'es' THEN '' ELSE source END AS c3, lang AS c2,
         CASE WHEN n_chars < 1000 THEN '' ELSE lang END AS c1, """ + _sql_clean('source') + """ AS name
  FROM documents)
SELECT DISTINCT e.code, name, e.code_type
FROM raw, LATERAL (SELECT unnest([
  {'code': c3, 'code_type': '639-3', 'use': c3 <> ''},
  {'code': c2, 'code_type': '639-2', 'use': c3 = '' AND c2 NOT IN ('frr', 'srn', 'syc', 'rup')},
  {'code': c1, 'code_type': '639-1', 'use': c1 <> ''}], recursive := true)) AS e
WHERE e.use"""


# ---------------------------------------------------------------------------
# Countries: nations, with population = sum of their customers' rounded
# account balances and the region as continent.
# ---------------------------------------------------------------------------

def nation_countries(spark: SparkSession, d: str) -> DataFrame:
    nation, region, cust = _t(spark, d, "nation"), _dim(spark, d, "region"), _t(spark, d, "customer")
    pop = cust.groupBy("c_nationkey").agg(F.sum(F.round("c_acctbal")).cast("long").alias("population"))
    pop = broadcast_if_small_result(pop, DIM_MAX_ROWS)  # one row per nation
    return (
        nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
        .join(pop, nation["n_nationkey"] == pop["c_nationkey"], "left")
        .select(
            F.col("n_nationkey").cast("long").alias("geonameid"),
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("iso"),
            F.col("n_name").alias("country"),
            F.coalesce(F.col("population"), F.lit(0).cast("long")).alias("population"),
            F.col("r_name").alias("continent"),
            F.lit(None).cast("string").alias("tld"),
            F.lit(None).cast("string").alias("languages"),
            F.lit(None).cast("string").alias("capital"),
        )
    )


def q_countries(spark: SparkSession, d: str) -> DataFrame:
    return build_countries(nation_countries(spark, d))


SQL_COUNTRIES = f"""WITH pop AS (SELECT c_nationkey, CAST(sum(round(c_acctbal)) AS BIGINT) AS population
             FROM customer GROUP BY c_nationkey)
SELECT n_nationkey AS id,
       CASE WHEN COALESCE(p.population, 0) < 320000 THEN 2 ELSE 1 END AS rank,
       'N' || CAST(n_nationkey AS VARCHAR) AS iso_code,
       {_sql_clean('n_name')} AS country_name, r_name AS continent, '' AS tld, '' AS languages, '' AS capital
FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN pop p ON n_nationkey = p.c_nationkey"""


# ---------------------------------------------------------------------------
# Regions: events as features, the 'view' and 'signup' ones kept.
# ---------------------------------------------------------------------------

EVENT_FEATURES = ("view", "signup")


def q_select_regions(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    return select_features(
        ev, "event_type", EVENT_FEATURES,
        {"id": "event_id", "feature_code": "event_type", "name": "props",
         "members": F.col("user_id").cast("string")},
    )


SQL_SELECT_REGIONS = f"""SELECT event_id AS id, event_type AS feature_code, props AS name,
       CAST(user_id AS VARCHAR) AS members
FROM events WHERE event_type IN ({_sql_str_list(EVENT_FEATURES)})"""


# ---------------------------------------------------------------------------
# Default names. Customers are the places; each order is a name of its
# customer: the customer's own name for urgent orders, else the priority.
# ---------------------------------------------------------------------------

def order_names(spark: SparkSession, d: str) -> DataFrame:
    orders, cust = _t(spark, d, "orders"), _t(spark, d, "customer")
    j = orders.join(cust, orders["o_custkey"] == cust["c_custkey"])
    return j.select(
        F.col("c_custkey").alias("place_id"),
        F.col("c_name").alias("place_name"),
        F.col("c_mktsegment").alias("area_name"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("c_name"))
        .otherwise(F.col("o_orderpriority")).alias("alt_name"),
        F.col("o_orderstatus").alias("langlist"),
    )


SQL_ORDER_NAMES = """names AS (
  SELECT c_custkey AS place_id, c_name AS place_name, c_mktsegment AS area_name,
         CASE WHEN o_orderpriority = '1-URGENT' THEN c_name ELSE o_orderpriority END AS alt_name,
         o_orderstatus AS langlist
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def q_missing_default_country(spark: SparkSession, d: str) -> DataFrame:
    # a stored names table in the build; read twice here (rows and own names)
    names = materialize(order_names(spark, d).drop("area_name"))
    ents = _t(spark, d, "customer").select(
        F.col("c_custkey").alias("place_id"), F.col("c_name").alias("place_name"))
    return add_missing_defaults_by_name(names, ents, "place_id", "place_name", "place_id", "place_name")


SQL_MISSING_COUNTRY = f"""WITH {SQL_ORDER_NAMES},
own AS (SELECT place_name, bool_or(place_name = alt_name) AS named FROM names GROUP BY place_name)
SELECT place_id, place_name, alt_name, langlist FROM names
UNION ALL
SELECT c_custkey, c_name, c_name, '' FROM customer
WHERE c_name NOT IN (SELECT place_name FROM own WHERE named AND place_name IS NOT NULL)"""


def q_missing_default_city(spark: SparkSession, d: str) -> DataFrame:
    # a stored names table in the build; read twice here (rows and per-place check)
    names = materialize(order_names(spark, d))
    return add_missing_defaults_by_entity(names, ["place_id", "place_name", "area_name"], "place_name")


SQL_MISSING_CITY = f"""WITH {SQL_ORDER_NAMES}
SELECT * FROM names
UNION ALL
SELECT place_id, place_name, area_name, place_name, CAST(NULL AS VARCHAR)
FROM names GROUP BY ALL HAVING NOT coalesce(bool_or(place_name = alt_name), false)"""


def q_attach_alternates(spark: SparkSession, d: str) -> DataFrame:
    cust = _t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    alts = q_alt_names(spark, d)
    return attach_alternates(cust, alts, entity_id="c_custkey")


SQL_ATTACH = f"""WITH alts AS ({_sql_alt_names(True)})
SELECT c.c_custkey, c.c_name, c.c_nationkey, a.alt_name, a.langs AS langlist
FROM customer c JOIN alts a ON c.c_custkey = a.id"""


# ---------------------------------------------------------------------------
# Codes and reassignment on customers: the country code comes from the
# region (EUROPE -> GB, AMERICA -> FR, ASIA -> none, else the nation name).
# ---------------------------------------------------------------------------

def customer_codes(spark: SparkSession, d: str) -> DataFrame:
    cust, nation, region = _t(spark, d, "customer"), _dim(spark, d, "nation"), _dim(spark, d, "region")
    j = cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"]).join(
        region, nation["n_regionkey"] == region["r_regionkey"])
    r = F.col("r_name")
    cc = (F.when(r == "EUROPE", F.lit("GB")).when(r == "AMERICA", F.lit("FR"))
          .when(r == "ASIA", F.lit(None).cast("string")).otherwise(F.col("n_name")))
    return j.select(
        "c_custkey",
        cc.alias("cc"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("admin1"),
        F.nullif(F.col("n_name"), F.lit("NATION_3")).alias("admin2"),
    )


SQL_CUSTOMER_CODES = """codes AS (
  SELECT c_custkey,
         CASE WHEN r_name = 'EUROPE' THEN 'GB' WHEN r_name = 'AMERICA' THEN 'FR'
              WHEN r_name = 'ASIA' THEN NULL ELSE n_name END AS cc,
         NULLIF(c_mktsegment, 'BUILDING') AS admin1, NULLIF(n_name, 'NATION_3') AS admin2
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def q_disamb_code(spark: SparkSession, d: str) -> DataFrame:
    rows = customer_codes(spark, d)
    dtype, dcode, cc = disambiguation("cc", "admin1", "admin2")
    return rows.select("c_custkey", dtype.alias("disamb_type"), none_to_null(dcode).alias("disamb_code"),
                       cc.alias("country_code"))


SQL_DISAMB = f"""WITH {SQL_CUSTOMER_CODES},
built AS (
  SELECT c_custkey,
    CASE WHEN cc IS NULL THEN 'none' WHEN cc IN ('GB', 'FR') THEN 'admin2' ELSE 'admin1' END AS disamb_type,
    CASE WHEN cc IS NULL THEN 'none'
         WHEN cc IN ('GB', 'FR') THEN
           CASE WHEN admin2 IS NULL THEN 'none'
                ELSE (CASE WHEN admin1 IS NULL THEN 'none' ELSE cc || '.' || admin1 END) || '.' || admin2 END
         ELSE CASE WHEN admin1 IS NULL THEN 'none' ELSE cc || '.' || admin1 END END AS code,
    COALESCE(cc, 'none') AS country_code
  FROM codes)
SELECT c_custkey, disamb_type, NULLIF(code, 'none') AS disamb_code, country_code FROM built"""


def customer_places(spark: SparkSession, d: str) -> DataFrame:
    cust, nation = _t(spark, d, "customer"), _dim(spark, d, "nation")
    j = cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"])
    n = F.col("n_name")
    return j.select(
        "c_custkey",
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("disamb_name"),
        F.col("n_nationkey").alias("country_id"),
        F.when(n == "NATION_3", F.lit("HK")).when(n == "NATION_8", F.lit("MO")).otherwise(n).alias("country_code"),
        n.alias("country_name"),
    )


SQL_CUSTOMER_PLACES = """places AS (
  SELECT c_custkey, NULLIF(c_mktsegment, 'MACHINERY') AS disamb_name, n_nationkey AS country_id,
         CASE WHEN n_name = 'NATION_3' THEN 'HK' WHEN n_name = 'NATION_8' THEN 'MO' ELSE n_name END AS country_code,
         n_name AS country_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def q_reassign_orphans(spark: SparkSession, d: str) -> DataFrame:
    return reassign(customer_places(spark, d), "country_code", ORPHAN_SUFFIXES, "disamb_name", ORPHAN_OWNER)


SQL_REASSIGN = f"""WITH {SQL_CUSTOMER_PLACES}
SELECT c_custkey,
  CASE WHEN country_code = 'HK' THEN disamb_name || ' (HK)'
       WHEN country_code = 'MO' THEN disamb_name || ' (Macao)' ELSE disamb_name END AS disamb_name,
  CASE WHEN country_code IN ('HK', 'MO') THEN 1814991 ELSE country_id END AS country_id,
  CASE WHEN country_code IN ('HK', 'MO') THEN 'CN' ELSE country_code END AS country_code,
  CASE WHEN country_code IN ('HK', 'MO') THEN 'China' ELSE country_name END AS country_name
FROM places"""

RETIRED_NATIONS = ("NATION_3", "NATION_8", "NATION_13")


def q_drop_obsolete(spark: SparkSession, d: str) -> DataFrame:
    return drop_values(customer_places(spark, d), "country_name", RETIRED_NATIONS)


SQL_DROP_OBSOLETE = f"""WITH {SQL_CUSTOMER_PLACES}
SELECT * FROM places WHERE country_name NOT IN ({_sql_str_list(RETIRED_NATIONS)})"""


def q_surrogate_ids(spark: SparkSession, d: str) -> DataFrame:
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    return assign_dense_ids(orders, ["o_orderkey"], id_col="id", start=1000001)


SQL_SURROGATE = "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) + 1000000 AS id FROM orders"


# ---------------------------------------------------------------------------
# City names end to end: parts are cities (name p_name, area p_type, country
# p_brand). Their alternates: the lines of the document with the same id,
# the part's own name for parts of size over 25, and its type for all.
# ---------------------------------------------------------------------------

def part_alternates(spark: SparkSession, d: str) -> DataFrame:
    part = _t(spark, d, "part")
    own = part.where(F.col("p_size") > 25).select(
        F.col("p_partkey").alias("geoname_id"), F.lit("en").alias("iso_language"),
        F.col("p_name").alias("alternate_name"))
    typ = part.select(
        F.col("p_partkey").alias("geoname_id"), F.lit(None).cast("string").alias("iso_language"),
        F.col("p_type").alias("alternate_name"))
    return doc_line_alternates(spark, d).unionByName(own).unionByName(typ)


SQL_PART_ALTERNATES = SQL_DOC_LINES.replace("raw AS (", "raw0 AS (", 1) + """,
raw AS (
  SELECT * FROM raw0
  UNION ALL SELECT p_partkey, 'en', p_name FROM part WHERE p_size > 25
  UNION ALL SELECT p_partkey, CAST(NULL AS VARCHAR), p_type FROM part)"""


def part_cities(spark: SparkSession, d: str) -> DataFrame:
    part = _t(spark, d, "part")
    return part.select(
        F.col("p_partkey").cast("int").alias("id"),
        F.col("p_name").alias("name"),
        F.lit(None).cast("int").alias("disamb_id"),
        F.col("p_type").alias("disamb_name"),
        F.lit(None).cast("int").alias("country_id"),
        F.col("p_brand").alias("country_name"),
    )


def q_city_names(spark: SparkSession, d: str) -> DataFrame:
    # materialised like the build's written geo.alt_names table: read by several branches
    alts = materialize(aggregate_alt_names(part_alternates(spark, d), _languages(spark), latin_only=False))
    names = build_city_names(part_cities(spark, d), alts)
    return with_ids(names, ["city_id", "alt_name"], CITY_NAMES_FIRST_ID)


SQL_CITY_NAMES = f"""WITH alts AS ({_sql_alt_names(False, SQL_PART_ALTERNATES)}),
cities AS (SELECT CAST(p_partkey AS INTEGER) AS city_id, p_name AS city_name, CAST(NULL AS INTEGER) AS disamb_id,
                  p_type AS disamb_name, CAST(NULL AS INTEGER) AS country_id, p_brand AS country_name FROM part),
attached AS (SELECT c.*, a.alt_name, a.langs AS langlist FROM cities c JOIN alts a ON c.city_id = a.id),
own AS (SELECT *, bool_or(city_name = alt_name) OVER (PARTITION BY city_id) AS named,
               row_number() OVER (PARTITION BY city_id ORDER BY alt_name) AS nth FROM attached),
whole AS (
  SELECT city_id, city_name, disamb_id, disamb_name, country_id, country_name,
         unnest(CASE WHEN nth = 1 AND NOT coalesce(named, false) THEN [{{'a': alt_name, 'l': langlist}}, {{'a': city_name, 'l': NULL}}]
                     ELSE [{{'a': alt_name, 'l': langlist}}] END) AS n FROM own),
kept AS (
  SELECT * EXCLUDE (n), n.a AS alt_name, n.l AS langlist FROM whole
  QUALIFY country_name IS NULL OR n.a IS NULL OR coalesce(n.a = city_name, true) OR count(*) OVER (PARTITION BY country_name, n.a) = 1)
SELECT CAST(1000000 + row_number() OVER (ORDER BY city_id, alt_name) AS INTEGER) AS id, * FROM kept"""

# ---------------------------------------------------------------------------
# City curation end to end: customers are raw cities named by their market
# segment; the country code comes from the nation's region (region 2 -> HK,
# a retired country; 3 -> GB, told apart by second-level areas; 4 -> no
# country; else C<region>). Countries are the nations (five per code, so the
# lookup is not unique); admin areas are derived by grouping the customers.
# ---------------------------------------------------------------------------

def _customer_geo(spark: SparkSession, d: str) -> DataFrame:
    cust, nation = _t(spark, d, "customer"), _dim(spark, d, "nation")
    rk = F.col("n_regionkey")
    cc = (F.when(rk == 2, F.lit("HK")).when(rk == 3, F.lit("GB")).when(rk == 4, F.lit(None).cast("string"))
          .otherwise(F.concat(F.lit("C"), rk.cast("string"))))
    return cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"]).select(
        "c_custkey", "c_mktsegment", "c_acctbal", "n_nationkey", "n_name", "n_regionkey", cc.alias("cc"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("a1"),
        F.nullif(F.col("n_nationkey").cast("string"), F.lit("8")).alias("a2"),
    )


def customer_raw_cities(spark: SparkSession, d: str) -> DataFrame:
    g = _customer_geo(spark, d)
    return g.select(
        F.col("c_custkey").alias("geonameid"),
        F.col("c_mktsegment").alias("name"),
        F.col("c_acctbal").alias("latitude"),
        F.col("n_nationkey").cast("double").alias("longitude"),
        F.col("cc").alias("country_code"),
        F.col("a1").alias("admin1_code"),
        F.col("a2").alias("admin2_code"),
        F.nullif(F.floor(F.col("c_acctbal") / 1000), F.lit(0)).alias("population"),
    )


def nation_country_lookup(spark: SparkSession, d: str) -> DataFrame:
    nation = _t(spark, d, "nation").where(F.col("n_regionkey") != 2)
    rk = F.col("n_regionkey")
    return nation.select(
        (F.col("n_nationkey") + 100).alias("id"),
        F.when(rk == 3, F.lit("GB")).otherwise(F.concat(F.lit("C"), rk.cast("string"))).alias("iso_code"),
        F.col("n_name").alias("country_name"),
    )


def customer_admins(spark: SparkSession, d: str) -> DataFrame:
    g = _customer_geo(spark, d).where(F.col("cc").isNotNull())
    adm1 = (
        g.where(F.col("a1").isNotNull() & (F.col("a1") != "FURNITURE") & ~F.col("cc").isin("GB"))
        .groupBy("cc", "a1").agg(F.min("c_custkey").cast("int").alias("id"))
        .select(F.lit("admin1").alias("level"), "id", F.concat_ws(".", "cc", "a1").alias("code"),
                F.concat(F.col("a1"), F.lit(" area")).alias("name"))
    )
    adm2 = (
        g.where((F.col("cc") == "GB") & F.col("a1").isNotNull() & F.col("a2").isNotNull())
        .groupBy("cc", "a1", "a2", "n_name").agg(F.min("c_custkey").cast("int").alias("id"))
        .select(F.lit("admin2").alias("level"), "id", F.concat_ws(".", "cc", "a1", "a2").alias("code"),
                F.col("n_name").alias("name"))
    )
    return adm1.unionByName(adm2)


def q_curate_cities(spark: SparkSession, d: str) -> DataFrame:
    staged = stage_cities(customer_raw_cities(spark, d))
    return curate_cities(staged, nation_country_lookup(spark, d), customer_admins(spark, d))


SQL_CURATE_CITIES = """WITH base AS (
  SELECT c_custkey, c_mktsegment, c_acctbal, n_nationkey, n_name, n_regionkey,
    CASE WHEN n_regionkey = 2 THEN 'HK' WHEN n_regionkey = 3 THEN 'GB' WHEN n_regionkey = 4 THEN NULL
         ELSE 'C' || CAST(n_regionkey AS VARCHAR) END AS cc,
    NULLIF(c_mktsegment, 'BUILDING') AS a1,
    NULLIF(CAST(n_nationkey AS VARCHAR), '8') AS a2
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
staged AS (
  SELECT CAST(c_custkey AS INTEGER) AS id, replace(c_mktsegment, '''', '’') AS name,
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
countries AS (
  SELECT n_nationkey + 100 AS id,
         CASE WHEN n_regionkey = 3 THEN 'GB' ELSE 'C' || CAST(n_regionkey AS VARCHAR) END AS iso_code,
         n_name AS country_name
  FROM nation WHERE n_regionkey <> 2),
cpick AS (SELECT c.* FROM countries c
          JOIN (SELECT iso_code, min(id) AS id FROM countries GROUP BY iso_code) m ON c.id = m.id),
admins AS (
  SELECT 'admin1' AS level, CAST(min(c_custkey) AS INTEGER) AS id, cc || '.' || a1 AS code, a1 || ' area' AS name
  FROM base WHERE cc IS NOT NULL AND a1 IS NOT NULL AND a1 <> 'FURNITURE' AND cc <> 'GB' GROUP BY cc, a1
  UNION ALL
  SELECT 'admin2', CAST(min(c_custkey) AS INTEGER), cc || '.' || a1 || '.' || a2, n_name
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
""" + f"""largest AS (SELECT * FROM city QUALIFY {sql_largest(CITY_KEYS)})
SELECT * FROM largest QUALIFY {sql_not_first(CITY_KEYS)}"""


# ---------------------------------------------------------------------------
# Country names end to end: customers as countries, document lines as their
# alternates; every customer gets its own name if missing (even with no
# alternates), then dense ids from 10001.
# ---------------------------------------------------------------------------

def q_country_names(spark: SparkSession, d: str) -> DataFrame:
    countries = _t(spark, d, "customer").select(
        F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("country_name"))
    alts = materialize(q_alt_names(spark, d))
    names = build_country_names(countries, alts)
    return with_ids(names, ["country_id", "alt_name"], COUNTRY_NAMES_FIRST_ID)


SQL_COUNTRY_NAMES = f"""WITH alts AS ({_sql_alt_names(True)}),
countries AS (SELECT CAST(c_custkey AS INTEGER) AS country_id, c_name AS country_name FROM customer),
spelled AS (SELECT country_name, bool_or(alt_name = country_name) AS named
            FROM countries JOIN alts ON id = country_id GROUP BY country_name),
rows AS (
  SELECT country_id, country_name, alt_name, langs AS langlist FROM alts JOIN countries ON country_id = id
  UNION ALL
  SELECT country_id, country_name, country_name, '' FROM countries LEFT JOIN spelled USING (country_name)
  WHERE named IS DISTINCT FROM true)
SELECT CAST(10000 + row_number() OVER (ORDER BY country_id, alt_name) AS INTEGER) AS id, * FROM rows"""

# ---------------------------------------------------------------------------
# Consumers: customers' names looked up among the names given in orders, and
# the nations of each region from a comma list.
# ---------------------------------------------------------------------------

def q_resolve_places(spark: SparkSession, d: str) -> DataFrame:
    customers = _t(spark, d, "customer").select("c_custkey", "c_name")
    return resolve_places(customers, "c_name", order_names(spark, d), "place_id")


SQL_RESOLVE = f"""WITH {SQL_ORDER_NAMES},
given AS (SELECT {_sql_clean('alt_name')} AS spelling, list(DISTINCT place_id) AS places FROM names GROUP BY 1)
SELECT c_custkey, c_name, unnest(coalesce(places, [NULL])) AS candidate, coalesce(len(places), 0)::BIGINT AS candidates
FROM customer LEFT JOIN given ON spelling = {_sql_clean('c_name')}"""


def q_region_members(spark: SparkSession, d: str) -> DataFrame:
    nations = _t(spark, d, "nation")
    regions = nations.groupBy(F.col("n_regionkey").alias("region_id")).agg(F.array_join(F.sort_array(F.collect_list("n_name")), ",").alias("members"))
    countries = nations.select(F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("iso_code"))
    return explode_region_members(regions, countries)


SQL_REGION_MEMBERS = "SELECT n_regionkey AS region_id, n_name AS member, n_nationkey AS country_id FROM nation"

# ---------------------------------------------------------------------------
# Files and layouts: document texts as quoted fields over many lines, bad
# records in a file of orders, names by an index, alternates by their cluster.
# ---------------------------------------------------------------------------

def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_quoted_line_breaks(spark: SparkSession, d: str) -> DataFrame:
    """Every document written as a record of a tab-separated file, its whole text
    a quoted field over as many lines as it has, and read back by byte ranges."""
    path = _scratch(spark, "quoted")
    docs = _t(spark, d, "documents").select("doc_id", "lang", "source", "text")
    docs.write.options(sep="\t", quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    schema = T.StructType([docs.schema[c] for c in docs.columns])
    read = read_tsv(spark, path, schema, multi_line=True)
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return read.select("doc_id", "lang", "source", "text", lines.cast("long").alias("lines"))


SQL_QUOTED = """SELECT doc_id, NULLIF(lang, '') AS lang, NULLIF(source, '') AS source, NULLIF(text, '') AS text,
       CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS lines FROM documents
"""


def q_malformed_records(spark: SparkSession, d: str) -> DataFrame:
    """Orders as dump lines with a customer, a status code and a price; urgent
    orders have a word for the price, finished ones a field too many, and orders
    of middle priority no customer. Every bad record, with what is wrong."""
    path = _scratch(spark, "malformed")
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("free")).otherwise(F.col("o_totalprice").cast("string"))
    customer = F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_custkey").cast("string")).otherwise("")
    extra = F.when(F.col("o_orderstatus") == "F", F.lit("\textra")).otherwise("")
    lines = _t(spark, d, "orders").select(F.concat(F.concat_ws("\t", F.col("o_orderkey").cast("string"), customer, "o_orderstatus", price), extra).alias("value"))
    lines.write.text(path)
    schema = T.StructType.fromDDL("order_id long, customer_id long, status string, price double")
    bad = malformed_records(spark, path, schema, required=["customer_id"])
    return bad.select(F.split("record", "\t")[0].cast("long").alias("order_id"), "reason", (F.col("line") > 0).alias("placed"))


SQL_MALFORMED = """SELECT o_orderkey AS order_id,
  CASE WHEN o_orderstatus = 'F' THEN 'wrong number of fields, or not a number'
       WHEN o_orderpriority = '1-URGENT' THEN 'not a number in price'
       ELSE 'no customer_id' END AS reason, true AS placed
FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority IN ('1-URGENT', '3-MEDIUM')"""


def q_find_names(spark: SparkSession, d: str) -> DataFrame:
    """The names of parts and of their types, indexed; the name of the smallest
    part of each brand looked up."""
    part = _t(spark, d, "part")
    names = part_names(spark, d).select("id", "alt_name")
    index = write_name_index(names, _scratch(spark, "name-index"))
    smallest = part.groupBy("p_brand").agg(F.min(F.struct("p_size", "p_partkey", "p_name")).alias("s")).select(F.concat(F.lit(" "), "s.p_name").alias("text"))
    return find_names(index, smallest, "text")


SQL_FIND_NAMES = f"""WITH smallest AS (SELECT ' ' || p_name AS text FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) = 1)
SELECT id, alt_name FROM (SELECT p_partkey AS id, unnest([p_name, p_type]) AS alt_name FROM part)
WHERE {_sql_clean('alt_name')} IN (SELECT {_sql_clean('text')} FROM smallest)"""


def q_attach_clustered(spark: SparkSession, d: str) -> DataFrame:
    """``attach_alternates`` over alternates stored by clusters of their id, the
    documents too many to broadcast: only they are exchanged."""
    alts = write_clustered(aggregate_alt_names(doc_line_alternates(spark, d), _languages(spark)), _scratch(spark, "clustered"),
                           ["id"], 8, ["id", "alt_name"])
    docs = _t(spark, d, "documents").select("doc_id", "source")
    return attach_alternates(docs, alts, entity_id="doc_id", max_broadcast_rows=0)


SQL_ATTACH_CLUSTERED = f"""WITH alts AS ({_sql_alt_names(True)})
SELECT doc_id, source, alt_name, langs AS langlist FROM documents JOIN alts ON doc_id = id"""

FLAGSHIP = "city_names"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "alt_names": q_alt_names,
    "alt_names_all_scripts": q_alt_names_all_scripts,
    "alt_names_words": q_alt_names_words,
    "latin_only": q_latin_only,
    "alt_names_real_languages": q_alt_names_real_languages,
    "resolve_places": q_resolve_places,
    "region_members": q_region_members,
    "exclude_codes": q_exclude_codes,
    "clean_names": q_clean_names,
    "drop_smaller_dups": q_drop_smaller_dups,
    "drop_min_id_dups": q_drop_min_id_dups,
    "dedupe_places": q_dedupe_places,
    "enrich_lookup": q_enrich_lookup,
    "enrich_lookup_first_match": q_enrich_lookup_first_match,
    "drop_ambiguous": q_drop_ambiguous,
    "lang_codes": q_lang_codes,
    "countries": q_countries,
    "select_regions": q_select_regions,
    "missing_default_country": q_missing_default_country,
    "missing_default_city": q_missing_default_city,
    "attach_alternates": q_attach_alternates,
    "disamb_code": q_disamb_code,
    "reassign_orphans": q_reassign_orphans,
    "drop_obsolete": q_drop_obsolete,
    "surrogate_ids": q_surrogate_ids,
    "city_names": q_city_names,
    "curate_cities": q_curate_cities,
    "country_names": q_country_names,
    "quoted_line_breaks": q_quoted_line_breaks,
    "malformed_records": q_malformed_records,
    "find_names": q_find_names,
    "attach_clustered": q_attach_clustered,
}

ORACLE: dict[str, str] = {
    "quoted_line_breaks": SQL_QUOTED,
    "malformed_records": SQL_MALFORMED,
    "find_names": SQL_FIND_NAMES,
    "attach_clustered": SQL_ATTACH_CLUSTERED,
    "alt_names": _sql_alt_names(True),
    "alt_names_all_scripts": _sql_alt_names(False),
    "alt_names_words": _sql_alt_names(False, SQL_DOC_WORDS),
    "latin_only": SQL_LATIN_ONLY,
    "alt_names_real_languages": SQL_REAL_LANGUAGES,
    "resolve_places": SQL_RESOLVE,
    "region_members": SQL_REGION_MEMBERS,
    "exclude_codes": SQL_EXCLUDE_CODES,
    "clean_names": SQL_CLEAN_NAMES,
    "drop_smaller_dups": SQL_DROP_SMALLER,
    "drop_min_id_dups": SQL_DROP_MIN_ID,
    "dedupe_places": SQL_DEDUPE,
    "enrich_lookup": SQL_ENRICH,
    "enrich_lookup_first_match": SQL_ENRICH_FIRST,
    "drop_ambiguous": SQL_DROP_AMBIGUOUS,
    "lang_codes": SQL_LANG_CODES,
    "countries": SQL_COUNTRIES,
    "select_regions": SQL_SELECT_REGIONS,
    "missing_default_country": SQL_MISSING_COUNTRY,
    "missing_default_city": SQL_MISSING_CITY,
    "attach_alternates": SQL_ATTACH,
    "disamb_code": SQL_DISAMB,
    "reassign_orphans": SQL_REASSIGN,
    "drop_obsolete": SQL_DROP_OBSOLETE,
    "surrogate_ids": SQL_SURROGATE,
    "city_names": SQL_CITY_NAMES,
    "curate_cities": SQL_CURATE_CITIES,
    "country_names": SQL_COUNTRY_NAMES,
}
