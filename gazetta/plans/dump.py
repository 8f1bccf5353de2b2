"""GeoNames-format dump files derived from the driver's tables.

Lets the whole build (strict TSV landing included) run on data that grows
with the driver tables: every word of every document is an alternate name
of the place with the document's id; customers are cities (id = custkey +
25, so documents 25+ name cities and documents 0-24 name countries);
nations are countries; admin areas come from grouping the customers; events
are the non-country features. Each file is written by Spark as a directory
of tab-separated, compressed part files, which the readers accept as one input.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from gazetta.plans import driver
from gazetta.plans.gazetteer import FILES

# Compressed files are read by one task each, so none may hold more rows.
COMPRESSION, ROWS_PER_FILE = "lz4", 2_000_000
CITY_ID_OFFSET = 25
REGION_ID_OFFSET = 10_000_000
# Sources whose words stand for links, airport codes and the like: their
# language is no language, and the build drops them.
PSEUDO_SOURCES = {"src3": "link", "src7": "iata", "src11": "wkdt"}
SQL_LANGUAGE_OF_SOURCE = "CASE source " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PSEUDO_SOURCES.items()) + " ELSE lang END"


def language_of_source() -> Column:
    out = F.col("lang")
    for source, code in PSEUDO_SOURCES.items():
        out = F.when(F.col("source") == source, F.lit(code)).otherwise(out)
    return out


def _writer(df: DataFrame) -> DataFrameWriter:
    return df.write.mode("overwrite").option("compression", COMPRESSION).option("maxRecordsPerFile", ROWS_PER_FILE)


def _write(df: DataFrame, path: str, header: bool = False) -> None:
    (_writer(df).option("sep", "\t").option("header", str(header).lower())
     .option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path))


def _field(c: Column) -> Column:
    """A text as a field of a line, quoted if it holds a tab, a quote or a line break."""
    special = F.contains(c, F.lit('"')) | F.contains(c, F.lit("\t")) | F.contains(c, F.lit("\n")) | F.contains(c, F.lit("\r"))
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(special, quoted).otherwise(c), F.lit(""))


def _blank(n: int) -> list:
    return [F.lit(None).cast("string") for _ in range(n)]


def write_dump(spark: SparkSession, sf_dir: str, out_dir: str) -> str:
    path = lambda k: os.path.join(out_dir, FILES[k])
    langs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang").distinct().join(driver._languages(spark), F.col("lang") == F.col("code"), "left")
    _write(langs.select(
        F.concat(F.col("lang"), F.col("lang")).alias("ISO 639-3"), F.concat(F.col("lang"), F.col("lang")).alias("ISO 639-2"),
        F.col("lang").alias("ISO 639-1"), F.coalesce(F.col("name"), F.upper("lang")).alias("Language Name")),
        path("lang_codes"), header=True)

    # words split per line after the lines are spread (exactly the whole-text split);
    # ids only need to be unique, and the file is written once
    # by far the longest file: its lines are put together here, at half the cost of the CSV
    # writer; what all words of a document share is made once a document, before they are split
    shared = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\t"), _field(language_of_source()), F.lit("\t"))
    words = driver.doc_words(spark, sf_dir, shared)
    line = F.concat(F.monotonically_increasing_id().cast("string"), F.lit("\t"), F.col("iso_language"), _field(F.col("alternate_name")), F.lit("\t" * 6))
    _writer(words.select(line.alias("value"))).text(path("alt_names"))

    admins = driver.customer_admins(spark, sf_dir)
    for level, key in (("admin1", "admin1"), ("admin2", "admin2")):
        a = admins.where(F.col("level") == level)
        _write(a.select("code", "name", "name", (F.col("id") + CITY_ID_OFFSET).alias("geonameid")), path(key))

    c = driver.nation_countries(spark, sf_dir)
    rk_iso = F.concat(F.lit("C"), F.col("n_regionkey").cast("string"))
    nation = driver._dim(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    c = c.join(nation, c["geonameid"] == nation["n_nationkey"])
    iso = F.when(F.col("n_regionkey") == 2, F.lit("HK")).when(F.col("n_regionkey") == 3, F.lit("GB")).otherwise(rk_iso)
    # the region-2 countries stand for the retired Hong Kong, removed by name
    name = F.when(F.col("n_regionkey") == 2, F.lit("Hong Kong")).otherwise(F.col("country"))
    _write(c.select(
        iso, F.concat(iso, F.lit("X")), F.col("geonameid").cast("int"), F.lit(None).cast("string"), name,
        F.lit(None).cast("string"), F.lit(1.0), "population", "continent", *_blank(6), "languages",
        "geonameid", *_blank(2)), path("countries"))

    raw = driver.customer_raw_cities(spark, sf_dir)
    _write(raw.select(
        (F.col("geonameid") + CITY_ID_OFFSET).alias("geonameid"), "name", "name", F.lit(None).cast("string"),
        "latitude", "longitude", F.lit("P"), F.lit("PPL"), "country_code", F.lit(None).cast("string"),
        "admin1_code", "admin2_code", *_blank(2), F.col("population").cast("long"), *_blank(2),
        F.lit("UTC"), F.lit("2024-01-01")), path("cities"))

    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    fc = (F.when(F.col("event_type") == "view", F.lit("RGN")).when(F.col("event_type") == "signup", F.lit("CONT"))
          .otherwise(F.upper("event_type")))
    _write(ev.select(
        (F.col("event_id") + REGION_ID_OFFSET).alias("geonameid"), "props", "props", F.lit(None).cast("string"),
        F.lit(0.0), F.lit(0.0), F.lit("L"), fc, F.lit(None).cast("string"), F.col("user_id").cast("string"),
        *_blank(4), F.lit(None).cast("long"), *_blank(2), F.lit("UTC"), F.lit("2024-01-01")), path("regions"))
    return out_dir
