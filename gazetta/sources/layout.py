"""Table layouts: clustered by a key, indexed by a name, or in order.

* ``write_clustered`` / ``read_clustered``: one file a bucket of the key's hash,
  sorted. A join on the key reads the table where it lies; only the other side
  moves (to the same buckets).
* ``write_name_index`` / ``find_names``: ranges of a text column, sorted, in small
  row groups with value ranges and bloom filters, so that a lookup of few names
  reads few row groups.
* ``in_order``: rows in ascending files, so that reading the files one after the
  other gives the order.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gazetta.functions.text import clean_name
from gazetta.operators.lookup import broadcast_if_bounded, is_small
from gazetta.session import list_names

#: Names that are looked up as a list of values (more are joined), and their bytes.
LOOKUP_NAMES, LOOKUP_BYTES = 1_000, 1 << 20
SPELLING = "spelling"
#: The file that says how a table is clustered; readers of the data skip it.
_SPEC = "_layout"


def in_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in ranges of ``keys``, each sorted: written, file after file ascends.
    Rows of equal keys stay together in a range, so give keys that tell rows apart."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], buckets: int, sort: Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` with one file for each of ``buckets`` hash buckets of
    ``keys``, sorted by ``sort`` (the keys, by default), and read it back clustered.

    All rows of a key lie in one bucket, so size the buckets for the largest key.
    """
    spark = df.sparkSession
    sort = list(sort or keys)
    name = f"clustered_{uuid.uuid4().hex}"
    # The same hash and number as the table's, so a task holds a bucket and writes one file.
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*sort)
     .option("path", path).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # of the catalog; the files stay
    spec = spark.range(1).select(F.to_json(F.struct(
        F.lit(df.schema.json()).alias("schema"), F.lit(buckets).alias("buckets"),
        F.array(*map(F.lit, keys)).alias("keys"), F.array(*map(F.lit, sort)).alias("sort"))).alias("value"))
    spec.coalesce(1).write.text(f"{path.rstrip('/')}/{_SPEC}")
    return read_clustered(spark, path)


def is_clustered(spark: SparkSession, path: str) -> bool:
    return _SPEC in list_names(spark, path)


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_clustered``: an entry of the session's catalog over its
    files, which tells the planner how they are clustered."""
    spec = spark.read.schema("schema string, buckets int, keys array<string>, sort array<string>").json(f"{path.rstrip('/')}/{_SPEC}").first()
    schema = StructType.fromJson(json.loads(spec["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    name = "clustered_" + re.sub(r"\W", "_", path)[-40:] + "_" + uuid.uuid4().hex[:12]
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({quoted(spec['keys'])}) SORTED BY ({quoted(spec['sort'])}) "
              f"INTO {spec['buckets']} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def write_name_index(df: DataFrame, path: str, name_col: str = "alt_name", row_group_bytes: int = 1 << 20, page_bytes: int = 64 << 10) -> DataFrame:
    """Write ``df`` plus the cleaned ``spelling`` of ``name_col``, by ranges of
    that, sorted, in row groups of about ``row_group_bytes``, each with a bloom
    filter of its spellings. (Names may hold characters that cleaning drops.)"""
    # The other columns split a name of very many rows over ranges.
    keys = [SPELLING, *[f.name for f in df.schema.fields if f.dataType.simpleString() in ("int", "bigint", "string")]]
    (df.withColumn(SPELLING, clean_name(name_col)).repartitionByRange(*keys).sortWithinPartitions(*keys).write
     .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option(f"parquet.bloom.filter.enabled#{SPELLING}", "true").parquet(path))
    return df.sparkSession.read.parquet(path)


def find_names(index: DataFrame, texts: DataFrame, text_col: str) -> DataFrame:
    """Rows of a name index that spell one of the texts, cleaned alike: by a list
    of values that reaches the scan if they are few, else by a join."""
    wanted = texts.select(clean_name(text_col).alias("__name")).where("__name IS NOT NULL").distinct()
    if is_small(wanted, LOOKUP_NAMES, LOOKUP_BYTES):
        names = [r["__name"] for r in wanted.collect()]  # at most LOOKUP_NAMES
        found = index.where(F.col(SPELLING).isin(names) if names else F.lit(False))
    else:
        found = index.join(broadcast_if_bounded(wanted), F.col(SPELLING) == F.col("__name"), "left_semi")
    return found.drop(SPELLING)
