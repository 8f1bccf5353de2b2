"""Uses of a finished gazetteer: finding places by name, members of regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.functions.text import clean_name
from gazetta.operators.lookup import broadcast_if_bounded


def resolve_places(df: DataFrame, text_col: str, names: DataFrame, place_id: str, alt_col: str = "alt_name") -> DataFrame:
    """Each row of ``df`` with the places that its text may name.

    Both sides are cleaned alike and joined on equality; a place counts once
    however many of its names match. Adds ``candidate`` (a place id, NULL if
    none) and ``candidates`` (how many places the text may name). The counts
    come from the names, one per name, so a text repeated on very many rows is
    never grouped.
    """
    known = names.select(clean_name(alt_col).alias("__name"), F.col(place_id).alias("candidate")).distinct()
    counts = known.groupBy("__name").agg(F.count(F.lit(1)).alias("candidates"))
    known = known.join(counts, "__name")
    joined = df.withColumn("__text", clean_name(text_col)).join(known, F.col("__text") == F.col("__name"), "left")
    return joined.select(*df.columns, "candidate", F.coalesce("candidates", F.lit(0)).cast("long").alias("candidates"))


def explode_region_members(regions: DataFrame, countries: DataFrame, members_col: str = "members", code_col: str = "iso_code") -> DataFrame:
    """One row per region and member code, with the countries of that code
    (NULL columns for a code of no country); a region without members has none."""
    rows = regions.withColumn("member", F.explode(F.split(members_col, ","))).drop(members_col)
    side = broadcast_if_bounded(countries.select(F.col(code_col).alias("__code"), *(c for c in countries.columns if c != code_col)))
    return rows.join(side, F.col("member") == F.col("__code"), "left").drop("__code")
