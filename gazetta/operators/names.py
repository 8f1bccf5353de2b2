"""Alternate-name operators: aggregation, attachment, default completion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gazetta.functions.text import (
    PSEUDO_LANGUAGES,
    clean_name,
    is_latin_name,
    language_or_none,
    not_pseudo_language,
)
from gazetta.operators.keys import fresh
from gazetta.operators.lookup import broadcast_if_bounded, broadcast_if_small_result, sized_result

# Distinct values (languages) that an aggregation state may count, and rows of a
# language table that is broadcast. There are at most 26 * 26 two-letter codes.
MAX_COUNTED_VALUES = 10_000
# Languages that have a column of counts each (8 bytes a name); with more of
# them, the state holds only those that a name has.
MAX_VALUE_COLUMNS = 16


def filter_alternate_names(
    raw: DataFrame,
    latin_only: bool = True,
    excluded_languages: Sequence[str] = PSEUDO_LANGUAGES,
    language_col: str = "iso_language",
    name_col: str = "alternate_name",
) -> DataFrame:
    """Drop pseudo-language rows and, optionally, names that are not 'Latin'.

    Both tests look at the raw values: the language before it defaults to
    ``'none'`` (so a missing language is kept) and the name before clean-up.
    """
    keep = not_pseudo_language(language_col, excluded_languages)
    if latin_only:
        keep = keep & is_latin_name(name_col)
    return raw.where(keep)


def _language_names(codes: DataFrame, code_type: str | None) -> DataFrame:
    """(code, name) of the languages used to label alternate names, unique on code."""
    if code_type is not None and "code_type" in codes.columns:
        codes = codes.where(F.col("code_type") == F.lit(code_type))
    return (
        codes.groupBy(F.col("code").alias("__code"))
        .agg(F.min("name").alias("__lang_name"))
    )


def aggregate_alt_names(
    raw: DataFrame,
    codes: DataFrame,
    latin_only: bool = True,
    excluded_languages: Sequence[str] = PSEUDO_LANGUAGES,
    id_col: str = "geoname_id",
    language_col: str = "iso_language",
    name_col: str = "alternate_name",
    code_type: str | None = "639-1",
) -> DataFrame:
    """Alternate names -> one row per (id, cleaned name) with its language list.

    Output ``(id, alt_name, langs)``. ``langs`` joins the names of the
    languages the name was given in with ``', '``, keeping repeats
    ("English, English"), skipping codes with no 639-1 name, NULL when none
    matched, in alphabetical order.

    Plan: filter and clean per row; broadcast-join the (bounded) language
    table; one aggregation by (id, alt_name) whose state counts each language
    (at most as many as the language table has), merged in the map tasks and
    again after the one exchange; then the counts are expanded into the list.
    For few languages the state is a row of counts, which Spark keeps in a hash
    map; a larger one makes it sort the rows once there are over 128 names. A
    name repeated millions of times therefore never piles its rows into one
    task: each map task sends one state.
    """
    alts = filter_alternate_names(raw, latin_only, excluded_languages, language_col, name_col).select(
        F.col(id_col).alias("id"),
        clean_name(name_col).alias("alt_name"),
        language_or_none(language_col).alias("__lang"),
    )
    names, languages = sized_result(_language_names(codes, code_type), MAX_COUNTED_VALUES)
    labelled = alts.join(names, alts["__lang"] == names["__code"], "left").select(
        "id", "alt_name", "__lang_name"
    )
    known = [r[0] for r in names.select("__lang_name").distinct().collect()] if languages <= MAX_VALUE_COLUMNS else None
    return langs_from_counts(labelled, ["id", "alt_name"], "__lang_name", "langs", values=languages, known=known)


def langs_from_counts(
    df: DataFrame, keys: Sequence[str], value_col: str, out_col: str, sep: str = ", ", values: int | None = None,
    known: Sequence[str | None] | None = None,
) -> DataFrame:
    """Order-defined ``string_agg(value, sep)`` that keeps duplicates and skips NULLs.

    ``known``: all values there are, if few: each is counted in a column of its
    own, in a hash aggregation.
    ``values``: a proven bound of the distinct values. Within
    ``MAX_COUNTED_VALUES``, the values of a key are counted in one mergeable
    state: Spark's frequent-items aggregate, which is exact while it tracks as
    many items as there are values. So rows are exchanged once, after partial
    aggregation. Without such a bound: ``count`` per (keys, value) first, then a
    sorted list of (value, count) pairs per key. Either way state per group
    follows the distinct values, not the rows.
    """
    if known is not None:
        return _langs_from_columns(df, keys, value_col, out_col, sep, sorted(v for v in known if v is not None))
    if values is not None and values < MAX_COUNTED_VALUES:
        tracked = values + 1  # NULL may count as one
        counts = df.groupBy(*keys).agg(F.expr(f"approx_top_k(`{value_col}`, {tracked}, {tracked})").alias("__counts"))
        pairs = counts.select(*keys, F.sort_array(F.transform(
            F.filter("__counts", lambda x: x["item"].isNotNull()), lambda x: F.struct(x["item"].alias("v"), x["count"].alias("n")))).alias("__pairs"))
    else:
        per_value = df.groupBy(*keys, value_col).agg(F.count(F.lit(1)).alias("__n"))
        pair = F.when(F.col(value_col).isNotNull(), F.struct(F.col(value_col).alias("v"), F.col("__n").alias("n")))
        pairs = per_value.groupBy(*keys).agg(F.sort_array(F.collect_list(pair)).alias("__pairs"))
    general = F.array_join(
        F.flatten(F.transform("__pairs", lambda p: F.array_repeat(p["v"], p["n"].cast("int")))), sep
    )
    # most names carry one language: build that string directly, no lambda
    first = F.element_at("__pairs", 1)
    single = F.concat(F.repeat(F.concat(first["v"], F.lit(sep)), first["n"].cast("int") - 1), first["v"])
    size = F.size("__pairs")
    return pairs.select(*keys, F.when(size == 1, single).when(size > 1, general).alias(out_col))


def _langs_from_columns(df: DataFrame, keys: Sequence[str], value_col: str, out_col: str, sep: str, values: Sequence[str]) -> DataFrame:
    """``langs_from_counts`` with one count a value; ``values`` in the order of the list."""
    n = [fresh(keys, f"__n{i}") for i in range(len(values))]
    value = F.col(value_col)
    counts = df.groupBy(*keys).agg(*([F.count(F.when(value == F.lit(v), 1)).alias(c) for c, v in zip(n, values)] or [F.lit(None).alias(fresh(keys, "__none"))]))
    # each value as often as counted, with a separator behind it; the last one goes
    parts = [F.when(F.col(c) > 0, F.repeat(F.lit(v + sep), F.col(c).cast("int"))).otherwise(F.lit("")) for c, v in zip(n, values)]
    text = F.concat(F.lit(""), *parts)
    return counts.select(*keys, F.when(text != "", F.left(text, F.length(text) - F.lit(len(sep)))).alias(out_col))


def attach_alternates(
    entities: DataFrame,
    alt_names: DataFrame,
    entity_id: str = "id",
    alt_id: str = "id",
    entity_cols: Sequence[str] | None = None,
    max_broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Inner join of entities (countries, cities) with their alternate names.

    The entity side is broadcast when a row-count check proves it small
    (countries always are); otherwise both sides are shuffled on the id and
    AQE may still re-plan from run-time sizes.
    """
    cols = list(entity_cols) if entity_cols is not None else list(entities.columns)
    ents = broadcast_if_bounded(entities.select(*cols), max_broadcast_rows)
    alts = alt_names.select(F.col(alt_id).alias("__alt_id"), "alt_name", "langs")
    joined = ents.join(alts, ents[entity_id] == alts["__alt_id"], "inner")
    return joined.select(*[ents[c] for c in cols], F.col("alt_name"), F.col("langs").alias("langlist"))


def add_missing_defaults_by_entity(
    names: DataFrame,
    entity_cols: Sequence[str],
    default_col: str,
    alt_col: str = "alt_name",
    langlist_col: str = "langlist",
    counted: Observation | None = None,
) -> DataFrame:
    """Append a default-name row for every entity lacking one among its names.

    'City mode': only entities that already have at least one alternate can
    get a default row (the rows come from the names table itself), and the
    appended row has a NULL language list. ``entity_cols`` must be
    functionally dependent on the entity id (they come from one entity row),
    which is how names tables are built by ``attach_alternates``.

    One aggregation per entity with a boolean OR, partially aggregated
    map-side, replaces the self anti-join + distinct of a SQL formulation.
    ``counted`` gets the rows ``created`` (there before) and ``added``.
    """
    has_default = F.max(F.coalesce(F.col(default_col) == F.col(alt_col), F.lit(False))).alias("__has")
    missing = (
        names.groupBy(*entity_cols)
        .agg(has_default)
        .where(~F.col("__has"))
        .select(*entity_cols, F.col(default_col).alias(alt_col), F.lit(None).cast("string").alias(langlist_col))
    )
    return _completed(names, missing.select(*names.columns), counted)


def _completed(names: DataFrame, added: DataFrame, counted: Observation | None) -> DataFrame:
    """Both, their rows counted on the way if asked for."""
    if counted is None:
        return names.unionByName(added, allowMissingColumns=True)
    flag = fresh(names.columns, "__added")
    both = names.withColumn(flag, F.lit(False)).unionByName(added.withColumn(flag, F.lit(True)), allowMissingColumns=True)
    return both.observe(counted, F.count_if(~F.col(flag)).alias("created"), F.count_if(F.col(flag)).alias("added")).drop(flag)


def add_missing_defaults_by_name(
    names: DataFrame,
    entities: DataFrame,
    entity_id: str,
    entity_name: str,
    name_id: str,
    name_col: str,
    alt_col: str = "alt_name",
    langlist_col: str = "langlist",
    langlist_value: str | None = "",
    counted: Observation | None = None,
) -> DataFrame:
    """Append a default-name row for every entity whose name is not an alternate.

    'Country mode': driven by the entity table, so an entity with no
    alternates at all gets its default too; matched on the entity *name*
    (``names.name_col = names.alt_col`` rows), and the appended row carries
    ``langlist_value`` (``''`` in the reference behaviour). ``counted`` gets the
    rows ``created`` (there before) and ``added``.
    """
    own = names.where(F.col(name_col) == F.col(alt_col)).select(F.col(name_col).alias("__own")).distinct()
    # at most one row per entity name: computed once, broadcast when small
    own = broadcast_if_small_result(own)
    lacking = entities.join(own, entities[entity_name] == own["__own"], "left_anti")
    added = lacking.select(
        F.col(entity_id).alias(name_id),
        F.col(entity_name).alias(name_col),
        F.col(entity_name).alias(alt_col),
        F.lit(langlist_value).cast("string").alias(langlist_col),
    )
    return _completed(names, added, counted)
