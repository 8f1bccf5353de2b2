"""The whole gazetteer build: dump files in, curated tables out.

Steps (each table written as Parquet under ``<out>/<schema>/<table>`` and read
back before use, which both publishes it and cuts the lineage):

1. languages     -> geo.lang_codes, src.lang_codes
2. alternates    -> geo.alt_names
3. admin areas   -> geo.adm1s, geo.adm2s
4. countries     -> geo.countries, src.countries, src.country_names
5. cities        -> geo.cities, src.cities, src.city_names
6. regions       -> src.regions

The seven files are landed concurrently (independent jobs); then the alternate-name chain
and the places chain run concurrently; the two names tables come last.
"""

from __future__ import annotations

import logging
import os
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gazetta.operators.dedup import dedupe_places, drop_ambiguous_alternates
from gazetta.operators.keys import assert_unique
from gazetta.operators.lookup import broadcast_if_bounded
from gazetta.operators.names import aggregate_alt_names, filter_alternate_names
from gazetta.plans.tables import (
    CITY_NAMES_FIRST_ID,
    COUNTRY_NAMES_FIRST_ID,
    build_admins,
    CITY_DUP_KEYS,
    build_countries,
    build_country_names,
    build_lang_codes,
    complete_city_names,
    curate_countries,
    drop_obsolete_countries,
    match_cities,
    select_regions,
    stage_cities,
    stage_lang_codes,
    with_ids,
)
from gazetta.session import delete_path, list_names, stored, stored_in
from gazetta.sources.geonames import (
    QUOTE_CSV,
    first_malformed,
    land,
    read_admins,
    read_alt_names,
    read_countries,
    read_lang_codes,
    read_places,
    write_table,
)
from gazetta.sources.layout import in_order, is_clustered, read_clustered, write_clustered, write_name_index

# --- fixed values -----------------------------------------------------------
# File names of the dump, as published.
FILES = {
    "lang_codes": "iso-languagecodes.txt",
    "alt_names": "alternateNamesV2.txt",
    "admin1": "admin1CodesASCII.txt",
    "admin2": "admin2Codes.txt",
    "countries": "countryInfo.txt",
    "cities": "cities5000.txt",
    "regions": "no-country.txt",
}
# -----------------------------------------------------------------------------

log = logging.getLogger("gazetta")

# Every table a run writes, as <schema>.<table>.
TABLES = (
    "geo.lang_codes", "src.lang_codes", "geo.alt_names", "geo.adm1s", "geo.adm2s", "geo.countries",
    "src.countries", "src.country_names", "geo.cities", "src.cities", "src.city_names", "src.regions",
    "src.step_counts",
)
# Layout of a published output folder.
RUNS = "runs"
PUBLISHED = "published"
# Alternates of known countries and cities only: a table of its own, never
# geo.alt_names.
USED_ALT_NAMES = "geo.used_alt_names"

# Place ids (countries + cities) broadcast for the alternate-name reduction.
SEMI_JOIN_BROADCAST_ROWS = 5_000_000


def build_gazetteer(
    spark: SparkSession,
    data_dir: str,
    out_dir: str,
    include_nonlatin: bool = False,
    quoting: str = QUOTE_CSV,
    keep_all_alt_names: bool = True,
    files: dict[str, str] | None = None,
    publish: bool = True,
    multi_line: bool = False,
    keep_runs: int | None = None,
    alternate_buckets: int | None = None,
    index_names: bool = False,
) -> dict[str, DataFrame]:
    """Build every table; return them (re-read from where they were written) by name.

    With ``publish`` (the default) a run writes into its own folder
    ``<out_dir>/runs/<run id>/`` and, only once every table is written, adds the
    entry ``<out_dir>/published/<run id>``, which is never changed again: readers
    (``load_gazetteer``) take the newest complete entry, so they see the
    previous gazetteer until then, and a failed run publishes nothing.
    ``keep_runs`` then deletes all but that many of the newest runs. With
    ``publish=False`` the tables are rebuilt in place under ``out_dir``. The
    landed copies of the input files go when the tables are written.

    ``include_nonlatin`` keeps alternate names that fail the 'Latin' test.
    ``keep_all_alt_names=False`` first semi-joins the alternates with the
    ids of countries and cities -- the only ones ever used -- so the big
    aggregation only sees rows that matter; the result is the table
    ``geo.used_alt_names`` then, and there is no ``geo.alt_names``.
    ``alternate_buckets`` clusters the alternates by id into so many buckets,
    sorted by id and name: a later join on the id with a large table of places
    leaves them where they are. ``index_names`` also writes the city names by
    name (``src.city_names_by_name``), for lookups of few names.
    ``multi_line`` accepts quoted line breaks. A bad record stops the build with
    an error that names its file and line.
    """
    now = time.time_ns()
    run_id = time.strftime("%Y%m%dT%H%M%S", time.gmtime(now // 10**9)) + f".{now % 10**9:09d}-" + uuid.uuid4().hex[:8]
    root = os.path.join(out_dir, RUNS, run_id) if publish else out_dir
    f = {**FILES, **(files or {})}
    src = lambda k: os.path.join(data_dir, f[k])
    landed = lambda k: os.path.join(root, "_landed", k)
    with stored_in(os.path.join(root, "_landed")):  # goes with the landed files
        out = _build(spark, src, root, landed, include_nonlatin, quoting, keep_all_alt_names, multi_line, alternate_buckets, index_names)
    delete_path(spark, os.path.join(root, "_landed"))
    if publish:
        publish_run(spark, out_dir, run_id, list(out), keep_runs)
    return out


def _together(tasks: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Run independent jobs at the same time, with the caller's job group, local
    properties and scratch folder; the first error of any is raised."""
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = {k: pool.submit(copy_context().run, inheritable_thread_target(f)) for k, f in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def _build(
    spark: SparkSession, src: Callable[[str], str], root: str, landed: Callable[[str], str],
    include_nonlatin: bool, quoting: str, keep_all_alt_names: bool, multi_line: bool, alternate_buckets: int | None, index_names: bool,
) -> dict[str, DataFrame]:
    """Every table of a run, written under ``root``. Steps are counted on the
    writes (``Observation``); no job only counts."""
    out: dict[str, DataFrame] = {}
    rows: dict[str, int] = {}

    def write(df: DataFrame, table: str, save: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
        out[table] = write_table(df, root, *table.split("."), rows, save)
        return out[table]

    # Land the seven files first. They are independent, so their jobs are
    # submitted together: the small files' jobs fill the slots that the big
    # alternate-name file leaves free instead of queueing behind it.
    readers = {
        "lang_codes": (read_lang_codes, "lang_codes"), "admin1": (read_admins, "admins"), "admin2": (read_admins, "admins"),
        "countries": (read_countries, "countries"), "cities": (read_places, "places"), "regions": (read_places, "places"),
        "alt_names": (read_alt_names, "alt_names"),
    }
    place = lambda k, kind: lambda: first_malformed(spark, src(k), kind, quoting, multi_line)
    # alternates without a real language or, unless asked for, of other scripts end here: checked, but not written
    used = {"alt_names": lambda df: filter_alternate_names(df, not include_nonlatin).select("geoname_id", "iso_language", "alternate_name")}
    raw = _together({
        k: lambda k=k, read=read, kind=kind: land(read(spark, src(k), quoting, multi_line), landed(k), kind, place(k, kind), used.get(k))
        for k, (read, kind) in readers.items()})

    def languages_and_alternates() -> None:
        write(stage_lang_codes(raw["lang_codes"]), "geo.lang_codes")
        write(in_order(build_lang_codes(out["geo.lang_codes"]), ["code", "code_type", "name"]), "src.lang_codes")
        raw_alt = raw["alt_names"]
        if not keep_all_alt_names:
            used = raw["countries"].select(F.col("geonameid").alias("__id")).unionByName(
                raw["cities"].select(F.col("geonameid").alias("__id"))
            )
            used = broadcast_if_bounded(used, SEMI_JOIN_BROADCAST_ROWS)
            raw_alt = raw_alt.join(used, raw_alt["geoname_id"] == used["__id"], "left_semi")
        alt = aggregate_alt_names(raw_alt, out["src.lang_codes"], latin_only=not include_nonlatin)
        alt = alt.select(F.col("id").cast("int").alias("id"), "alt_name", "langs")
        clustered = (lambda df, path: write_clustered(df, path, ["id"], alternate_buckets, ["id", "alt_name"])) if alternate_buckets else None
        write(alt, "geo.alt_names" if keep_all_alt_names else USED_ALT_NAMES, clustered)

    cities_counted = Observation()

    def places() -> None:
        _together({
            "adm1s": lambda: write(build_admins(raw["admin1"]), "geo.adm1s"),
            "adm2s": lambda: write(build_admins(raw["admin2"]), "geo.adm2s"),
            "countries": lambda: write(in_order(drop_obsolete_countries(curate_countries(
                write(build_countries(raw["countries"]), "geo.countries"))), ["country_name", "id"]), "src.countries"),
            "cities": lambda: write(stage_cities(raw["cities"]), "geo.cities"),
        })
        admins = out["geo.adm1s"].select(F.lit("admin1").alias("level"), "id", "code", "name").unionByName(
            out["geo.adm2s"].select(F.lit("admin2").alias("level"), "id", "code", "name")
        )
        matched = stored(match_cities(out["geo.cities"], out["src.countries"], admins), "cities")
        tied = lambda level: (F.col("disamb_type") == level) & F.col("disamb_id").isNotNull()
        curated = dedupe_places(matched, list(CITY_DUP_KEYS), "pop", "id", cities_counted,
                                {"admin1": F.coalesce(tied("admin1"), F.lit(False)), "admin2": F.coalesce(tied("admin2"), F.lit(False))})
        write(curated, "src.cities")

    # The alternate names, the places and the regions do not depend on each
    # other; the names tables need the first two.
    _together({"alternates": languages_and_alternates, "places": places,
               "regions": lambda: write(select_regions(raw["regions"]), "src.regions")})
    alt_names = out["geo.alt_names" if keep_all_alt_names else USED_ALT_NAMES]
    countries_named, cities_named = Observation(), Observation()

    def country_names() -> None:
        # names of all countries; retired ones are dropped afterwards
        names = stored(build_country_names(curate_countries(out["geo.countries"]), alt_names, countries_named), "country-names")
        write(with_ids(drop_obsolete_countries(names), ["country_id", "alt_name"], COUNTRY_NAMES_FIRST_ID), "src.country_names")

    def city_names() -> None:
        names = stored(complete_city_names(out["src.cities"], alt_names, cities_named), "city-names")
        clear = drop_ambiguous_alternates(names, "country_name", "alt_name", "city_name")
        write(with_ids(clear, ["city_id", "alt_name"], CITY_NAMES_FIRST_ID), "src.city_names")
        if index_names:
            write(out["src.city_names"], "src.city_names_by_name", write_name_index)

    _together({
        "country names": country_names, "city names": city_names,
        "languages": lambda: assert_unique(out["src.lang_codes"], ["code"], "src.lang_codes"),
        "countries": lambda: assert_unique(out["geo.countries"], ["id"], "geo.countries"),
        "cities": lambda: assert_unique(out["geo.cities"], ["id"], "geo.cities"),
    })
    city, named, c_named = cities_counted.get, cities_named.get, countries_named.get
    steps = {
        "cities matched to admin 1": city["admin1"], "cities matched to admin 2": city["admin2"],
        "cities deleted: smaller duplicates": city["smaller"], "cities deleted: smallest id of duplicates": city["smallest_id"],
        "country names created": c_named["created"], "country names: defaults added": c_named["added"],
        "city names created": named["created"], "city names: defaults added": named["added"],
        "city names deleted: ambiguous": named["created"] + named["added"] - rows["src.city_names"],
        "language codes": rows["src.lang_codes"],
    }
    for step, n in steps.items():
        log.info("%s: %d", step, n)
    pairs = F.array(*[F.struct(F.lit(step).alias("step"), F.lit(n).cast("long").alias("rows")) for step, n in steps.items()])
    write(spark.range(1).select(F.inline(pairs)), "src.step_counts")
    return out


def publish_run(spark: SparkSession, out_dir: str, run_id: str, tables: list[str], keep_runs: int | None = None) -> None:
    """Add the entry of a finished run (it is complete when Spark's writer has
    committed it), then drop runs beyond ``keep_runs``, entries first."""
    spark.createDataFrame([(t,) for t in tables], "value string").coalesce(1).write.text(os.path.join(out_dir, PUBLISHED, run_id))
    if keep_runs is not None:
        for old in published_runs(spark, out_dir)[:-max(1, keep_runs)]:
            delete_path(spark, os.path.join(out_dir, PUBLISHED, old))
            delete_path(spark, os.path.join(out_dir, RUNS, old))


def published_runs(spark: SparkSession, out_dir: str) -> list[str]:
    """Ids of the complete runs, oldest first."""
    folder = os.path.join(out_dir, PUBLISHED)
    return [x for x in list_names(spark, folder) if "_SUCCESS" in list_names(spark, os.path.join(folder, x))]


def load_gazetteer(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The tables of the last published run, by name (``'src.city_names'`` ...)."""
    runs = published_runs(spark, out_dir)
    if not runs:
        raise FileNotFoundError(f"no published run in {out_dir}")
    tables = [r["value"] for r in spark.read.text(os.path.join(out_dir, PUBLISHED, runs[-1])).collect()]  # a dozen names
    root = os.path.join(out_dir, RUNS, runs[-1])
    paths = {t: os.path.join(root, *t.split(".")) for t in tables}
    return {t: read_clustered(spark, p) if is_clustered(spark, p) else spark.read.parquet(p) for t, p in paths.items()}
