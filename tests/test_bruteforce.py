"""Operators against direct Python implementations on seeded random tables.

Each table holds hundreds of small independent groups (NULL keys, NULL and
negative measures, ties, white space of every kind), so one Spark run checks
many cases at once.
"""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gazetta.functions.text import PSEUDO_LANGUAGES, WHITE_SPACE
from gazetta.operators.dedup import (
    dedupe_places,
    drop_ambiguous_alternates,
    drop_min_id_duplicates,
    drop_smaller_duplicates,
)
from gazetta.operators.keys import assign_dense_ids
from gazetta.operators.lookup import enrich_by_lookup
from gazetta.operators.names import (
    add_missing_defaults_by_entity,
    add_missing_defaults_by_name,
    aggregate_alt_names,
)

R = random.Random(20261202)
KEYS = ["name", "area", "country"]


def maybe(v, p=0.15):
    return None if R.random() < p else v


def places(n=3000, id_type="int"):
    rows = []
    ids = R.sample(range(-50000, 50000), n)
    for i in ids:
        rows.append((i, maybe(R.choice("ABCDEFGH")), maybe(R.choice("xyz"), 0.1), maybe(R.choice("pq"), 0.05),
                     maybe(R.choice([-3, 0, 1, 2, 2, 5, 9]), 0.2)))
    return rows, f"id {id_type}, name string, area string, country string, pop int"


# --- reference semantics, written directly ------------------------------------

def ref_pass1(rows):
    groups = defaultdict(list)
    for r in rows:
        if None not in r[1:4]:
            groups[r[1:4]].append(r)
    drop = set()
    for g in groups.values():
        if len(g) > 1:
            pops = [r[4] for r in g if r[4] is not None]
            mx = max(pops) if pops else None
            drop |= {r[0] for r in g if r[4] is None or mx is None or r[4] != mx}
    return [r for r in rows if r[0] not in drop]


def ref_pass2(rows):
    groups = defaultdict(list)
    for r in rows:
        if None not in r[1:4]:
            groups[r[1:4]].append(r[0])
    victims = {min(g) for g in groups.values() if len(g) > 1}
    return [r for r in rows if r[0] not in victims]


@pytest.mark.parametrize("id_type", ["int", "long"])
def test_dedupe_against_reference(spark, id_type):
    rows, schema = places(id_type=id_type)
    df = spark.createDataFrame(rows, schema)
    ids = lambda d: sorted(r[0] for r in d.select("id").collect())
    assert ids(drop_smaller_duplicates(df, KEYS, "pop")) == sorted(r[0] for r in ref_pass1(rows))
    assert ids(drop_min_id_duplicates(df, KEYS, "id")) == sorted(r[0] for r in ref_pass2(rows))
    assert ids(dedupe_places(df, KEYS, "pop", "id")) == sorted(r[0] for r in ref_pass2(ref_pass1(rows)))


def test_drop_ambiguous_against_reference(spark):
    rows = [(i, maybe(R.choice("UV"), 0.1), maybe(R.choice(["a", "b", "c", "d"]), 0.05),
             maybe(R.choice(["a", "b", "e"]), 0.1)) for i in range(2500)]
    df = spark.createDataFrame(rows, "id int, scope string, alt string, dflt string")
    counts = Counter((r[1], r[2]) for r in rows)
    want = sorted(r[0] for r in rows
                  if not (r[1] is not None and r[2] is not None and counts[(r[1], r[2])] > 1
                          and r[3] is not None and r[2] != r[3]))
    got = sorted(r[0] for r in drop_ambiguous_alternates(df, "scope", "alt", "dflt").collect())
    assert got == want


def test_missing_defaults_against_reference(spark):
    ents = {i: R.choice(["n1", "n2", "n3", "n4"]) + str(i % 7) for i in range(400)}
    rows = []
    for i, name in ents.items():
        for _ in range(R.choice([0, 1, 2, 3])):
            rows.append((i, name, R.choice([name, "other", "x" + str(i % 3)]), "L"))
    names = spark.createDataFrame(rows, "id int, name string, alt_name string, langlist string")
    # city mode: only entities with alternates, matched per id, NULL language list
    have = {r[0] for r in rows if r[1] == r[2]}
    want_city = sorted(rows + [(i, ents[i], ents[i], None) for i in sorted({r[0] for r in rows} - have)],
                       key=str)
    got_city = add_missing_defaults_by_entity(names, ["id", "name"], "name")
    assert sorted(map(tuple, got_city.collect()), key=str) == want_city
    # country mode: every entity, matched on the name anywhere in the table, language list ''
    own_names = {r[1] for r in rows if r[1] == r[2]}
    want_country = sorted(rows + [(i, n, n, "") for i, n in ents.items() if n not in own_names], key=str)
    ent_df = spark.createDataFrame(list(ents.items()), "id int, name string")
    got_country = add_missing_defaults_by_name(names, ent_df, "id", "name", "id", "name")
    assert sorted(map(tuple, got_country.select(*names.columns).collect()), key=str) == want_country


def ref_clean(s):
    return s.strip(WHITE_SPACE).replace(".", "").replace("'", "’")


def test_alt_names_against_reference(spark):
    pieces = ["Rome", " Rome", "Rome.", "O'Hare", "zed", "Zürich", "ZZ", "", " 　X ", ".a", "Ab", "東京"]
    langs = ["en", "fr", "de", "it", None, "link", "iata", "none"]
    rows = [(R.randrange(60), R.choice(langs), R.choice(pieces)) for _ in range(4000)]
    rows += [(7, "en", "Hot")] * 3000 + [(7, "fr", "Hot")] * 1000  # one hot group
    raw = spark.createDataFrame(rows, "geoname_id long, iso_language string, alternate_name string")
    names = {"en": "English", "fr": "French", "de": "German"}
    codes = spark.createDataFrame([(c, n, "639-1") for c, n in names.items()] + [("eng", "English", "639-3")],
                                  "code string, name string, code_type string")
    for latin in (True, False):
        groups = defaultdict(list)
        for gid, lang, name in rows:
            code = lang if lang is not None else "none"
            if code in PSEUDO_LANGUAGES or (latin and name > "ZZ"):
                continue
            groups[(gid, ref_clean(name))].append(names.get(code))
        want = sorted((k[0], k[1], ", ".join(sorted(v for v in vs if v)) or None) for k, vs in groups.items())
        got = sorted(tuple(r) for r in aggregate_alt_names(raw, codes, latin_only=latin).collect())
        assert got == want


def test_enrich_against_reference(spark):
    target = [(i, maybe(R.choice("abcdefg"), 0.1), "old") for i in range(1500)]
    lookup = [(R.randrange(10000), R.choice("abcde"), maybe("v" + str(j), 0.2)) for j in range(300)]
    best = {}
    for lid, code, val in lookup:
        if code not in best or lid < best[code][0]:
            best[code] = (lid, val)
    want = sorted((i, c, best[c][1] if c in best else "old") for i, c, _ in target)
    t = spark.createDataFrame(target, "id int, code string, val string")
    lk = spark.createDataFrame(lookup, "lid int, code string, val string")
    got = enrich_by_lookup(t, lk, on={"code": "code"}, assignments={"val": "val"}, order_by="lid")
    assert sorted(tuple(r) for r in got.collect()) == want


def test_dense_ids_against_reference(spark):
    keys = R.sample(range(10**9), 5000)
    df = spark.createDataFrame([(k, str(k % 97)) for k in keys], "k long, s string")
    out = assign_dense_ids(df, ["s", "k"], id_col="rid", start=1000001, num_partitions=7)
    want = {(s, k): i for i, (s, k) in enumerate(sorted((str(k % 97), k) for k in keys), start=1000001)}
    got = {(r["s"], r["k"]): r["rid"] for r in out.collect()}
    assert got == want


def test_word_split_matches_whole_text_split(spark, tmp_path):
    """The per-line word split gives exactly the tokens of a whole-text split."""
    import re

    import pyarrow as pa
    import pyarrow.parquet as pq

    from gazetta.plans import driver

    texts = ["", " ", "\n", "a", " a", "a ", "a\nb", "a\n\nb", " a \n b ", "\n\na", "a\n\n", "x\r\ny",
             "\t\tx\t", "one two  three", "\n \n", "é f g"]
    texts += ["".join(R.choice("ab \n\t\r") for _ in range(R.randrange(0, 12))) for _ in range(300)]
    table = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts,
                      "lang": ["en"] * len(texts), "source": ["s"] * len(texts),
                      "n_chars": pa.array([len(t) for t in texts], pa.int64())})
    pq.write_table(table, str(tmp_path / "documents.parquet"))
    got = Counter((r[0], r[1]) for r in driver.doc_word_alternates(spark, str(tmp_path))
                  .select("geoname_id", "alternate_name").collect())
    want = Counter((i, tok) for i, t in enumerate(texts) for tok in re.split("[ \t\n\r]+", t))
    assert got == want
