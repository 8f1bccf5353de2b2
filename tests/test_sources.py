"""Strict reading of the dump files (first bad row aborts the load)."""

import os
import random

import pytest

from fixture_dump import place_row
from gazetta.operators.keys import KeyViolation
from gazetta.sources.geonames import QUOTE_NONE, first_malformed, land, read_alt_names, read_lang_codes, read_places
from gazetta.sources.records import numbered_lines, records
from gazetta.sources.schemas import ALT_NAMES


def write(path, lines):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def tsv(row):
    return "\t".join("" if v is None else str(v) for v in row)


def test_good_places_file(spark, scratch):
    p = write(os.path.join(scratch, "c.txt"), [tsv(place_row(1, "A", "GB", "ENG", "", 5))])
    df = land(read_places(spark, p), os.path.join(scratch, "landed"), "places")
    r = df.collect()[0]
    assert (r["geonameid"], r["name"], r["admin2_code"], r["population"]) == (1, "A", None, 5)


@pytest.mark.parametrize("mutate", [
    lambda r: ("   ",),                              # a line of blanks
    lambda r: ("",) * len(r),                        # a line of tabs, as many as fields need
    lambda r: ("",) * 3,                             # a line of a few tabs
    lambda r: r[:4] + ("1.0d",) + r[5:],             # Java's spelling of a double
    lambda r: r[:14] + ("many",) + r[15:],          # non-number population
    lambda r: r[:10],                                # too few columns
    lambda r: r + ("extra",),                        # too many columns
    lambda r: r[:16] + ("x",) + r[17:],              # bad number in an unused column (dem)
    lambda r: ("",) + r[1:],                         # missing required id
])
def test_malformed_places_abort(spark, scratch, mutate):
    good = place_row(1, "A", "GB", "ENG", "", 5)
    p = write(os.path.join(scratch, "c.txt"), [tsv(good), tsv(mutate(good))])
    with pytest.raises(Exception):
        land(read_places(spark, p), os.path.join(scratch, "landed"), "places").collect()


def test_lazy_read_alone_misses_unread_column(spark, scratch):
    """Why landing is needed: a pruned read does not parse 'dem'."""
    good = place_row(1, "A", "GB", "ENG", "", 5)
    bad = good[:16] + ("x",) + good[17:]
    p = write(os.path.join(scratch, "c.txt"), [tsv(good), tsv(bad)])
    assert read_places(spark, p).select("geonameid").count() == 2


def test_alt_names_negative_flag(spark, scratch):
    p = write(os.path.join(scratch, "a.txt"), [tsv((1, 2, "en", "X", -1, "", "", "", "", ""))])
    with pytest.raises(KeyViolation):
        land(read_alt_names(spark, p), os.path.join(scratch, "landed"), "alt_names")


def test_quotes(spark, scratch):
    p = write(os.path.join(scratch, "a.txt"), [tsv((1, 2, "en", '"ab ""c"" d"', "", "", "", "", "", ""))])
    assert read_alt_names(spark, p).collect()[0]["alternate_name"] == 'ab "c" d'
    assert read_alt_names(spark, p, quoting=QUOTE_NONE).collect()[0]["alternate_name"] == '"ab ""c"" d"'


def test_lang_codes_by_header_name(spark, scratch):
    p = write(os.path.join(scratch, "l.txt"), [
        "Language Name\tISO 639-1\tISO 639-3\tISO 639-2", "English\ten\teng\teng"])
    r = read_lang_codes(spark, p).collect()[0]
    assert (r["c3"], r["c2"], r["c1"], r["name"]) == ("eng", "eng", "en", "English")
    bad = write(os.path.join(scratch, "m.txt"), ["ISO 639-3\tName", "eng\tEnglish"])
    with pytest.raises(KeyViolation):
        read_lang_codes(spark, bad)


def test_empty_required_text_is_empty_string(spark, scratch):
    from gazetta.operators.names import aggregate_alt_names

    p = write(os.path.join(scratch, "a.txt"), [tsv((1, 7, "en", "", "", "", "", "", "", "")),
                                                tsv((2, 7, "", "Rome", "", "", "", "", "", ""))])
    raw = land(read_alt_names(spark, p), os.path.join(scratch, "landed"), "alt_names")
    rows = sorted((r["alternate_name"], r["iso_language"]) for r in raw.collect())
    assert rows == [("", "en"), ("Rome", None)]
    codes = spark.createDataFrame([("en", "English", "639-1")], "code string, name string, code_type string")
    got = sorted(tuple(r) for r in aggregate_alt_names(raw, codes).collect())
    assert got == [(7, "", "English"), (7, "Rome", None)]


@pytest.mark.parametrize("bad", ["   ", "\t" * 9, "\t\t", " \t "])
def test_alt_names_blank_lines_abort(spark, scratch, bad):
    row = tsv((1, 2, "en", "X", "", "", "", "", "", ""))
    p = write(os.path.join(scratch, "a.txt"), [row, bad, row])
    with pytest.raises(Exception):
        land(read_alt_names(spark, p), os.path.join(scratch, "landed"), "alt_names").collect()


def test_empty_lines_are_no_records(spark, scratch):
    row = tsv((1, 2, "en", "X", "", "", "", "", "", ""))
    p = write(os.path.join(scratch, "a.txt"), [row, "", row])
    assert read_alt_names(spark, p).count() == 2


def test_language_file_blank_lines(spark, scratch):
    head = "ISO 639-3\tISO 639-2\tISO 639-1\tLanguage Name"
    p = write(os.path.join(scratch, "l.txt"), [head, "\t\t\t", "eng\teng\ten\tEnglish"])
    rows = {tuple(r) for r in land(read_lang_codes(spark, p), os.path.join(scratch, "landed"), "lang_codes").collect()}
    assert len(rows) == 2 and any(not any(r) for r in rows)
    for i, bad in enumerate(("  ", "\t\t", "\t" * 4)):
        q = write(os.path.join(scratch, f"b{i}.txt"), [head, bad])
        with pytest.raises(Exception):
            land(read_lang_codes(spark, q), os.path.join(scratch, f"landed{i}"), "lang_codes").collect()


def test_quoted_line_break(spark, scratch):
    p = write(os.path.join(scratch, "a.txt"), [tsv((1, 2, "en", '"X\nY"', "", "", "", "", "", ""))])
    assert [r["alternate_name"] for r in read_alt_names(spark, p, multi_line=True).collect()] == ["X\nY"]
    with pytest.raises(Exception):
        land(read_alt_names(spark, p), os.path.join(scratch, "landed"), "alt_names").collect()


@pytest.fixture()
def cut_finely(spark, monkeypatch):
    """Files are numbered by small byte ranges, so that a small file has many;
    what is stored is read as usual."""
    from gazetta.sources import geonames

    def finely(*args):
        small = {"spark.sql.files.maxPartitionBytes": "150b", "spark.sql.files.openCostInBytes": "1b"}
        old = {k: spark.conf.get(k) for k in small}
        try:
            for k, v in small.items():
                spark.conf.set(k, v)
            return numbered_lines(*args)
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)

    monkeypatch.setattr(geonames, "numbered_lines", finely)
    return finely


def csv_records(text):
    """Records of a text by the quoting rules, one character at a time."""
    out, record, state, i = [], "", "start", 0
    while i < len(text):
        c = text[i]
        if state == "quoted":
            if text[i: i + 2] == '""':
                record, i = record + '""', i + 2
                continue
            state = "plain" if c == '"' else state
            record += c
        elif c == "\n":
            out.append(record)
            record, state = "", "start"
        else:
            state = "quoted" if c == '"' and state == "start" else "start" if c == "\t" else "plain"
            record += c
        i += 1
    return [r[:-1] if r.endswith("\r") else r for r in out + [record][: bool(record)]]


def test_records_over_ranges(spark, scratch, cut_finely):
    rng, expected, ranges = random.Random(3), {}, 0
    for n in range(12):
        p = rng.choice([0.02, 0.1, 0.3])
        text = "".join(rng.choice(["a", "bc", "\t", "\n", "\n", "dé", "\r\n"]) if rng.random() > p else rng.choice(['"', '""', '\t"', '"\t', '"\n', '\n"'])
                       for _ in range(rng.choice([0, 5, 80, 400])))
        with open(os.path.join(scratch, f"f{n:02}.txt"), "w", newline="", encoding="utf-8") as fh:
            fh.write(text + "\n" if text else "")
        expected[f"f{n:02}.txt"] = [r.rstrip("\r\n") for r in csv_records(text + "\n" if text else "")]
    lines = cut_finely(spark, scratch)
    got = {}
    for r in records(lines).orderBy("file", "block", "at").collect():
        got.setdefault(os.path.basename(r["file"]), []).append(r["value"].rstrip("\r\n"))
    assert got == {k: v for k, v in expected.items() if v}
    assert lines.select("file", "block").distinct().count() > 15  # many tasks
    assert any("\n" in x for v in got.values() for x in v)


def test_a_quote_that_never_closes(spark, scratch, cut_finely):
    p = write(os.path.join(scratch, "a.txt"), ['1\t"x', *["line"] * 200])
    with pytest.raises(Exception, match="never closes"):
        records(cut_finely(spark, p), max_chars=300).collect()
    with pytest.raises(Exception):
        land(read_alt_names(spark, p, multi_line=True), os.path.join(scratch, "landed"), "alt_names")


def test_multi_line_equals_one_task_read(spark, scratch, cut_finely):
    rng = random.Random(4)
    names = [rng.choice(['plain', '"two\nlines"', '"a ""b""\n\n c"', '"tab\there"', 'x"y', '""', '"\r\n"']) for _ in range(300)]
    rows = [(k, k + 1, "en", n, "", 1, "", "", "", "") for k, n in enumerate(names)]
    p = write(os.path.join(scratch, "a.txt"), [tsv(r) for r in rows])
    one = spark.read.options(sep="\t", quote='"', escape='"', multiLine="true").schema(ALT_NAMES).csv(p)
    many = read_alt_names(spark, p, multi_line=True)
    key = lambda r: r["alternate_name_id"]
    assert sorted(many.collect(), key=key) == sorted(one.collect(), key=key)


def test_multi_line_keeps_the_line_rules(spark, scratch, cut_finely):
    good = tsv((1, 2, "en", '"X\nY"', "", "", "", "", "", ""))
    p = write(os.path.join(scratch, "a.txt"), [good, "", good])
    assert read_alt_names(spark, p, multi_line=True).count() == 2
    for i, bad in enumerate(["\t" * 9, good.replace("2", "two")]):
        q = write(os.path.join(scratch, f"b{i}.txt"), [good, bad, good])
        with pytest.raises(Exception):
            land(read_alt_names(spark, q, multi_line=True), os.path.join(scratch, f"landed{i}"), "alt_names")


@pytest.mark.parametrize("multi_line", [False, True])
def test_only_the_first_line_of_a_file_is_its_header(spark, scratch, multi_line):
    head = "ISO 639-3\tISO 639-2\tISO 639-1\tLanguage Name"
    row = "eng\teng\ten\tEnglish"
    for n in range(2):
        write(os.path.join(scratch, f"l{n}.txt"), [head, row, head, row])
    rows = sorted(tuple(r) for r in read_lang_codes(spark, scratch, multi_line=multi_line).collect())
    assert rows == sorted([tuple(row.split("\t")), tuple(head.split("\t")), tuple(row.split("\t"))] * 2)
    write(os.path.join(scratch, "l2.txt"), ["Language Name\tISO 639-3", "x\ty"])
    with pytest.raises(KeyViolation):
        read_lang_codes(spark, scratch, multi_line=multi_line)


@pytest.mark.parametrize("multi_line", [False, True])
def test_place_of_the_bad_record(spark, scratch, cut_finely, multi_line):
    good = tsv((1, 2, "en", '"X\nY"' if multi_line else "X", "", "", "", "", "", ""))
    lines = 2 if multi_line else 1
    cases = [good + "\textra", tsv(("", 2, "en", "X", "", "", "", "", "", "")), good.replace("1", "one", 1), " ", tsv((1, 2, "en", "X", -1, "", "", "", "", ""))]
    for n, bad in enumerate(cases[:2] if multi_line else cases):
        folder = os.path.join(scratch, str(n))
        os.makedirs(folder)
        write(os.path.join(folder, "a.txt"), [good] * 30)
        write(os.path.join(folder, "b.txt"), [*[good] * 40, "", bad, good, bad])
        with pytest.raises(KeyViolation, match=f"b.txt, line {40 * lines + 2}: "):
            land(read_alt_names(spark, folder, multi_line=multi_line), os.path.join(scratch, f"landed{n}"), "alt_names",
                 lambda: first_malformed(spark, folder, "alt_names", multi_line=multi_line))
    assert first_malformed(spark, os.path.join(folder, "a.txt"), "alt_names", multi_line=multi_line) is None


def _used(df):
    return df.where("alternate_name <= 'ZZ'").select("geoname_id", "alternate_name")


def test_landing_writes_what_is_used(spark, scratch):
    """Rows and columns that no later step uses are not written; an empty name is '' to the filter too."""
    p = write(os.path.join(scratch, "a.txt"), [tsv((1, 2, "en", "X", "", "", "", "", "", "")), tsv((2, 3, "en", "x", 1, 0, "", "", "", "")), tsv((3, 4, "", "", "", "", "", "", "", ""))])
    got = land(read_alt_names(spark, p), os.path.join(scratch, "landed"), "alt_names", used=_used)
    assert got.columns == ["geoname_id", "alternate_name"]
    assert sorted(map(tuple, got.collect())) == [(2, "X"), (4, "")]


@pytest.mark.parametrize("row", [
    ("", 2, "en", "x", "", "", "", "", "", ""),      # no id, in a column that is not written
    (1, "", "en", "x", "", "", "", "", "", ""),
    (1, 2, "en", "x", "", "", "", -1, "", ""),       # a negative flag
    (1, 2, "en", "x", "", "", "many", "", "", ""),   # no number in a column that is not written
    (1, 2, "en", "x", "", "", "", "", ""),           # too few fields
    (1, 2, "en", "x", "", "", "", "", "", "", ""),   # too many
])
def test_rows_that_are_not_used_are_checked(spark, scratch, row):
    p = write(os.path.join(scratch, "a.txt"), [tsv((1, 2, "en", "X", "", "", "", "", "", "")), tsv(row)])
    with pytest.raises(Exception) as error:
        land(read_alt_names(spark, p), os.path.join(scratch, "landed"), "alt_names", lambda: first_malformed(spark, p, "alt_names"), used=_used)
    assert isinstance(error.value, KeyViolation) and "line 2" in str(error.value)
