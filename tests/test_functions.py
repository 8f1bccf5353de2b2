"""Column functions: clean-up, the Latin test, codes, ranks."""

import pytest
from pyspark.sql import functions as F

from gazetta.functions.codes import disambiguation, none_to_null, rank_by_threshold
from gazetta.functions.text import (
    clean_name,
    curly_apostrophe,
    is_latin_name,
    not_pseudo_language,
    suffix_name,
)


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_clean_name_order_of_steps(spark):
    got = one_col(spark, [" .a", ". a", "St. Ives ", "O'Brien", "  ", "", None, "a.b.c"], clean_name)
    assert got == ["a", " a", "St Ives", "O’Brien", "", "", None, "abc"]


def test_clean_name_unicode_white_space(spark):
    ws = [" x　", "\tx\n", " x ", "\u0085x ", " x "]
    assert one_col(spark, ws, clean_name) == ["x"] * len(ws)
    # zero-width space and U+001C are not White_Space and stay
    assert one_col(spark, ["​x\u001c"], clean_name) == ["​x\u001c"]


def test_curly_apostrophe_only(spark):
    assert one_col(spark, [" St. Mary's "], curly_apostrophe) == [" St. Mary’s "]


@pytest.mark.parametrize(
    "name,keep",
    [("Paris", True), ("ZZ", True), ("ZA", True), ("Zagreb", False), ("Zürich", False), ("Évian", False),
     ("york", False), ("Ж", False), ("北京", False), ("123", True), ("", True), (" 北京", True), ("Aж", True)],
)
def test_latin_filter_is_bytewise(spark, name, keep):
    assert one_col(spark, [name], is_latin_name) == [keep]


def test_pseudo_language_filter_keeps_missing(spark):
    got = one_col(spark, ["en", "link", None, "iata", "none", "abbr", "wkdt"], not_pseudo_language)
    assert got == [True, False, True, False, True, False, False]


def test_disambiguation_truth_table(spark):
    rows = [
        (None, "22", "X"), ("CN", "22", None), ("CN", None, "X"), ("GB", "ENG", "C6"), ("FR", "ENG", None),
        ("GB", None, "H3"), ("GB", None, None),
    ]
    df = spark.createDataFrame(rows, "cc string, a1 string, a2 string")
    t, c, cc = disambiguation("cc", "a1", "a2")
    got = [tuple(r) for r in df.select(t, c, cc).collect()]
    assert got == [
        ("none", "none", "none"), ("admin1", "CN.22", "CN"), ("admin1", "none", "CN"),
        ("admin2", "GB.ENG.C6", "GB"), ("admin2", "none", "FR"), ("admin2", "none.H3", "GB"),
        ("admin2", "none", "GB"),
    ]


def test_none_to_null_and_suffix(spark):
    assert one_col(spark, ["none", "CN.22", None], none_to_null) == [None, "CN.22", None]
    assert one_col(spark, ["Kowloon", None], lambda c: suffix_name(c, " (HK)")) == ["Kowloon (HK)", None]


def test_rank_threshold(spark):
    assert one_col(spark, [320000, 319999, 0, 10**10], rank_by_threshold, "long") == [1, 2, 2, 1]
