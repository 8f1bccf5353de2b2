"""Name clean-up and name filters.

All of these return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Language codes in the alternate-names dump that are not languages (links,
# Wikidata ids, postal codes, UN/LOCODE, FAA/ICAO/IATA codes, abbreviations).
PSEUDO_LANGUAGES = ("link", "wkdt", "post", "unlc", "faac", "icao", "iata", "abbr")
# Value given to a missing language code.
NO_LANGUAGE = "none"
# Names that compare (byte-wise) above this are taken to be non-Latin.
END_OF_LATIN = "ZZ"
# Straight apostrophe and its typographic replacement.
APOSTROPHE = "'"
CURLY_APOSTROPHE = "’"
# The Unicode White_Space property, the set a Unicode-aware trim removes:
# U+0009..U+000D, U+0020, U+0085, U+00A0, U+1680, U+2000..U+200A, U+2028,
# U+2029, U+202F, U+205F, U+3000.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# -----------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_white_space(c: Column | str) -> Column:
    """Trim every Unicode White_Space character from both ends.

    ``F.trim`` strips only U+0020; ``btrim`` with an explicit character set
    strips exactly the White_Space set and is a plain string scan, no regex.
    """
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def curly_apostrophe(c: Column | str) -> Column:
    """Replace every straight apostrophe by a typographic one."""
    return F.replace(_col(c), F.lit(APOSTROPHE), F.lit(CURLY_APOSTROPHE))


def clean_name(c: Column | str) -> Column:
    """Full clean-up: trim, then drop every full stop, then curl apostrophes.

    The order matters: trimming first means ``" .a"`` becomes ``"a"`` while
    ``". a"`` becomes ``" a"``.
    """
    trimmed = trim_white_space(c)
    return curly_apostrophe(F.replace(trimmed, F.lit("."), F.lit("")))


def language_or_none(c: Column | str) -> Column:
    """A missing language code becomes the literal ``'none'``."""
    return F.coalesce(_col(c), F.lit(NO_LANGUAGE))


def not_pseudo_language(c: Column | str, excluded=PSEUDO_LANGUAGES) -> Column:
    """NULL-safe 'language is a real language' test; a missing code is kept."""
    return ~language_or_none(c).isin(list(excluded))


def is_latin_name(c: Column | str) -> Column:
    """The dump's 'Latin only' rule: keep a raw name unless it sorts after "ZZ".

    This is a byte-wise comparison of the *raw* (untrimmed) text: it drops
    names starting with a lower-case letter, an accented capital or "Z" plus a
    lower-case letter, as well as non-Latin scripts, and keeps digits,
    punctuation and the empty string.
    """
    return _col(c) <= F.lit(END_OF_LATIN)


def empty_if_null(c: Column | str) -> Column:
    """Missing optional text becomes the empty string."""
    return F.coalesce(_col(c), F.lit(""))


def suffix_name(c: Column | str, suffix: str) -> Column:
    """Append a suffix; NULL stays NULL (SQL ``||`` semantics)."""
    return F.concat(_col(c), F.lit(suffix))
