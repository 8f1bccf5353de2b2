"""The hand-worked golden example of FIXTURES.md, written as dump files."""

from __future__ import annotations

import os

LANG_CODES = [
    ("ISO 639-3", "ISO 639-2", "ISO 639-1", "Language Name"),
    ("eng", "eng", "en", "English"),
    ("fra", "fra / fre", "fr", "French"),
    ("deu", "deu / ger", "de", "German"),
    ("", "afa", "", "Afro-Asiatic languages"),
    ("", "frr", "", "Northern Frisian"),
]

# (geoname_id, language, name)
ALTERNATES = [
    (1, "en", "St Ives"), (1, "fr", "St. Ives"), (1, "link", "http://x.org"),
    (2, "en", "Newport"), (2, "cy", "Casnewydd"),
    (4, "zh", "九龍"), (4, "en", "Kowloon"),
    (6, "en", "Twin"), (6, "", "Gemini"), (7, "en", "Twin"), (7, "", "Gemini"),
    (10, "en", "Zed"), (11, "en", "Lone"), (12, "", "Utopia"), (15, "de", "O'Town"),
    (2635167, "en", "United Kingdom"), (1814991, "en", "China"),
    (878675, "en", "Zimbabwe"), (878675, "de", "Simbabwe"), (1819730, "en", "Hong Kong"),
]

# (geonameid, iso, country, population)
COUNTRIES = [
    (2635167, "GB", "United Kingdom", 66488991), (1814991, "CN", "China", 1411778724),
    (1819730, "HK", "Hong Kong", 7491609), (878675, "ZW", "Zimbabwe", 320000),
    (3042058, "LI", "Liechtenstein", 319999),
]

ADMIN1 = [("CN.22", "Beijing", 2038349), ("HK.KKC", "Kowloon City", 7533607), ("LI.01", "Balzers", 3042074)]
ADMIN2 = [("GB.ENG.C6", "Cornwall", 11609029), ("GB.WLS.X1", "Newport City", 2641599)]

# (id, name, country, admin1, admin2, population)
CITIES = [
    (1, "St. Ives", "GB", "ENG", "C6", 11000), (2, "Newport", "GB", "WLS", "X1", 100),
    (3, "Newport", "GB", "WLS", "X1", 50), (4, "Kowloon", "HK", "KKC", "", 2000),
    (5, "Twin", "CN", "22", "", 5), (6, "Twin", "CN", "22", "", 5), (7, "Twin", "CN", "22", "", 5),
    (8, "Ghost", "CN", "22", "", ""), (9, "Ghost", "CN", "22", "", ""),
    (10, "Lone", "CN", "99", "", 7), (11, "Lone", "CN", "99", "", 8),
    (12, "Nowhere", "", "", "", 3), (13, "Leeds", "GB", "", "H3", 9), (14, "York", "GB", "ENG", "", 9),
    (15, "O'Town", "LI", "01", "", 4), (16, "Taipa", "MO", "", "", 6),
]

# (id, name, feature_code, cc2)
REGIONS = [(901, "Scandinavia", "RGN", "DK,NO,SE"), (902, "Europe", "CONT", ""),
           (903, "North Sea", "SEA", ""), (904, "St. Elsewhere's", "", "")]


def _tsv(path, rows):
    with open(path, "w", encoding="utf-8") as fh:
        for r in rows:
            fh.write("\t".join("" if v is None else str(v) for v in r) + "\n")


def place_row(gid, name, cc, a1, a2, pop, feature_code="PPL", cc2=""):
    return (gid, name, name, "", 1.5, 2.5, "P", feature_code, cc, cc2, a1, a2, "", "", pop, "", 10, "UTC", "2024-01-01")


def write_dump(d: str) -> str:
    os.makedirs(d, exist_ok=True)
    _tsv(os.path.join(d, "iso-languagecodes.txt"), LANG_CODES)
    _tsv(os.path.join(d, "alternateNamesV2.txt"),
         [(100 + i, g, lang, name, "", "", "", "", "", "") for i, (g, lang, name) in enumerate(ALTERNATES)])
    _tsv(os.path.join(d, "admin1CodesASCII.txt"), [(c, n, n, g) for c, n, g in ADMIN1])
    _tsv(os.path.join(d, "admin2Codes.txt"), [(c, n, n, g) for c, n, g in ADMIN2])
    _tsv(os.path.join(d, "countryInfo.txt"),
         [(iso, iso + "X", 1, "", name, "", 10.0, pop, "EU", "", "", "", "", "", "", "", gid, "", "")
          for gid, iso, name, pop in COUNTRIES])
    _tsv(os.path.join(d, "cities5000.txt"), [place_row(*c) for c in CITIES])
    _tsv(os.path.join(d, "no-country.txt"),
         [place_row(g, n, "", "", "", 0, feature_code=fc, cc2=cc2) for g, n, fc, cc2 in REGIONS])
    return d
