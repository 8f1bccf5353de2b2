"""Code building and sentinel handling for places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Sentinel written for a missing country / area code before it is nulled.
NONE_SENTINEL = "none"
# Countries whose cities are told apart by their second-level area.
SECOND_LEVEL_COUNTRIES = ("GB", "FR")
# Population at or above which a country is ranked 1, else 2.
RANK_THRESHOLD = 320000
# -----------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def disambiguation(
    country: Column | str,
    admin1: Column | str,
    admin2: Column | str,
    second_level_countries=SECOND_LEVEL_COUNTRIES,
) -> tuple[Column, Column, Column]:
    """Return ``(disamb_type, disamb_code, country_code)`` for a city row.

    * no country: type and code are the ``'none'`` sentinel, country too;
    * a second-level country (GB, FR): type ``admin2``, code
      ``<cc>.<admin1>.<admin2>``; without admin-2 the code is ``'none'``;
      without admin-1 but with admin-2 it is the literal ``none.<admin2>``;
    * any other country: type ``admin1``, code ``<cc>.<admin1>`` or ``'none'``.
    """
    cc, a1, a2 = _col(country), _col(admin1), _col(admin2)
    none = F.lit(NONE_SENTINEL)
    level1 = F.when(a1.isNull(), none).otherwise(F.concat(cc, F.lit("."), a1))
    level2 = F.when(a2.isNull(), none).otherwise(F.concat(level1, F.lit("."), a2))
    second = cc.isin(list(second_level_countries))
    dtype = (
        F.when(cc.isNull(), none)
        .when(second, F.lit("admin2"))
        .otherwise(F.lit("admin1"))
    )
    dcode = F.when(cc.isNull(), none).when(second, level2).otherwise(level1)
    return dtype, dcode, F.coalesce(cc, none)


def none_to_null(c: Column | str) -> Column:
    """The ``'none'`` sentinel becomes NULL, anything else is kept."""
    c = _col(c)
    return F.when(c != F.lit(NONE_SENTINEL), c)


def rank_by_threshold(population: Column | str, threshold: int = RANK_THRESHOLD) -> Column:
    """2 when the population is below the threshold, else 1."""
    return F.when(_col(population) < F.lit(threshold), F.lit(2)).otherwise(F.lit(1))
