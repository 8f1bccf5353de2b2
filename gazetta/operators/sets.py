"""Row-set operators: distinct unions, appends, deletions, reassignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions.text import suffix_name


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """SQL ``UNION``: stack by column name, then remove duplicate rows."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def drop_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Delete rows whose ``col`` is one of ``values`` (NULL rows are kept)."""
    c = F.col(col)
    return df.where(c.isNull() | ~c.isin(list(values)))


def select_features(
    raw: DataFrame,
    feature_col: str,
    keep: Sequence[str],
    columns: Mapping[str, str | Column],
) -> DataFrame:
    """Keep rows whose feature code is in ``keep`` and project ``columns``."""
    picked = raw.where(F.col(feature_col).isin(list(keep)))
    return picked.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in columns.items()])


def reassign(
    df: DataFrame,
    match_col: str,
    rules: Mapping[str, str],
    suffix_col: str,
    assignments: Mapping[str, object],
) -> DataFrame:
    """Move rows from retired codes to a new owner.

    ``rules`` maps a value of ``match_col`` to the suffix appended to
    ``suffix_col`` (NULL stays NULL); every row matching any rule also gets
    the literal ``assignments``. All new values are computed from the row as
    it was, so reassigning ``match_col`` itself does not disturb the others.
    """
    m = F.col(match_col)
    suffixed: Column | None = None
    for code, suffix in rules.items():
        branch = suffix_name(suffix_col, suffix)
        suffixed = F.when(m == F.lit(code), branch) if suffixed is None else suffixed.when(m == F.lit(code), branch)
    hit = m.isin(list(rules))
    new = {suffix_col: suffixed.otherwise(F.col(suffix_col))}
    for c, v in assignments.items():
        new[c] = F.when(hit, F.lit(v)).otherwise(F.col(c))
    return df.withColumns(new)
