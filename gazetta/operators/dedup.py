"""Duplicate removal for places and their names.

The SQL formulation of these steps is group-by -> join back -> delete. Here
each is one aggregation over the duplicate key with constant-size state
(count, max/min of a struct), partially aggregated before its shuffle, and
one left join of the rows to the statistics of their group. A hot key (one
group holding a large share of all rows) is therefore reduced map-side in
the aggregation, and in the join AQE's skew handling can split the hot
partition of the row side; no group is ever gathered into a single buffer.

The statistics only cover duplicated groups (count > 1), usually a small
table: they are computed once, checked, and broadcast when small, so the
rows themselves are then filtered where they are, without a shuffle.

Rows whose key has a NULL part never match (equi-join semantics), so they are
never treated as duplicates -- the behaviour of the SQL original.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.operators.lookup import broadcast_if_small_result

_PREFIX = "__dup_"


def _group_stats(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    valid = None
    for k in keys:
        c = F.col(k).isNotNull()
        valid = c if valid is None else valid & c
    stats = (
        df.where(valid)
        .groupBy(*[F.col(k).alias(f"{_PREFIX}{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias(f"{_PREFIX}n"), *aggs)
        .where(F.col(f"{_PREFIX}n") > 1)
    )
    return stats


def _join_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    stats = broadcast_if_small_result(stats)
    cond = None
    for k in keys:
        c = df[k] == stats[f"{_PREFIX}{k}"]
        cond = c if cond is None else cond & c
    return df.join(stats, cond, "left")


def drop_smaller_duplicates(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Within each duplicated key keep only the rows with the largest measure.

    Ties at the maximum all survive. A NULL measure never survives in a group
    of two or more, and a group whose measures are all NULL loses every row.
    """
    stats = _group_stats(df, keys, [F.max(measure).alias(f"{_PREFIX}max")])
    joined = _join_stats(df, stats, keys)
    keep = F.col(f"{_PREFIX}n").isNull() | F.coalesce(F.col(measure) == F.col(f"{_PREFIX}max"), F.lit(False))
    return joined.where(keep).select(*[df[c] for c in df.columns])


def drop_min_id_duplicates(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Within each duplicated key delete exactly one row: the smallest id.

    A three-way tie therefore leaves two rows.
    """
    stats = _group_stats(df, keys, [F.min(id_col).alias(f"{_PREFIX}min")])
    joined = _join_stats(df, stats, keys)
    keep = F.col(f"{_PREFIX}n").isNull() | (F.col(id_col) != F.col(f"{_PREFIX}min"))
    return joined.where(keep).select(*[df[c] for c in df.columns])


def _is_int32(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (T.IntegerType, T.ShortType, T.ByteType))


def dedupe_places(
    df: DataFrame, keys: Sequence[str], measure: str, id_col: str,
    counted: Observation | None = None, count: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``drop_smaller_duplicates`` followed by ``drop_min_id_duplicates``, fused.

    After the first pass a duplicated group keeps its rows at the maximum
    measure; the second pass then deletes the smallest id among them if two
    or more are left. Both facts come from one aggregation: the largest and
    the smallest id among the rows at the maximum measure, which differ
    exactly when at least two rows tie there. One aggregation and one join
    instead of two full group / join-back / delete rounds.

    When measure and id are 32-bit integers (population and id of a city),
    (measure, id) is packed into one long so the aggregate is a plain
    ``max`` over longs, which runs as a hash aggregate; wider types fall back
    to ``max`` over a struct (sort-based aggregate, same result).

    ``counted`` gets how many rows each pass deletes (``smaller``, ``smallest_id``)
    and, for each entry of ``count``, how many rows of ``df`` fulfil it: every row
    is flagged before the filter, in the job that uses the result.
    """
    m, i = F.col(measure), F.col(id_col)
    if _is_int32(df, measure) and _is_int32(df, id_col):
        shift = F.lit(1 << 32)
        low = (i.cast("long") + F.lit(1 << 31))                 # id mapped onto [0, 2^32)
        low_rev = (F.lit((1 << 31) - 1) - i.cast("long"))       # reversed id on [0, 2^32)
        hi = F.max(m.cast("long") * shift + low).alias(f"{_PREFIX}hi")
        lo = F.max(m.cast("long") * shift + low_rev).alias(f"{_PREFIX}lo")
        stats = _group_stats(df, keys, [hi, lo])
        max_measure = F.shiftright(F.col(f"{_PREFIX}hi"), 32)
        hi_id = F.pmod(F.col(f"{_PREFIX}hi"), shift) - F.lit(1 << 31)
        lo_id = F.lit((1 << 31) - 1) - F.pmod(F.col(f"{_PREFIX}lo"), shift)
    else:
        hi = F.max(F.struct(m.alias("m"), i.alias("i"))).alias(f"{_PREFIX}hi")
        lo = F.max(F.struct(m.alias("m"), (-i).alias("i"))).alias(f"{_PREFIX}lo")
        stats = _group_stats(df, keys, [hi, lo])
        max_measure = F.col(f"{_PREFIX}hi.m")
        hi_id = F.col(f"{_PREFIX}hi.i")
        lo_id = -F.col(f"{_PREFIX}lo.i")
    joined = _join_stats(df, stats, keys)
    at_max = F.coalesce(m == max_measure, F.lit(False))
    second_pass_victim = (hi_id != lo_id) & (i == lo_id)
    alone = F.col(f"{_PREFIX}n").isNull()
    keep = alone | (at_max & ~second_pass_victim)
    if counted is not None:
        joined = joined.observe(
            counted, F.count_if(~alone & ~at_max).alias("smaller"), F.count_if(~alone & at_max & second_pass_victim).alias("smallest_id"),
            *[F.count_if(c).alias(name) for name, c in (count or {}).items()])
    return joined.where(keep).select(*[df[c] for c in df.columns])


def drop_ambiguous_alternates(
    names: DataFrame,
    scope_col: str,
    alt_col: str,
    default_col: str,
) -> DataFrame:
    """Where an alternate occurs more than once in a scope, keep only defaults.

    If (scope, alternate) appears on two or more rows, every such row whose
    alternate differs from its own default name is removed -- even if that
    empties the group. Rows with a NULL scope or alternate are never touched,
    nor are rows with a NULL default (the inequality is not true).
    """
    stats = broadcast_if_small_result(_group_stats(names, [scope_col, alt_col], []))
    cond = (
        (names[scope_col] == stats[f"{_PREFIX}{scope_col}"])
        & (names[alt_col] == stats[f"{_PREFIX}{alt_col}"])
        & (names[alt_col] != names[default_col])
    )
    return names.join(stats, cond, "left_anti")
