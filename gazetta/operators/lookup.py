"""Lookup enrichment: the SQL ``UPDATE target FROM lookup`` pattern.

``UPDATE ... FROM`` changes each target row at most once and leaves unmatched
rows alone, even when the lookup has several rows per key. A plain left join
would fan a target row out once per matching lookup row, so the lookup is
first reduced to one row per key (the one with the lowest id), then left
joined, and each assigned column takes the lookup value only where a row
matched -- a NULL lookup value still overwrites.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side within both bounds is broadcast; a larger one is joined by shuffle
# (sort-merge, or whatever AQE re-plans at run time).
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20

_MATCHED = "__lookup_matched"


def _size(df: DataFrame) -> list[Column]:
    """Row and (estimated, uncompressed) byte totals of ``df``, as aggregates."""
    width = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        text = isinstance(f.dataType, (T.StringType, T.BinaryType))
        width = width + (F.coalesce(F.octet_length(c), F.lit(0)) + 16 if text else F.lit(f.dataType.jsonValue() in ("integer", "float") and 8 or 16))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes")]


def _fits(size: dict, max_rows: int, max_bytes: int) -> bool:
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def is_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    return _fits(df.agg(*_size(df)).first().asDict(), max_rows, max_bytes)


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after checking that the side really is small.

    The check is one aggregate of row and byte totals (partial sums in the map
    tasks, one row each to the last); beyond a bound the frame is returned
    unhinted, so the planner shuffles it instead.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def broadcast_if_small_result(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """For a *derived* side (e.g. the statistics of duplicated groups).

    Its size is only known once computed, and AQE cannot turn a join into a
    broadcast when an aggregate sits above the shuffle it measured. So the
    side is computed once and written to the checkpoint folder -- its rows
    and bytes are totalled by an ``Observation`` during that write, no extra
    job -- and broadcast when small; then the other, large side of the join is
    never shuffled. Beyond a bound it is joined by shuffle as usual.
    """
    return sized_result(df, max_rows, max_bytes)[0]


def sized_result(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, int]:
    """The same, and how many rows the side has."""
    from gazetta.operators.keys import materialize

    obs = Observation()
    stored = materialize(df.observe(obs, *_size(df)))
    return F.broadcast(stored) if _fits(obs.get, max_rows, max_bytes) else stored, obs.get["rows"]


def unique_by_key(lookup: DataFrame, keys: Sequence[str], order_by: str | None, payload: Sequence[str]) -> DataFrame:
    """One lookup row per key: the row with the smallest ``order_by`` value.

    Implemented as ``min(struct(order_by, payload...))`` per key, an aggregate
    with constant-size state that is partially aggregated before the shuffle,
    so a key with millions of rows still sends one row per map task.
    """
    if order_by is None:
        return lookup.select(*keys, *payload).dropDuplicates(list(keys))
    packed = F.min(F.struct(F.col(order_by).alias("__o"), *[F.col(p) for p in payload])).alias("__best")
    return lookup.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"__best.{p}").alias(p) for p in payload])


def enrich_by_lookup(
    target: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    assignments: Mapping[str, str | Column],
    order_by: str | None = None,
    where: Column | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Update ``target`` columns from ``lookup`` where the keys match.

    ``on`` maps target key column -> lookup key column. ``assignments`` maps
    target column -> lookup column name (or an expression over lookup
    columns). ``where`` is an extra condition on the *target* row (e.g. only
    rows with ``disamb_type = 'admin1'``); rows failing it are left as they
    are. ``order_by`` picks the lookup row kept per key (lowest value wins).
    """
    lkeys = list(on.values())
    payload_exprs = {
        f"__new_{t}": (F.col(src) if isinstance(src, str) else src) for t, src in assignments.items()
    }
    prepared = lookup.select(
        *[F.col(k) for k in lkeys],
        *([F.col(order_by)] if order_by and order_by not in lkeys else []),
        *[e.alias(n) for n, e in payload_exprs.items()],
    )
    reduced = unique_by_key(prepared, lkeys, order_by, list(payload_exprs))
    reduced = reduced.select(
        *[F.col(lk).alias(f"__key_{i}") for i, lk in enumerate(lkeys)],
        *payload_exprs,
        F.lit(True).alias(_MATCHED),
    )
    # the reduced lookup is derived data: computed once, broadcast when small
    side = broadcast_if_small_result(reduced, max_broadcast_rows)
    cond = None
    for i, tk in enumerate(on.keys()):
        c = target[tk] == side[f"__key_{i}"]
        cond = c if cond is None else cond & c
    if where is not None:
        cond = cond & where
    joined = target.join(side, cond, "left")
    matched = F.coalesce(F.col(_MATCHED), F.lit(False))
    updated = {t: F.when(matched, F.col(f"__new_{t}")).otherwise(target[t] if t in target.columns else F.lit(None))
               for t in assignments}
    out_cols = list(target.columns) + [t for t in assignments if t not in target.columns]
    return joined.select(*[updated[c].alias(c) if c in updated else target[c] for c in out_cols])
