"""Per-key ordered operators that survive hot keys.

A plain ``Window.partitionBy(key)`` puts every row of a key in one task, and AQE cannot split a window partition:
if one key holds a third of the data, one task holds a third of the data. The operators here avoid that.

* :func:`latest_per_key` is an aggregation (``max`` over a struct whose leading fields are the ordering), so Spark
  reduces each key on the map side before the shuffle: a hot key leaves every map task as one row.
* :func:`with_neighbours` (lead/lag) first counts rows per key (key columns only, partial aggregation). Keys above
  ``rows_per_slice`` are *hot*: their rows are dealt out in ranges of the key and the whole ordering, so a hot key
  becomes many window partitions, ties and texts included. Rows at a range's edge take their neighbour from a summary
  with one row per key and range. The dealt rows are written once (under ``spark.checkpoint.dir``) so that every
  branch of the plan, and every retried task, sees the same ranges. Null keys have no neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


from ledgerflow.session import materialize

_REC = "__rec"
_SLICE = "__slice"

# Default (overridable per call or by the session conf key below).
ROWS_PER_SLICE = 2_000_000          # conf: ledgerflow.sequence.rowsPerSlice


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def latest_per_key(df: DataFrame, key, order: Sequence[str], desc: bool = True) -> DataFrame:
    """One row per key: the greatest (``desc``) or least row by ``order``; ``order`` must be a total order.

    Aggregation-based (partial aggregation = map-side combine), never a window over an unbounded key group.
    Output has exactly the columns of ``df``.
    """
    keys = _names(key)
    order = _names(order)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                      F.struct(*[F.col(c) for c in rest]).alias("row"))
    agg = F.max(packed) if desc else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias(_REC))
    return out.select(*keys, *[F.col(f"{_REC}.row.{c}").alias(c) for c in rest]).select(*df.columns)


def _rows_per_slice(df: DataFrame, given: int | None) -> int:
    return given or int(df.sparkSession.conf.get("ledgerflow.sequence.rowsPerSlice", str(ROWS_PER_SLICE)))


def split_hot(df: DataFrame, keys: list[str], order: list[str], rows_per_slice: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of the other keys, rows of keys with more than ``rows_per_slice`` rows with their slice, or None).

    One counting pass asks for the hot keys' rows in all; nothing is written when there are none. Else the input is
    written once, for every later pass. The hot rows are dealt out in ranges of the key and the full order, so any
    orderable type works, ties on the first column split too, and the number of slices has no bound. The dealt rows
    are written: every branch and retry sees the same slices.
    """
    hot_of = lambda rows: rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt")).where(F.col("__cnt") > rows_per_slice)
    total = hot_of(df).agg(F.sum("__cnt")).first()[0]
    if not total:
        return df, None
    df = materialize(df, "hot-input")
    hot = materialize(hot_of(df).select(*keys), "hot-keys")
    dealt = (df.join(hot, on=keys, how="left_semi").select(*df.columns)
             .repartitionByRange(math.ceil(total / rows_per_slice), *keys, *order)
             .withColumn(_SLICE, F.spark_partition_id()))
    return df.join(hot, on=keys, how="left_anti").select(*df.columns), materialize(dealt, "hot-rows")


def with_neighbours(df: DataFrame, key, order: Sequence[str], fields: Sequence[str],
                    prev: str | None = "prev_", nxt: str | None = "next_",
                    rows_per_slice: int | None = None, skew_safe: bool = True) -> DataFrame:
    """Add ``prev_<f>`` / ``next_<f>`` (for every f in ``fields``): the neighbouring row of the same key.

    ``order`` is ascending and must be a total order within a key (end it with a unique tie-break column), of any
    orderable types. A null key belongs to no item: its rows have no neighbours and stay out of every window. Set
    ``prev`` or ``nxt`` to None to skip a side. ``skew_safe=False`` is one plain window (a hot key in one task).
    """
    keys = _names(key)
    order = _names(order)
    fields = list(fields)
    rec = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                   *[F.col(f).alias(f) for f in fields])

    def _emit(frame: DataFrame, prev_c: Column, next_c: Column) -> DataFrame:
        extra = []
        for f in fields:
            if prev is not None:
                extra.append(prev_c.getField(f).alias(f"{prev}{f}"))
            if nxt is not None:
                extra.append(next_c.getField(f).alias(f"{nxt}{f}"))
        return frame.select(*df.columns, *extra)

    keyed = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    rows, hot = df.where(keyed), None
    nothing = F.lit(None).cast(df.select(rec.alias("r")).schema["r"].dataType)
    apart = _emit(df.where(~keyed), nothing, nothing)
    if skew_safe:
        rows, hot = split_hot(rows, keys, order, _rows_per_slice(df, rows_per_slice))
    w = Window.partitionBy(*keys).orderBy(*order)
    out = _emit(rows.withColumn(_REC, rec), F.lag(_REC).over(w), F.lead(_REC).over(w)).unionByName(apart)
    if hot is None:
        return out
    sliced = hot.withColumn(_REC, rec)
    w = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    inner = sliced.withColumn("__p", F.lag(_REC).over(w)).withColumn("__n", F.lead(_REC).over(w))
    # first and last record of every slice of a key: one row per slice
    edges = sliced.groupBy(*keys, _SLICE).agg(F.min(_REC).alias("__first"), F.max(_REC).alias("__last"))
    ew = Window.partitionBy(*keys).orderBy(_SLICE)
    edges = edges.select(*keys, _SLICE, F.lag("__last").over(ew).alias("__pe"), F.lead("__first").over(ew).alias("__ne"))
    joined = inner.join(edges, on=[*keys, _SLICE], how="left")
    return out.unionByName(_emit(joined, F.coalesce("__p", "__pe"), F.coalesce("__n", "__ne")))


def carry_forward(df: DataFrame, key, order: Sequence[str], source: str, fields: Sequence[str],
                  prefix: str = "last_", rows_per_slice: int | None = None, skew_safe: bool = True) -> DataFrame:
    """For every row: ``fields`` of the latest row at or before it (by ``order``, same key) whose ``source``
    column is true, as ``<prefix><f>``. Rows before any source row get nulls.

    Put a rank column in ``order`` to decide ties between a source row and another row at the same time. Hot keys are
    range-split as in :func:`with_neighbours`; a range with no source row of its own takes the last source row of the
    ranges before it, from a summary with one row per range.
    """
    keys = _names(key)
    order = _names(order)
    fields = list(fields)
    rec = F.when(F.col(source), F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                                         *[F.col(f).alias(f) for f in fields]))

    def _emit(frame: DataFrame, got: Column) -> DataFrame:
        return frame.select(*df.columns, *[got.getField(f).alias(f"{prefix}{f}") for f in fields])

    keyed = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    rows, hot = df.where(keyed), None
    apart = _emit(df.where(~keyed), F.lit(None).cast(df.select(rec.alias("r")).schema["r"].dataType))
    if skew_safe:
        rows, hot = split_hot(rows, keys, order, _rows_per_slice(df, rows_per_slice))
    upto_here = Window.unboundedPreceding, Window.currentRow
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto_here)
    out = _emit(rows.withColumn(_REC, rec), F.last(_REC, ignorenulls=True).over(w)).unionByName(apart)
    if hot is None:
        return out
    sliced = hot.withColumn(_REC, rec)
    w = Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(*upto_here)
    inner = sliced.withColumn("__l", F.last(_REC, ignorenulls=True).over(w))
    # every slice of a hot key: its own last source row (max ignores nulls), then the last one of earlier slices
    edges = sliced.groupBy(*keys, _SLICE).agg(F.max(_REC).alias("__own"))
    ew = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(*keys, _SLICE, F.last("__own", ignorenulls=True).over(ew).alias("__before"))
    joined = inner.join(edges, on=[*keys, _SLICE], how="left")
    return out.unionByName(_emit(joined, F.coalesce("__l", "__before")))


def running_sum(df: DataFrame, key, order: Sequence[str], value: str, name: str = "running",
                rows_per_slice: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same key up to and including this one, by ``order`` (a total
    order). Null values add nothing.

    Hot keys are range-split as in :func:`with_neighbours`: a slice sums its own rows, and the sums of the slices before
    it come from a summary with one row per slice. Null keys have no rows in common: theirs is the row's own value.
    """
    keys, order = _names(key), _names(order)
    own = F.coalesce(F.col(value), F.lit(0)).cast("long")
    keyed = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    apart = df.where(~keyed).select(*df.columns, own.alias(name))
    rows, hot = split_hot(df.where(keyed), keys, order, _rows_per_slice(df, rows_per_slice))
    upto_here = Window.unboundedPreceding, Window.currentRow
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto_here)
    out = rows.select(*df.columns, F.sum(own).over(w).alias(name)).unionByName(apart)
    if hot is None:
        return out
    w = Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(*upto_here)
    inner = hot.withColumn("__in", F.sum(own).over(w))
    ew = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = hot.groupBy(*keys, _SLICE).agg(F.sum(own).alias("__sum")).select(
        *keys, _SLICE, F.coalesce(F.sum("__sum").over(ew), F.lit(0)).alias("__before"))
    joined = inner.join(before, on=[*keys, _SLICE], how="left")
    return out.unionByName(joined.select(*df.columns, (F.col("__in") + F.col("__before")).alias(name)))
