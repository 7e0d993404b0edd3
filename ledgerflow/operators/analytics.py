"""Consumer queries over the model: peak activity, price moves, score shifts, point-in-time prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import hour_of
from ledgerflow.operators.sequence import running_sum, with_neighbours


def peak_activity(df: DataFrame, key: str, ts: str, value: str, grain: str = "hour",
                  peak: str = "peak", mean: str | None = None) -> DataFrame:
    """Peak (and optional mean) of ``value`` per key per time bucket; partial aggregation per bucket.

    ``grain``: hour (of the type of ``ts``), or day, week (from Monday), month as the DATE of their first day, which is
    a key of the date dimension.
    """
    bucket = hour_of(ts) if grain == "hour" else F.to_date(F.col(ts) if grain == "day" else F.date_trunc(grain, F.col(ts)))
    aggs = [F.max(value).alias(peak)] + ([F.avg(value).alias(mean)] if mean else [])
    return df.groupBy(key, bucket.alias(grain)).agg(*aggs)


def with_dates(activity: DataFrame, dates: DataFrame, day: str, attributes=("year_week", "is_weekend")) -> DataFrame:
    """Activity rows with attributes of their date (one row per date: no rows are multiplied; Spark picks the join)."""
    return activity.join(dates.select(F.col("full_date").alias(day), *attributes), on=day, how="left")


def activity_churn(daily: DataFrame, key: str, day: str, value: str, fall: float, gap: int) -> DataFrame:
    """Churn flags per key and active day: ``fell`` = activity at least the share ``fall`` below the last active day's;
    ``silent_days`` until the next active day (null: none follows); ``lapsed`` = at least ``gap`` silent days follow."""
    nb = with_neighbours(daily, key, [day], [day, value], prev="__prev_", nxt="__next_")
    silent = F.date_diff(F.col(f"__next_{day}"), F.col(day)) - 1
    before = F.col(f"__prev_{value}")
    return nb.select(key, day, value, F.coalesce(F.col(value) <= before * (1 - fall), F.lit(False)).alias("fell"),
                     silent.alias("silent_days"), F.coalesce(silent >= gap, F.lit(False)).alias("lapsed"))


def price_moves(versions: DataFrame, key: str, ts: str, value: str, tie: str | None = None,
                drops_only: bool = True, delta: str = "delta") -> DataFrame:
    """Change between consecutive versions of a key (``value - previous value``, 2 decimals).

    ``drops_only`` keeps price drops only (the alert case).
    """
    order = [ts] + ([tie] if tie else [])
    nb = with_neighbours(versions, key, order, [value], prev="__prev_", nxt=None)
    prev = F.col(f"__prev_{value}")
    out = nb.where(prev.isNotNull())
    if drops_only:
        out = out.where(F.col(value) < prev)
    return out.select(key, ts, F.round(F.col(value) - prev, 2).alias(delta))


def score_shift(daily: DataFrame, key: str, day: str, score: str, threshold: float,
                shift: str = "shift", flag: str = "alert") -> DataFrame:
    """Day-over-day shift of a per-key daily score, flagged when ``|shift| >= threshold``."""
    nb = with_neighbours(daily, key, [day], [score], prev="__prev_", nxt=None)
    prev = F.col(f"__prev_{score}")
    d = F.round(F.col(score) - prev, 2)
    return nb.where(prev.isNotNull()).select(key, day, score, d.alias(shift), (F.abs(d) >= threshold).alias(flag))


def price_islands(versions: DataFrame, key: str, ts: str, value: str, tie: str | None = None,
                  rows_per_slice: int | None = None) -> DataFrame:
    """Ledger of real changes: consecutive versions of a key with an equal value (nulls equal) are one row.

    (key, island from 1, value, ``first_ts``, ``last_ts``, ``until`` = the next island's first time (null: none follows),
    ``versions`` merged). An island's number is the running count of changes, so a hot key needs no task of its own; its
    islands are then grouped by (key, number). Rows without a key or a time are no versions.
    """
    order = [ts] + ([tie] if tie else [])
    rows = versions.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(key, *order, value, F.lit(1).alias("__one"))
    nb = with_neighbours(rows, key, order, [value, "__one"], prev="__prev_", nxt=None, rows_per_slice=rows_per_slice)
    change = F.col("__prev___one").isNull() | ~F.col(value).eqNullSafe(F.col(f"__prev_{value}"))
    marked = nb.select(key, *order, value, change.cast("long").alias("__change"))
    numbered = running_sum(marked, key, order, "__change", "island", rows_per_slice=rows_per_slice)
    islands = numbered.groupBy(key, "island").agg(F.first(value).alias(value), F.min(ts).alias("first_ts"),
                                                  F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("versions"))
    nb = with_neighbours(islands, key, ["island"], ["first_ts"], prev=None, nxt="__next_", rows_per_slice=rows_per_slice)
    return nb.select(key, "island", value, "first_ts", "last_ts", F.col("__next_first_ts").alias("until"), "versions")
