"""Logical-day calendar: a day that starts at a cut-over hour (UTC) instead of midnight.

The catalogue refreshes at 16:00 UTC, so an observation before 16:00 belongs to the previous logical day.
Everything here is a native expression (no UDF), usable on batch and streaming frames alike.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the hour (UTC) at which a new logical day starts.
CUTOVER_HOUR = 16


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def logical_day(ts, cutover_hour: int = CUTOVER_HOUR) -> Column:
    """DATE of the logical day of ``ts``: hour < cutover -> previous calendar date.

    Works for TIMESTAMP (read in the session time zone, which ledgerflow pins to UTC) and TIMESTAMP_NTZ.
    """
    return F.to_date(_c(ts) - F.make_dt_interval(F.lit(0), F.lit(cutover_hour)))


def logical_day_between(ts, first_day, last_day, cutover_hour: int = CUTOVER_HOUR) -> Column:
    """Predicate ``first_day <= logical_day(ts) <= last_day`` written on the raw column.

    Catalyst does not move ``ts - 16h >= c`` to ``ts >= c + 16h``, so the filter would not reach the parquet scan.
    Stating the bounds on ``ts`` itself keeps the predicate sargable (shows up under PushedFilters).
    """
    lo = dt.datetime.combine(_as_date(first_day), dt.time(cutover_hour))
    hi = dt.datetime.combine(_as_date(last_day) + dt.timedelta(days=1), dt.time(cutover_hour))
    return (_c(ts) >= F.lit(lo)) & (_c(ts) < F.lit(hi))


def _as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def logical_day_py(ts: dt.datetime, cutover_hour: int = CUTOVER_HOUR) -> dt.date:
    """Plain-Python statement of the same rule (driver-side scalars and tests)."""
    return (ts - dt.timedelta(hours=cutover_hour)).date()


def batch_due(df: DataFrame, ts_col: str, now, by: list[str] | None = None,
              cutover_hour: int = CUTOVER_HOUR) -> DataFrame:
    """Run-once-per-logical-day gate.

    One row per ``by`` group (or one row overall): ``last_ts`` = newest batch time, ``last_day`` its logical day,
    ``run_day`` = logical day of ``now``, ``due`` = no batch yet (null) or the last batch is from another logical day.
    A plain global/grouped ``max``: partial aggregation, one tiny row per group leaves each task.
    """
    now_c = F.lit(now) if not isinstance(now, Column) else now
    grouped = df.groupBy(*(by or []))
    out = grouped.agg(F.max(ts_col).alias("last_ts"))
    last_day = logical_day("last_ts", cutover_hour)
    run_day = logical_day(now_c, cutover_hour)
    return out.select(*(by or []), "last_ts", last_day.alias("last_day"), run_day.alias("run_day"),
                      (F.col("last_ts").isNull() | (last_day != run_day)).alias("due"))
