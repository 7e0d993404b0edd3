"""Scalar column helpers: labels, money, ratios, epoch and calendar parts. All JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator the catalogue uses when it joins multi-valued labels into one string.
LABEL_SEPARATOR = ", "


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def join_labels(arr, sep: str = LABEL_SEPARATOR) -> Column:
    """Array of strings -> one string. Null elements are skipped; a null or empty array gives '' (never null)."""
    return F.concat_ws(sep, _c(arr))


def to_minor_units(amount) -> Column:
    """Major units (e.g. 12.34) -> integer minor units (1234), rounded half-up."""
    return F.round(_c(amount) * 100).cast("bigint")


def to_major_units(minor) -> Column:
    """Integer minor units -> major units as DOUBLE (true division)."""
    return _c(minor) / F.lit(100)


def ratio_pct(part, whole, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, rounded once at the end.

    Null when ``whole`` is 0 or null (try_divide: ANSI mode would raise on /0).
    """
    return F.round(F.try_divide(_c(part) * F.lit(100.0), _c(whole)), digits)


def ratio_pct_parity(part, whole) -> Column:
    """The catalogue's original form ``round(part/whole, 4) * 100`` (keeps its last-bit double noise)."""
    return F.round(F.try_divide(_c(part), _c(whole)), 4) * 100


def epoch_seconds_to_ts(sec) -> Column:
    """UNIX seconds -> TIMESTAMP instant (null-safe, no string round trip)."""
    return F.timestamp_seconds(_c(sec))


def epoch_seconds_to_ts_ntz(sec) -> Column:
    """UNIX seconds -> TIMESTAMP_NTZ holding the UTC wall clock, independent of the session time zone."""
    return F.timestamp_add("SECOND", _c(sec), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def hour_of(ts) -> Column:
    """Start of the hour, of the type of ``ts``: minutes and seconds are taken off (``date_trunc`` always answers
    TIMESTAMP, whatever comes in)."""
    c, zero = _c(ts), F.lit(0)
    return c - F.make_dt_interval(zero, zero, F.minute(c), F.extract(F.lit("SECOND"), c))


def year_week(d) -> Column:
    """Catalogue's ``year_week``: calendar year glued to the ISO week (2021-01-01 -> '2021-53')."""
    return F.concat(F.year(_c(d)), F.lit("-"), F.lpad(F.weekofyear(_c(d)).cast("string"), 2, "0"))


def iso_year_week(d) -> Column:
    """ISO year and ISO week together (2021-01-01 -> '2020-53', 2024-12-30 -> '2025-01')."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), _c(d)), F.lit("-"),
                    F.lpad(F.weekofyear(_c(d)).cast("string"), 2, "0"))
