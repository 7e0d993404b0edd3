"""Many-to-many bridge tables (item <-> label) for star-schema filtering.

Both builders end in a ``distinct`` on (key, label): a hash aggregate with partial aggregation, so duplicate labels
of a hot item collapse on the map side before the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _only_current(df: DataFrame, current_col: str | None) -> DataFrame:
    return df.where(F.col(current_col)) if current_col else df


def from_array(df: DataFrame, key: str, array_col: str, label: str, current_col: str | None = None) -> DataFrame:
    """(key, label) for every element of ``array_col``; null/empty arrays give no row, null elements are dropped."""
    exploded = _only_current(df, current_col).select(key, F.explode(array_col).alias(label))
    return exploded.where(F.col(label).isNotNull()).distinct()


def from_delimited(df: DataFrame, key: str, text_col: str, label: str, sep: str = ",",
                   current_col: str | None = None, parity: bool = False, unique: bool = True) -> DataFrame:
    """(key, trimmed token) for every ``sep``-separated token of ``text_col``; ``unique=False`` saves the shuffle where
    the bridge is only the inner side of a semi join.

    Blank tokens are removed *after* trimming. ``parity=True`` tests before trimming, as the original job did, so a
    token of spaces survives as ''.
    """
    tok = F.explode(F.split(F.col(text_col), re.escape(sep))).alias("__tok")
    exploded = _only_current(df, current_col).select(key, tok)
    if parity:
        exploded = exploded.where(F.col("__tok") != "")
        out = exploded.select(key, F.trim("__tok").alias(label))
    else:
        out = exploded.select(key, F.trim("__tok").alias(label)).where(F.col(label) != "")
    return out.distinct() if unique else out


def items_with_label(items: DataFrame, bridge: DataFrame, key: str, label: str, value) -> DataFrame:
    """Star filter through a bridge: items having ``label = value`` (left semi join, no row multiplication)."""
    hits = bridge.where(F.col(label) == F.lit(value)).select(key)
    return items.join(hits, on=key, how="left_semi")


def items_with_labels(items: DataFrame, bridge: DataFrame, key: str, label: str, all_of: Sequence = (), any_of: Sequence = (),
                      none_of: Sequence = ()) -> DataFrame:
    """Star filter by several labels: items that have every label of ``all_of``, at least one of ``any_of`` (if given) and
    none of ``none_of``. An empty filter keeps all items; items with a null key have no labels.

    Relational division by counts: only rows of the bridge with a label that is asked for are read, and each item's become
    one row of three numbers (partial aggregation, so that an item with many labels leaves a task as one row).
    """
    asked = sorted({*all_of, *any_of, *none_of})
    if not asked:
        return items
    which = lambda labels: F.col(label).isin(*labels) if labels else F.lit(False)
    hits = (bridge.where(F.col(label).isin(*asked)).select(key, label).distinct().groupBy(key)
            .agg(F.count_if(which(set(all_of))).alias("__all"), F.count_if(which(set(any_of))).alias("__any"),
                 F.count_if(which(set(none_of))).alias("__none")))
    found = items.join(hits, on=key, how="left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    fits = (count("__all") == len(set(all_of))) & (count("__none") == 0)
    if any_of:
        fits = fits & (count("__any") > 0)
    return found.where(fits).select(*items.columns)
