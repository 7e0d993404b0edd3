"""Change detection between catalogue snapshots and the pending-fetch worklist. All joins, no driver collect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.sequence import latest_per_key


def changed(new: DataFrame, old: DataFrame, key: str, cmp: Sequence[str] = ("last_modified",),
            keep: Sequence[str] = ("extracted_at",), null_safe: bool = False) -> DataFrame:
    """Keys present in both snapshots whose ``cmp`` columns differ; returns ``key`` + ``keep`` from ``new``.

    ``null_safe=False`` is the original semantics (``!=``: a null on either side never counts as a change);
    ``null_safe=True`` compares with ``NOT (a <=> b)``.
    """
    n, o = new.alias("new"), old.alias("old")
    diffs = []
    for c in cmp:
        a, b = F.col(f"new.{c}"), F.col(f"old.{c}")
        diffs.append(~a.eqNullSafe(b) if null_safe else a != b)
    cond = diffs[0]
    for d in diffs[1:]:
        cond = cond | d
    return (n.join(o.select(key, *cmp), on=key, how="inner").where(cond)
            .select(F.col(key), *[F.col(f"new.{c}").alias(c) for c in keep]))


def pending(catalog: DataFrame, changes: DataFrame, details: DataFrame, key: str = "appid",
            at: str = "extracted_at", why: str = "why") -> DataFrame:
    """Items to (re)fetch: one row per key.

    * changed: change-log entries ``(key, at)`` with no details row fetched at that time (composite anti join);
    * new: catalogue keys with no details row at all (anti join).
    When a key is pending for several reasons/times, the newest ``at`` wins and a change entry beats a new-key
    entry at the same time; older change entries of that key count as covered by the newer fetch.
    """
    # de-duplicate the anti-join build sides first (partial aggregation): an item fetched many times would
    # otherwise land in one task, and AQE cannot split the build side of an anti join
    # both joins are on the key alone, so that details stored in buckets of it are not shuffled
    done = details.select(key, F.col(at).alias("__at")).distinct()
    known = details.select(key).distinct()
    same_time = (F.col(at) >= F.col("__at")) & (F.col(at) <= F.col("__at"))
    chg = changes.select(key, at).join(done.withColumnRenamed(key, "__key"), (F.col(key) == F.col("__key")) & same_time, "left_anti")
    chg = chg.withColumn(why, F.lit("changed"))
    new = catalog.select(key, at).join(known, on=key, how="left_anti").withColumn(why, F.lit("new"))
    both = chg.unionByName(new, allowMissingColumns=True)
    ranked = both.withColumn("__prio", F.when(F.col(why) == "changed", 1).otherwise(0))
    return latest_per_key(ranked, key, [at, "__prio"]).drop("__prio")
