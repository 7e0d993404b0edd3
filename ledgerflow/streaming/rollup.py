"""Activity roll-up from hour to day to week, kept up by a stream of mergeable partials.

Each micro-batch leaves one row per key and hour: (peak, total, n), which merge by max, sum and sum. A batch's partials lie
in a folder of their own, partitioned by day; a batch that is delivered again writes its folder anew, so nothing counts
twice. Any grain is read by merging partials, never the activity itself: a week of a key is at most 168 rows a batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import hour_of
from ledgerflow.session import path_exists
from ledgerflow.streaming.ingest import each_batch_available_now


def merged(partials: DataFrame, *by) -> DataFrame:
    return partials.groupBy(*by).agg(F.max("peak").alias("peak"), F.sum("total").alias("total"), F.sum("n").alias("n"))


@dataclass(frozen=True)
class ActivityRollup:
    """``key``, ``ts`` and ``value`` of the activity rows. Values are integers (minor units), so that sums do not depend on
    their order; null values count in ``n`` only. One writer at a time."""

    root: str
    key: str
    ts: str
    value: str

    def _write(self, partials: DataFrame, batch: str) -> None:
        days = partials.withColumn("day", F.to_date("hour"))
        days.write.mode("overwrite").partitionBy("day").parquet(f"{self.root}/batch={batch}")

    def apply_batch(self, rows: DataFrame, batch: int) -> None:
        own = rows.select(self.key, hour_of(self.ts).alias("hour"), F.col(self.value).cast("long").alias("v"))
        partials = own.groupBy(self.key, "hour").agg(F.max("v").alias("peak"), F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))
        self._write(partials, f"{batch:012d}")

    def apply_stream(self, stream: DataFrame, checkpoint: str):
        return each_batch_available_now(stream, checkpoint, self.apply_batch)

    def partials(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", self.root).parquet(f"{self.root}/batch=*")

    def read(self, spark: SparkSession, grain: str) -> DataFrame:
        """(key, ``grain``, peak, total, n); hour as a time, day and week (from Monday) as dates."""
        if not path_exists(spark, self.root):
            raise ValueError(f"nothing has been rolled up at {self.root}")
        bucket = F.col("hour") if grain == "hour" else F.to_date(F.date_trunc(grain, "hour"))
        return merged(self.partials(spark), self.key, bucket.alias(grain))
