"""Publishing an SCD2 dimension on plain parquet, batch by batch.

:class:`BucketedDimension` keeps whole histories: any batch, late versions and replays among them, leaves what one build
over all versions gives, and only the buckets that it touches are written. :class:`VersionedDimension` keeps the newest
row of a key of each batch after the first, with a commit log; it is safe to replay and to interrupt.

``VersionedDimension``: layout under ``root`` (any Hadoop file system path):

  batches/batch_id=<n>/state=current/   every current row after batch n (one row per key)
  batches/batch_id=<n>/state=closed/    the rows batch n closed (append-only history)
  commits/                              one small parquet row per committed batch: (batch_id, src)

Readers see ``N = max(committed batch_id)``: current rows of batch N plus closed rows of batches <= N. A batch's
directories become visible only once its commit row is written, which happens after its data is complete, so a
crash before the commit leaves readers on batch N-1; a retry overwrites the unfinished directory. A batch whose
``src`` is already committed is skipped (replay). The current partition is rewritten each batch, so the cost of a
batch follows the number of keys, not the length of the history. Each batch is one Spark job that reads only the
current partition; everything it writes is a table, so lineage never grows across batches.

Limits: one writer at a time; superseded ``state=current`` directories below N can be removed by a periodic
clean-up (not done here).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ledgerflow.operators import scd2
from ledgerflow.session import materialize, path_exists

_COMMITS = StructType([StructField("batch_id", IntegerType()), StructField("src", StringType()),
                       StructField("committed_at", StringType())])


@dataclass(frozen=True)
class VersionedDimension:
    root: str
    schema: StructType            # dimension columns incl. is_current / start_date / end_date
    key: str
    version: str
    tie: str | tuple[str, ...] | None = None

    # -- reading --------------------------------------------------------------------------------------------------
    def commits(self, spark: SparkSession) -> DataFrame:
        path = f"{self.root}/commits"
        if not path_exists(spark, path):       # nothing committed yet: an empty log
            return spark.createDataFrame([], _COMMITS)
        return spark.read.schema(_COMMITS).parquet(path)

    def last_batch(self, spark: SparkSession) -> int:
        """Highest committed batch id (0 = nothing published). One scalar aggregate over the tiny commit log."""
        v = self.commits(spark).agg(F.max("batch_id")).first()[0]
        return int(v or 0)

    def _data(self, spark: SparkSession) -> DataFrame:
        full = StructType(self.schema.fields + [StructField("batch_id", IntegerType()),
                                                StructField("state", StringType())])
        return spark.read.schema(full).parquet(f"{self.root}/batches")

    def read(self, spark: SparkSession, n: int | None = None) -> DataFrame:
        """The published dimension as of batch ``n`` (default: the last committed batch). Partition-pruned."""
        n = self.last_batch(spark) if n is None else n
        if n == 0:
            return spark.createDataFrame([], self.schema)
        d = self._data(spark)
        cur = (F.col("state") == "current") & (F.col("batch_id") == n)
        closed = (F.col("state") == "closed") & (F.col("batch_id") <= n)
        return d.where(cur | closed).select(*self.schema.names)

    def current(self, spark: SparkSession, n: int | None = None) -> DataFrame:
        n = self.last_batch(spark) if n is None else n
        if n == 0:
            return spark.createDataFrame([], self.schema)
        d = self._data(spark)
        return d.where((F.col("state") == "current") & (F.col("batch_id") == n)).select(*self.schema.names)

    # -- writing --------------------------------------------------------------------------------------------------
    def _write_batch(self, changes: DataFrame, n: int) -> None:
        out = changes.withColumn("state", F.when(F.col(scd2.IS_CURRENT), "current").otherwise("closed"))
        (out.select(*self.schema.names, "state").write.mode("overwrite").partitionBy("state")
         .parquet(f"{self.root}/batches/batch_id={n}"))

    def _commit(self, spark: SparkSession, n: int, src: str) -> None:
        row = spark.createDataFrame([(n, src, None)], _COMMITS).withColumn(
            "committed_at", F.current_timestamp().cast("string"))
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def apply_batch(self, spark: SparkSession, batch: DataFrame, src: str, mode: str = "latest",
                    stop_before_commit: bool = False) -> bool:
        """Apply one batch; returns False when ``src`` was already committed (replay = no-op)."""
        # one row comes back, however many batches there have been
        seen = self.commits(spark).agg(F.max("batch_id").alias("last"), F.count_if(F.col("src") == src).alias("done")).first()
        if seen["done"]:
            return False
        n = (seen["last"] or 0) + 1
        attrs = [c for c in self.schema.names if c not in (scd2.IS_CURRENT, scd2.START, scd2.END)]
        if n == 1:
            # nothing is published yet: the batch is a history, and all its versions are kept
            changes = scd2.build(batch.select(*attrs), self.key, self.version, self.tie)
        else:
            changes = scd2.apply_changes(self.current(spark, n - 1), batch.select(*attrs), self.key, self.version,
                                         self.tie, mode=mode)
        self._write_batch(changes, n)
        if stop_before_commit:         # test hook: crash after data, before the commit point
            return True
        self._commit(spark, n, src)
        return True

    def apply_stream(self, stream: DataFrame, checkpoint: str, mode: str = "latest"):
        """Drain a stream into the dimension (availableNow). ``src`` = streaming query id + micro-batch id, both
        restored from the checkpoint on restart, so a re-delivered micro-batch is recognised and skipped."""
        from ledgerflow.streaming.ingest import each_batch_available_now

        def _fn(df: DataFrame, batch_id: int) -> None:
            spark = df.sparkSession
            qid = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
            if not qid:    # a shared name would make one stream's batches look like another's replays
                raise RuntimeError("the streaming query has no id: batches cannot be told from replays")
            self.apply_batch(spark, df, f"{qid}:{batch_id}", mode=mode)

        return each_batch_available_now(stream, checkpoint, _fn)


@dataclass(frozen=True)
class BucketedDimension:
    """A versioned dimension as a catalog table partitioned by a hash bucket of the key.

    A batch reads the buckets of its keys, puts its versions into their histories (:func:`scd2.insert`) and writes those
    buckets by Spark's dynamic partition overwrite; other buckets' files are not read nor touched, so the cost follows the
    batch. Insertion does not depend on order and ignores versions that are there, so a replay, or a batch repeated after a
    failed run, changes nothing, and no log of batches is needed.

    Choose ``buckets`` so that one is some hundred MB; a bucket is dealt over several tasks where it is larger (AQE
    rebalance, hot keys split by ``with_neighbours``). Limits: one writer at a time; Spark moves finished partitions
    one after another, so a reader may meet some buckets before and some after a batch, and a driver that dies between
    two moves leaves the rest in the table's staging folder; the batch, applied again together with the versions
    of the buckets that lack them, restores them.
    """

    name: str                     # catalog table
    location: str
    schema: StructType            # dimension columns incl. is_current / start_date / end_date
    key: str
    version: str
    tie: str | tuple[str, ...] | None = None
    buckets: int = 64

    def create(self, spark: SparkSession) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, bucket INT) USING parquet "
                  f"OPTIONS ('partitionOverwriteMode' = 'dynamic') PARTITIONED BY (bucket) LOCATION '{self.location}'")

    def _table(self, spark: SparkSession) -> DataFrame:
        self.create(spark)
        spark.catalog.refreshTable(self.name)      # another session (a stream's) may have written buckets
        return spark.table(self.name)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._table(spark).select(*self.schema.names)

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def apply_batch(self, spark: SparkSession, batch: DataFrame) -> int:
        """Put every version of ``batch`` in; returns the number of buckets written. Rows without key or version time
        are no versions."""
        attrs = [c for c in self.schema.names if c not in (scd2.IS_CURRENT, scd2.START, scd2.END)]
        rows = materialize(scd2.versioned(batch.select(*attrs), self.key, self.version), "dimension-batch")
        touched = [r[0] for r in rows.select(self._bucket()).distinct().collect()]      # at most ``buckets``
        if not touched:
            return 0
        stored = self._table(spark).where(F.col("bucket").isin(touched)).select(*self.schema.names)
        found = scd2.insert(stored, rows, self.key, self.version, self.tie)
        (found.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").write
         .insertInto(self.name, overwrite=True))
        return len(touched)

    def apply_stream(self, stream: DataFrame, checkpoint: str):
        """Drain a stream into the dimension (availableNow); a re-delivered micro-batch changes nothing."""
        from ledgerflow.streaming.ingest import each_batch_available_now

        return each_batch_available_now(stream, checkpoint, lambda df, _: self.apply_batch(df.sparkSession, df) and None)
