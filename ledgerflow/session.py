"""Session construction for tests/bench and the shared work folder used for lineage cuts and stream state."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every ledgerflow job assumes. Cluster deployments pass the same keys through spark-submit.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerflow",
                  extra: dict | None = None) -> SparkSession:
    """Local-mode session for tests and the bench (single JVM, ``cores`` task threads)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("LEDGERFLOW_DRIVER_MEMORY", "8g")))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, below the cluster's ``spark.checkpoint.dir``.

    The setting is read from the session. Only when it is unset *and* the master is local (tests, bench, one
    machine) do we create our own; on a cluster an unset checkpoint dir is an error, never a machine-local path.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions expose no SparkContext
        sc = None
    if sc is not None:
        base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        master = sc.master
    else:
        base = spark.conf.get("spark.checkpoint.dir", None)
        master = spark.conf.get("spark.master", "")
    if not base:
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: point it at a shared folder (HDFS/object store)")
        base = tempfile.mkdtemp(prefix="ledgerflow-")
        if sc is not None:
            sc.setCheckpointDir(base)
        else:
            spark.conf.set("spark.checkpoint.dir", base)
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on any Hadoop file system (HDFS, object stores, local), without a failing read."""
    try:
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))
    except AttributeError:  # Spark Connect: no JVM handle; probe by reading
        try:
            spark.read.format("binaryFile").load(path).limit(1).count()
            return True
        except Exception:  # noqa: BLE001
            return False


def materialize(df, name: str):
    """Cut the lineage of ``df``: write it once as parquet under :func:`fresh_dir` and read it back.

    Unlike an eager ``checkpoint()`` (which runs the plan once to count and again to write), this computes the
    plan once, and the result survives executor loss (it lives in the shared checkpoint folder).
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under :func:`work_dir` (one per run; nothing is ever cleared in place)."""
    return work_dir(spark, "runs", f"{name}-{uuid.uuid4().hex[:12]}")
