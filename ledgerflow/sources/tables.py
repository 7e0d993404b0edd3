"""Table helpers: typed reads of the driver tables, replace / append / create-once writes, namespaces, views."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the driver tables this engine reads (one parquet file each under an sf directory).
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                 "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table. Projections and filters applied later are pushed into this scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def replace_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Whole-table replace (``CREATE OR REPLACE TABLE AS`` is not available for session-catalog tables).

    Spark refuses to overwrite a table the same plan reads; callers that derive ``df`` from ``name`` must cut the
    lineage first (``DataFrame.checkpoint()`` into ``spark.checkpoint.dir``).
    """
    df.write.mode("overwrite").format(fmt).saveAsTable(name)


def replace_partition(df: DataFrame, name: str, part: str, value, fmt: str = "parquet") -> None:
    """Make ``df`` the whole content of one partition, ``part`` = ``value``; the other partitions stay as they are.

    A rerun replaces what an earlier run wrote, whole or half, also by nothing.
    """
    spark = df.sparkSession
    if not table_exists(spark, name):
        df.limit(0).withColumn(part, F.lit(value)).write.format(fmt).partitionBy(part).saveAsTable(name)
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({part} = '{value}') SELECT * FROM {{rows}}", rows=df)


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    df.write.mode("append").format(fmt).saveAsTable(name)


def swap_table(df: DataFrame, name: str, fmt: str = "parquet", stop_before_swap: bool = False) -> str:
    """Replace what readers of ``name`` see, whole and at once: the rows go to a new table ``name__v<n>``, then the view
    ``name`` is pointed at it in one statement, then the versions before the last two are dropped.

    A run that stops before the swap leaves readers with the old rows, and its unfinished table to the next run, which
    writes it anew; the last version but one stays for queries that are under way. ``df`` may read ``name``. One writer at a
    time. Returns the new table's name.
    """
    spark = df.sparkSession
    prefix = f"{name.split('.')[-1]}__v"
    db = name.rsplit(".", 1)[0] if "." in name else spark.catalog.currentDatabase()
    known = sorted(int(t.name[len(prefix):]) for t in spark.catalog.listTables(db, f"{prefix}*") if t.name[len(prefix):].isdigit())
    shown = _shown_version(spark, name, prefix)
    new = f"{name}__v{shown + 1}"
    df.write.mode("overwrite").format(fmt).saveAsTable(new)
    if stop_before_swap:       # test hook
        return new
    replace_view(spark, name, f"SELECT * FROM {new}")
    for n in known:
        if n < shown:
            spark.sql(f"DROP TABLE IF EXISTS {name}__v{n}")
    return new


def _shown_version(spark: SparkSession, name: str, prefix: str) -> int:
    """Number of the table that the view ``name`` reads; 0 without a view."""
    if not table_exists(spark, name):
        return 0
    text = spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
    found = re.findall(rf"{re.escape(prefix)}(\d+)", text)
    return int(found[-1]) if found else 0


def bucketed_table(df: DataFrame, name: str, key: str, buckets: int, fmt: str = "parquet") -> None:
    """Whole-table write in buckets of ``key``: later joins and groupings on it read the table without a shuffle."""
    df.write.mode("overwrite").format(fmt).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def create_once(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS name USING fmt AS rows`` -- a second call leaves the table as it is."""
    df.sparkSession.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} AS SELECT * FROM {{rows}}", rows=df)


def replace_view(spark: SparkSession, name: str, select_sql: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select_sql}")


def create_view_once(spark: SparkSession, name: str, select_sql: str) -> None:
    spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS ({select_sql})")
