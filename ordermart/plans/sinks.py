"""Sinks, table registration and the SQL surface.

Writers are idempotent overwrites of whole directories (a re-run after a
lost executor or a failed job rewrites the same output), partitioned by
``order_year_month`` for the wide table so month filters prune files.
Scratch data goes under the shared folder the session names in
``spark.checkpoint.dir``, never a machine-local temporary folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir

WIDE_PARTITION = "order_year_month"
WIDE_OPTIONS = {"compression": "zstd"}      # ids and texts: about half of what snappy leaves of them


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/ordermart-{spark.sparkContext.applicationId}"


def clean_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote there; call it when its results
    have been read (frames that were materialized are lazy scans of it)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cluster_for_write(df: DataFrame, partition_by: Sequence[str], how: str = "rebalance") -> DataFrame:
    """Arrange rows for a partitioned write.

    ``rebalance``: shuffle by the partition columns with the REBALANCE hint;
    AQE then splits any oversized value (a month holding a third of the
    rows is written by many tasks) and merges small ones, so files land
    near the advisory size. ``sort``: no shuffle, each task sorts its rows
    by the partition columns and writes one file per value it holds (more,
    smaller files; no network). A plain ``repartition(month)`` is never
    used: it sends each month to a single task."""
    if not partition_by:
        return df
    if how == "rebalance":
        return df.hint("rebalance", *partition_by)
    if how == "sort":
        return df.sortWithinPartitions(*partition_by)
    if how == "none":                       # arranged already
        return df
    raise ValueError("how must be 'rebalance', 'sort' or 'none'")


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                  how: str = "rebalance") -> None:
    """Bronze/silver Parquet sink, optionally partitioned."""
    w = cluster_for_write(df, partition_by, how).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_wide(df: DataFrame, path: str, fmt: str = "parquet", how: str = "sort") -> None:
    """The wide table, partitioned by month. Its rows are several times as
    wide as the order and item rows they are joined from, so by default they
    are not shuffled once more: each task of the join writes a file for each
    month it holds. ``fmt`` names the table format (a lakehouse format where
    installed); schema changes across overwrites are reconciled on read with
    ``mergeSchema``."""
    (cluster_for_write(df, [WIDE_PARTITION], how).write.format(fmt).mode("overwrite").options(**WIDE_OPTIONS)
     .partitionBy(WIDE_PARTITION).save(path))


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV with quoting/escaping so multi-line text round-trips."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .csv(path))


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] = (WIDE_PARTITION,),
               fmt: str = "parquet") -> None:
    """Managed, partitioned table in the session catalog."""
    w = df.write.format(fmt).mode("overwrite").options(**WIDE_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, fmt: str = "parquet") -> None:
    """Managed table dealt into ``buckets`` files by the hash of ``key`` and
    sorted by it. Two tables with as many buckets join on their keys without
    a shuffle. One key is one bucket: a table with a hot key is better joined
    by ``wide.order_item_join``, whose shuffle the engine can split."""
    (df.repartition(buckets, key).write.format(fmt).mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .saveAsTable(name))


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_external_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS .. USING fmt LOCATION path``; the
    database is created first, and partitions are discovered."""
    if "." in name:
        create_database(spark, name.split(".", 1)[0])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def path_scan(spark: SparkSession, path: str, fmt: str = "parquet", order_by: str | None = None) -> DataFrame:
    """``SELECT * FROM fmt.`path` [ORDER BY ...]`` through Spark SQL."""
    sql = f"SELECT * FROM {fmt}.`{path}`"
    if order_by:
        sql += f" ORDER BY {order_by}"
    return spark.sql(sql)


def register(tables: dict[str, DataFrame]) -> list[str]:
    """Named-table registry as session temp views; returns the names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def materialize(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared scratch folder and reading
    it back: the result survives executor loss (unlike cached blocks) and
    later jobs start from files instead of re-running the plan."""
    path = f"{scratch_root(spark)}/materialized/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
