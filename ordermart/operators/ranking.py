"""Whole-table ranking without a single-partition window.

``rank() OVER (ORDER BY v DESC)`` with no partition key moves every row to
one task. Here the rank of a value is 1 + the number of rows with a
strictly greater value, computed as:

1. a histogram of distinct values (partial aggregation);
2. range partitioning of the histogram by value, so partition ids follow
   the sort order;
3. within each range partition, the rows counted before each value (a
   window keyed by the partition id: each group is one range partition);
4. per-partition totals -> exclusive prefix offsets, a table with one row
   per partition (its size is bounded by the partition count, so it is
   broadcast); the range-partitioned histogram is written once so both
   branches see the same partition ids;
5. rank = 1 + partition offset + rows before within the partition, joined
   back to the rows on the value (null-safe: nulls sort last).

The rows are written once and read by both branches, so the input is
evaluated once and both see the same values. The window over partition
offsets runs in one task; it has one row per range partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def global_rank(df: DataFrame, value: str, name: str = "rank", dense: bool = False,
                partitions: int | None = None) -> DataFrame:
    import uuid

    from ..plans.sinks import materialize
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = materialize(df, spark, f"global-rank-rows-{uuid.uuid4().hex}")
    order = F.desc_nulls_last(value)
    weight = F.lit(1).cast("bigint") if dense else F.count("*")
    hist = df.groupBy(value).agg(weight.alias("_n"))
    # partition ids belong to one physical execution: write the ranged
    # histogram (one row per distinct value) once and read it in both branches
    ranged = materialize(hist.repartitionByRange(n, order).withColumn("_pid", F.spark_partition_id()),
                         spark, f"global-rank-{uuid.uuid4().hex}")
    before = Window.partitionBy("_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    totals = local.groupBy("_pid").agg(F.sum("_n").alias("_tot"))
    prior = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_tot").over(prior), F.lit(0)).alias("_off"))
    ranks = (local.join(F.broadcast(offsets), "_pid")
             .select(F.col(value).alias("_v"), (F.lit(1) + F.col("_off") + F.col("_before")).cast("long").alias(name)))
    return df.join(ranks, df[value].eqNullSafe(ranks["_v"]), "inner").drop("_v")

