"""Physical controls: size-checked broadcast, key partitioning, inspection.

Broadcast policy: a side is hinted for broadcast only when the optimizer's
statistics (file sizes of the scans below it) put it under a bound in bytes.
The check reads no data and runs no job. Beyond the bound the join is left
to the planner and AQE, which measure the real shuffle sizes at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 16 << 20   # of compressed files; a few times that in memory
BROADCAST_BYTES_CONF = "spark.ordermart.broadcastMaxBytes"


def broadcast_byte_limit(spark, default: int = DEFAULT_BROADCAST_BYTES) -> int:
    """Byte bound for hinted broadcasts; a session can lower or raise it."""
    return int(spark.conf.get(BROADCAST_BYTES_CONF, str(default)))


def plan_bytes(df: DataFrame) -> int:
    """Size of ``df`` by the optimizer's statistics; without any (data that
    comes from no file) it is unbounded."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    return plan_bytes(df) <= (broadcast_byte_limit(df.sparkSession) if max_bytes is None else max_bytes)


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Hint ``df`` for broadcast only when its size is bounded."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition, computed on the executors (no RDD round trip)."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).count()


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (``explain`` output captured)."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def persist_for_reuse(df: DataFrame, level: str = "MEMORY_AND_DISK") -> DataFrame:
    """Persist a frame that several actions will read (spilling to disk
    rather than recomputing). Use only where reuse is real; cached blocks
    are lost with their executor, so results that must survive failures
    are written with ``sinks.materialize`` instead."""
    from pyspark import StorageLevel
    return df.persist(getattr(StorageLevel, level))


def storage_level(df: DataFrame) -> str:
    return str(df.storageLevel)
