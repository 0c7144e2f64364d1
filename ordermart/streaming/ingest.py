"""Incremental raw -> bronze ingest with Structured Streaming.

Landing folders receive new CSV files over time. A file-source stream with
the table's declared schema picks up only files it has not seen, applies
the table's row-level cleaning and appends Parquet to the bronze folder.
``availableNow`` processes everything pending and stops (a scheduled
batch-style run); the checkpoint, kept in the shared checkpoint folder,
records finished files and offsets, so a run that dies half-way resumes
without duplicates or gaps.

Only row-level cleaners stream: product sizing (quantiles) and payment
imputation (a mean) need the whole table and run as batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import clean
from ..plans.sinks import scratch_root
from ..sources import schemas
from ..sources.readers import MULTILINE_TABLES

ROW_LEVEL_CLEANERS = {
    "orders": clean.clean_orders,
    "order_items": clean.clean_items,
    "order_reviews": clean.clean_reviews,
}


def landing_stream(spark: SparkSession, landing_path: str, table: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(schemas.struct(table)).option("header", True)
              .option("multiLine", table in MULTILINE_TABLES).option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(landing_path)


def start_bronze_ingest(spark: SparkSession, landing_path: str, table: str, bronze_path: str,
                        checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    if table not in ROW_LEVEL_CLEANERS:
        raise ValueError(f"{table} needs whole-table statistics; ingest it with the batch cleaner")
    cleaned = ROW_LEVEL_CLEANERS[table](landing_stream(spark, landing_path, table))
    ckpt = checkpoint or f"{scratch_root(spark)}/streams/bronze-{table}"
    writer = (cleaned.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", ckpt).option("path", bronze_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def ingest_available(spark: SparkSession, landing_path: str, table: str, bronze_path: str,
                     checkpoint: str | None = None) -> DataFrame:
    """Run the ingest over everything pending and return the bronze table."""
    q = start_bronze_ingest(spark, landing_path, table, bronze_path, checkpoint, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(bronze_path)
