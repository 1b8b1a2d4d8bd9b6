"""Incremental bronze ingest with Structured Streaming.

The batch ingest re-reads whole folders; the streaming form picks up only
files that arrived since the last run. ``trigger(availableNow=True)`` drains
everything new and stops, so a scheduler can run it like a batch job while the
state folder of the target remembers which files were taken.
Lineage: the ingestion time is the micro-batch time (``current_timestamp`` is
fixed per batch) and the source file comes from the scan metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bronze_stream(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, multiline: bool = False, **options) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = (reader.option("header", True).option("quote", '"').option("escape", '"')
                  .option("multiLine", multiline))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    raw = reader.load(source_dir)
    return raw.select("*", F.current_timestamp().alias("_ingestion_timestamp"),
                      F.col("_metadata.file_name").alias("_source_file"))


def run_bronze_ingest(spark: SparkSession, source_dir: str, target_dir: str, schema: T.StructType,
                      fmt: str = "parquet", checkpoint_location: str | None = None, **options) -> None:
    """Append every not-yet-ingested file of ``source_dir`` to ``target_dir`` and stop.

    What was taken is remembered in ``checkpoint_location``, by default a folder
    in the target itself that readers skip, so it belongs to this target alone
    and outlives the application.
    """
    if checkpoint_location is None:
        checkpoint_location = target_dir.rstrip("/") + "/_ingest_state"
    query = (bronze_stream(spark, source_dir, schema, fmt, **options).writeStream
             .format("parquet").option("path", target_dir).option("checkpointLocation", checkpoint_location)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
