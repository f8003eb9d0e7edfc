"""Structured Streaming version of the staging step.

New NDJSON files dropped into a folder are typed with the same schema and
casts as the batch staging and appended to the staged table (Parquet,
partitioned by event name, same layout as the warehouse build). The stream's
checkpoint records which files were consumed, so a restarted or failed query
resumes without duplicating rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from liftlens.operators.staging import stage_events
from liftlens.schema import RAW_TEXT_EVENTS
from liftlens.sources.tables import PARTITIONED_BY, partition_of, table_path


def stage_event_stream(spark: SparkSession, path: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of staged events read from NDJSON files in ``path``."""
    reader = spark.readStream.schema(RAW_TEXT_EVENTS).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return stage_events(reader.json(path))


def write_staged_stream(staged: DataFrame, warehouse_dir: str, checkpoint_path: str,
                        available_now: bool = True) -> StreamingQuery:
    """Append the staged stream to the warehouse's ``stg_events``; exactly-once by the checkpoint.

    ``liftlens.plans.job.build_from_staged`` builds the other tables from it.
    """
    column = F.col(PARTITIONED_BY["stg_events"])
    writer = (staged.withColumn("part", partition_of(column)).writeStream.format("parquet")
              .outputMode("append")
              .partitionBy("part")
              .option("checkpointLocation", checkpoint_path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(table_path(warehouse_dir, "stg_events"))
