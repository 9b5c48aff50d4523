"""Events loaded once each from a stream that repeats them."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_distinct(spark: SparkSession, source: str, schema: StructType, target: str, *,
                    key: str, ts: str, delay: str, checkpoint: str,
                    files_per_trigger: int | None = None) -> StreamingQuery:
    """Append the rows of the parquet files arriving under ``source`` to
    ``target``, each ``key`` once, and stop when nothing is left.

    Keys are remembered in the state store under ``checkpoint`` until the
    watermark passes their event time by ``delay``; a repeat that arrives within
    it is dropped, also after a restart.  The file sink commits each micro-batch
    once, so an interrupted run neither loses nor doubles rows.  Rows without a
    key or event time are not loaded.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = (reader.parquet(source).where(F.col(key).isNotNull() & F.col(ts).isNotNull())
            .withColumn("_event_time", F.col(ts).cast("timestamp"))
            .withWatermark("_event_time", delay)
            .dropDuplicatesWithinWatermark([key]).drop("_event_time"))
    return (rows.writeStream.format("parquet").option("path", target)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())
