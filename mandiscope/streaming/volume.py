"""Daily volume of an event stream by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

VOLUME = "day date, n long, batch long"


def stream_daily_volume(
    events: DataFrame, target: str, checkpoint: str, time: str = "ts", late: str = "2 days"
) -> StreamingQuery:
    """Count the events of a stream per UTC day and keep every day's latest count under ``target``.

    Rows up to ``late`` behind the newest event of earlier micro-batches are counted, later ones are dropped, as Spark's
    watermark states; days that far back leave the state. Each micro-batch writes the days it changed to a folder of
    its number, so one repeated after a failure replaces itself, and a restart from ``checkpoint`` goes on with the
    counts it had. Takes in what has landed and ends.
    """
    days = (
        events.select(F.col(time).cast("timestamp").alias("at"))
        .withWatermark("at", late)
        .groupBy(F.window("at", "1 day"))
        .agg(F.count("*").alias("n"))
        .select(F.to_date("window.start").alias("day"), "n")
    )

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return days.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_daily_volume(spark: SparkSession, target: str) -> DataFrame:
    """``day`` and ``n``, the count of the last micro-batch that changed it."""
    schema = T.StructType.fromDDL(VOLUME)
    found = spark.read.schema(schema).option("basePath", target).parquet(target)
    return found.groupBy("day").agg(F.max_by("n", "batch").alias("n"))
