"""Message streams to long readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickforge.operators.reshape import messages_to_long
from tickforge.schemas import PLC_READINGS, SENSORS


def message_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Text files of one JSON message per line; one file per trigger replays tick by tick."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def kafka_messages(spark: SparkSession, servers: str, topic_pattern: str) -> DataFrame:
    """Messages of all matching topics (needs the Kafka connector on the classpath)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", topic_pattern)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    """Long rows with event and arrival time; rejects are counted, then dropped.

    The counts appear as the observed metrics ``messages`` of the query's progress.
    """
    parsed = messages_to_long(messages).withColumn("time", F.current_timestamp())
    counted = parsed.observe(
        "messages",
        F.count(F.lit(1)).alias("received"),
        F.count_if(~F.col("accepted")).alias("rejected"),
    )
    return counted.filter("accepted").select(
        "id_machine", "sensor", F.col("value_number").alias("value"), "sensor_timestamp", "time"
    )


def known_sensors(long: DataFrame) -> DataFrame:
    """Only sensors and PLC readings of the data model."""
    return long.filter(F.col("sensor").isin(*SENSORS, *PLC_READINGS))


def without_repeats(long: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drops repeated (machine, sensor, event time) within the delay.

    For live figures only: the watermark also drops rows that come later than the delay.
    """
    marked = long.withColumn("event_at", F.col("sensor_timestamp").cast("timestamp")).withWatermark("event_at", delay)
    return marked.dropDuplicatesWithinWatermark(["id_machine", "sensor", "event_at"]).drop("event_at")


def start_export(
    long: DataFrame, path: str, checkpoint: str, every: str | None = "5 minutes"
) -> StreamingQuery:
    """Writes every reading to date-partitioned Parquet, however late it comes.

    A reading of a (machine, sensor, event time) that is already stored replaces it, the last to
    arrive wins, and a repeated batch changes nothing. Readings without event time go to
    the partition without date.
    """
    from tickforge.sources.sinks import upsert_days

    key = ["id_machine", "sensor", "sensor_timestamp", "date"]

    def merge(batch: DataFrame, _: int) -> None:
        dated = batch.withColumn("date", F.to_date("sensor_timestamp")).persist()  # read once, counted once
        try:
            upsert_days(batch.sparkSession, dated, path, key, ["time", "value"])
        finally:
            dated.unpersist()

    writer = long.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def start_line_flush(long: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
    """Writes each micro-batch as line-protocol text in order; an empty batch writes nothing."""
    from tickforge.sources.sinks import reading_lines

    def flush(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            reading_lines(batch.orderBy("time")).write.mode("append").text(path)

    writer = long.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
