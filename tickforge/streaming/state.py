"""Current state per machine from a stream of long readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickforge.functions import half_even_long
from tickforge.schemas import PLC_READINGS, SENSORS
from tickforge.sources.sinks import latest_by_key

STATUS_READING = "id_status_production"


def latest_values(long: DataFrame, arrival: str | None = None) -> DataFrame:
    """Newest value per (machine, sensor); the larger value wins a tie.

    Event time decides, or with ``arrival`` (a column that grows from batch to batch, as ``time`` does) the last to
    arrive, late or not; within one batch the later event.
    """
    order = [c for c in (arrival, "sensor_timestamp", "value") if c]
    return long.groupBy("id_machine", "sensor").agg(
        F.max_by("value", F.struct(*order)).alias("value"),
        F.max_by("sensor_timestamp", F.struct(*order)).alias("sensor_timestamp"),
    )


def keyed_state(long: DataFrame) -> DataFrame:
    """(id_machine, sensor, code, value, sensor_timestamp): newest reading per machine and sensor.

    Readings of the production status are kept per status ``code``, so that which of them are stops may be decided
    later, by the references of each tick.
    """
    code = F.when(F.col("sensor") == STATUS_READING, half_even_long(F.col("value")))
    return long.groupBy("id_machine", "sensor", code.alias("code")).agg(
        F.max_by("value", F.struct("sensor_timestamp", "value")).alias("value"),
        F.max("sensor_timestamp").alias("sensor_timestamp"),
    )


def state_of(keyed: DataFrame, stop_ids: Column, readings: list[str] | None = None) -> DataFrame:
    """One row per machine: newest value of each reading, last event time, last stop time."""
    at = F.col("sensor_timestamp")
    newest = {}
    for name in readings or [*SENSORS, *PLC_READINGS]:
        mine = F.col("sensor") == name
        newest[name] = F.max_by("value", F.when(mine, F.struct(at, "value")))
    stopped = (F.col("sensor") == STATUS_READING) & F.array_contains(stop_ids, F.col("code"))
    return keyed.groupBy(F.col("id_machine").alias("machine_id")).agg(
        F.max(at).alias("timestamp"),
        F.max(F.when(stopped, at)).alias("last_stop"),
        *[c.alias(n) for n, c in newest.items()],
    )


def machine_state(long: DataFrame, stop_ids: Column, readings: list[str] | None = None) -> DataFrame:
    """State of every machine from its readings.

    Plain grouped aggregations, which run unchanged on a batch or a stream and keep only a few values of state per
    machine. ``stop_ids`` is an array of the status ids that mean a stop; every status reading counts.
    """
    marked = long.withColumn("code", half_even_long(F.col("value")))
    return state_of(marked, stop_ids, readings)


def start_state(state: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds") -> StreamingQuery:
    """Writes what changed: each tick adds the rows its readings touched, in a partition ``batch``.

    A tick that runs again replaces its partition. ``read_state`` gives the newest row of each key, ``compact_state``
    keeps the table small.
    """

    def tick(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("batch", F.lit(number).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    writer = state.writeStream.outputMode("update").foreachBatch(tick).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_state(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest row of every key."""
    return latest_by_key(spark.read.parquet(path), keys, ["batch"])


def compact_state(spark: SparkSession, path: str, target: str, keys: list[str]) -> None:
    """The newest rows under a new folder, for readers that begin there."""
    read_state(spark, path, keys).write.mode("errorifexists").partitionBy("batch").parquet(target)


def stop_status_ids(status: DataFrame, stops: list[str]) -> list[int]:
    """Ids of the stop statuses (a handful of rows)."""
    rows = status.filter(F.col("iot_statut_machine").isin(*stops)).select("id").collect()
    return sorted(int(r["id"]) for r in rows)
