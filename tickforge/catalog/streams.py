"""Streams over the given events, run to the end of the available files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickforge.catalog import query
from tickforge.catalog.models import live_references
from tickforge.catalog.silver import events, r6, us
from tickforge.session import checkpoint_dir, use_utc
from tickforge.streaming.ingest import message_files, parse_messages, start_export
from tickforge.streaming.scoring import Refreshed, start_scoring
from tickforge.streaming.state import latest_values, machine_state, read_state, start_state


def place(spark: SparkSession, name: str) -> str:
    """A new folder for one run, beside the checkpoints."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def event_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The events file as a stream of single-measure JSON messages."""
    schema = events(spark, folder).schema
    stream = use_utc(spark).readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return stream.select(
        F.format_string(
            '{"timestamp":"%s","id_machine":"M%s","%s":%s}',
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            F.col("user_id").cast("string"),
            "event_type",
            F.col("value").cast("string"),
        ).alias("value")
    )


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, mode: str) -> DataFrame:
    """Runs the aggregated stream over what is there and returns its last result."""
    path = place(spark, name)

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/result")

    run = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(keep)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{path}/result")


@query(
    "stream_latest_state",
    """SELECT 'M' || user_id AS id_machine, event_type AS sensor, arg_max(value, ts) AS value, epoch_us(max(ts)) AS sensor_timestamp_us FROM events GROUP BY 1, 2""",
)
def stream_latest_state(spark, folder):
    """Newest value per (machine, sensor)."""
    long = parse_messages(event_messages(spark, folder))
    state = run_to_table(spark, latest_values(long), "state", "complete")
    return state.select("id_machine", "sensor", "value", us("sensor_timestamp"))


@query(
    "stream_machine_state",
    """SELECT 'M' || user_id AS machine_id, epoch_us(max(ts)) AS last_us, epoch_us(max(ts) FILTER (WHERE event_type = 'error' AND round_even(value, 0) IN (10, 11))) AS stop_us,
  arg_max(value, ts) FILTER (WHERE event_type = 'click') AS click, arg_max(value, ts) FILTER (WHERE event_type = 'view') AS view FROM events GROUP BY 1""",
)
def stream_machine_state(spark, folder):
    """Last event, last stop and newest readings per machine; errors stand for the status reading."""
    long = parse_messages(event_messages(spark, folder))
    long = long.withColumn("sensor", F.when(F.col("sensor") == "error", "id_status_production").otherwise(F.col("sensor")))
    stops = F.array(F.lit(10).cast("long"), F.lit(11).cast("long"))
    state = run_to_table(spark, machine_state(long, stops, ["click", "view"]), "machines", "complete")
    return state.select("machine_id", us("timestamp", "last_us"), us("last_stop", "stop_us"), "click", "view")


def messages_in_files(spark: SparkSession, folder: str, parts: int) -> DataFrame:
    """The events as message files that arrive one after another, every ``parts``-th event in one; most come late."""
    path = place(spark, "messages")
    lines = use_utc(spark).read.parquet(f"{folder}/events.parquet").select(
        (F.col("event_id") % parts).alias("part"),
        F.to_json(
            F.struct(
                F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
                F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("id_machine"),
                F.col("value").alias("reading"),
            )
        ).alias("value"),
    )
    for part in range(parts):
        lines.filter(F.col("part") == part).select("value").coalesce(1).write.mode("append").text(path)
    return message_files(spark, path, files_per_trigger=1)


@query(
    "stream_last_arrival",
    """WITH a AS (SELECT *, event_id % 3 AS arrival FROM events WHERE value IS NOT NULL)
SELECT 'M' || user_id AS id_machine, arg_max(value, (arrival, ts, value)) AS value, epoch_us(arg_max(ts, (arrival, ts, value))) AS sensor_timestamp_us FROM a GROUP BY 1""",
)
def stream_last_arrival(spark, folder):
    """Three batches of messages: the last to arrive wins, though most of its readings are older; only changes are written."""
    path = place(spark, "arrivals")
    long = parse_messages(messages_in_files(spark, folder, 3))
    start_state(latest_values(long, "time"), f"{path}/out", f"{path}/checkpoint", every=None).awaitTermination()
    state = read_state(spark, f"{path}/out", ["id_machine", "sensor"])
    return state.select("id_machine", "value", us("sensor_timestamp"))


@query(
    "stream_export",
    """SELECT 'M' || user_id AS id_machine, event_type AS sensor, max(value) AS value, epoch_us(ts) AS sensor_timestamp_us, CAST(ts AS DATE) AS date FROM events GROUP BY user_id, event_type, ts""",
)
def stream_export(spark, folder):
    """All messages, late ones too, exported once to date-partitioned Parquet."""
    path = place(spark, "export")
    long = parse_messages(event_messages(spark, folder))
    start_export(long, f"{path}/out", f"{path}/checkpoint", every=None).awaitTermination()
    out = spark.read.parquet(f"{path}/out")
    return out.select("id_machine", "sensor", "value", us("sensor_timestamp"), F.col("date").cast("date").alias("date"))


@query(
    "stream_score",
    "SELECT 'MCH-' || user_id AS id_machine, -1.0::DOUBLE AS rul_jours_estime, 0.0::DOUBLE AS risque FROM events GROUP BY user_id",
)
def stream_score(spark, folder):
    """Every machine seen on the stream is scored; without a model the fixed values are written."""
    _, refs = live_references(spark, folder)
    long = parse_messages(event_messages(spark, folder)).withColumn("id_machine", F.regexp_replace("id_machine", "^M", "MCH-"))
    path = place(spark, "score")
    start_scoring(long, Refreshed(lambda: refs), f"{path}/out", f"{path}/checkpoint", every=None).awaitTermination()
    return spark.read.parquet(f"{path}/out").select("id_machine", r6("rul_jours_estime"), r6("risque"))
