"""Cold storage, windows over stored data, upserts, exports and incremental discovery."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from tickforge.catalog import query
from tickforge.catalog.shapes import LONG_SQL
from tickforge.catalog.silver import SENSOR_VIEW, SILVER_SQL, events, r6, silver, table, us
from tickforge.functions.timeexpr import compact_utc
from tickforge.operators.features import is_stop
from tickforge.operators.reference import drop_rows_mentioning
from tickforge.operators.reshape import wide_to_long
from tickforge.plans.training import recent, time_split
from tickforge.session import checkpoint_dir
from tickforge.sources import readers
from tickforge.sources.commits import export_committed, read_committed
from tickforge.sources.sinks import by_tick_file, cold_rows, day_manifest, latest_by_key, pending_rows, retained, split_past_present, write_tick_files


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query(
    "cold_storage_days",
    f"""WITH {SILVER_SQL}, l AS ({LONG_SQL})
SELECT CAST(sensor_timestamp AS DATE) AS date, count(*) AS n_rows, epoch_us(min(sensor_timestamp)) AS first_us, epoch_us(max(sensor_timestamp)) AS last_us,
  'sensor_data_' || strftime(min(sensor_timestamp), '%Y%m%dT%H%M%SZ') || '_' || strftime(max(sensor_timestamp), '%Y%m%dT%H%M%SZ') AS window_name FROM l GROUP BY 1""",
)
def cold_storage_days(spark, folder):
    manifest = day_manifest(cold_rows(silver(spark, folder)))
    return manifest.select("date", "n_rows", us("first_at", "first_us"), us("last_at", "last_us"), "window_name")


@query(
    "past_and_present",
    f"""WITH {SILVER_SQL}, l AS ({LONG_SQL}) SELECT CASE WHEN sensor_timestamp < TIMESTAMP '2024-01-20' THEN 'past' ELSE 'present' END AS part, sensor, count(*) AS n,
  round(sum(value), 4) AS total FROM l GROUP BY 1, 2""",
)
def past_and_present(spark, folder):
    """Readings before and from the cutoff, counted per sensor."""
    before, after = split_past_present(silver(spark, folder), ts("2024-01-20 00:00:00"))
    both = wide_to_long(before, SENSOR_VIEW).withColumn("part", F.lit("past")).unionByName(
        wide_to_long(after, SENSOR_VIEW).withColumn("part", F.lit("present"))
    )
    return both.groupBy("part", "sensor").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(
    "retro_window",
    "SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY",
)
def retro_window(spark, folder):
    """Rows of the last week of the data, whatever the clock says."""
    return readers.within_days_of_newest(events(spark, folder), "ts", 7).select("event_id")


@query(
    "retro_window_files",
    """WITH f AS (SELECT user_id, max(ts) AS hi, 'sensor_data_' || strftime(min(ts), '%Y%m%dT%H%M%SZ') || '_' || strftime(max(ts), '%Y%m%dT%H%M%SZ') || '.parquet' AS file_name FROM events GROUP BY 1)
SELECT file_name FROM f WHERE date_trunc('second', hi) >= (SELECT max(date_trunc('second', hi)) FROM f) - INTERVAL 12 HOUR""",
)
def retro_window_files(spark, folder):
    """File names whose window ends at most half a day before the newest end."""
    spans = events(spark, folder).groupBy("user_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    names = spans.select(
        F.concat(F.concat_ws("_", F.lit("sensor_data"), compact_utc(F.col("lo")), compact_utc(F.col("hi"))), F.lit(".parquet")).alias("file_name")
    )
    return readers.files_in_window(names, 0.5)


@query(
    "bounded_scan",
    "SELECT event_id, round(value, 6) AS value FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-07 12:00:00'",
)
def bounded_scan(spark, folder):
    """Both bounds are inclusive and reach the file scan."""
    df = readers.time_bounded(events(spark, folder), "ts", ts("2024-01-05 00:00:00"), ts("2024-01-07 12:00:00"))
    return df.select("event_id", r6("value"))


@query(
    "look_back_latest",
    """WITH w AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-13' AND ts <= TIMESTAMP '2024-01-20')
SELECT user_id, arg_max(value, ts) FILTER (WHERE event_id % 3 <> 0) AS value, arg_max(event_type, ts) AS event_type FROM w GROUP BY 1""",
)
def look_back_latest(spark, folder):
    """Last known value of each column in the seven days before an instant; later rows are unseen."""
    rows = readers.look_back(events(spark, folder), "ts", ts("2024-01-20 00:00:00"), 7)
    value = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    return rows.groupBy("user_id").agg(
        F.max_by(value, F.when(value.isNotNull(), F.col("ts"))).alias("value"), F.max_by("event_type", "ts").alias("event_type")
    )


@query(
    "upsert_latest",
    """SELECT user_id, event_type, epoch_us(date_trunc('day', ts)) AS day_us, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY user_id, event_type, date_trunc('day', ts)""",
)
def upsert_latest(spark, folder):
    """Same tags and time overwrite: the row ingested last stays."""
    points = events(spark, folder).select("user_id", "event_type", F.date_trunc("day", "ts").alias("day"), "value", "event_id")
    kept = latest_by_key(points, ["user_id", "event_type", "day"], ["event_id"])
    return kept.select("user_id", "event_type", us("day"), "value", "event_id")


@query("retention_24h", "SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR")
def retention_24h(spark, folder):
    return retained(events(spark, folder), "ts").select("event_id")


@query(
    "drop_incomplete",
    f"WITH {SILVER_SQL} SELECT event_id FROM silver WHERE iot_vitesse_rotation IS NOT NULL AND iot_vibration_peak IS NOT NULL AND label_gmao IS NOT NULL",
)
def drop_incomplete(spark, folder):
    return silver(spark, folder).na.drop(subset=["iot_vitesse_rotation", "iot_vibration_peak", "label_gmao"]).select("event_id")


@query(
    "pending_export",
    """SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-10 12:00:00' - INTERVAL 30 SECOND""",
)
def pending_export(spark, folder):
    """Rows after the checkpoint and older than the safety margin."""
    rows = pending_rows(events(spark, folder), ts("2024-01-10 00:00:00"), ts("2024-01-10 12:00:00"), "ts")
    return rows.select("event_id")


@query(
    "unprocessed_runs",
    "SELECT DISTINCT conv_id FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'assistant' AND turn >= 3)",
)
def unprocessed_runs(spark, folder):
    """Runs without an output yet."""
    rows = table(spark, folder, "conversations").select("conv_id", "role", "turn")
    done = rows.filter("role = 'assistant' AND turn >= 3")
    return readers.unprocessed(rows.select("conv_id").distinct(), done, "conv_id")


@query(
    "last_five",
    "SELECT event_id, epoch_us(ts) AS ts_us FROM events ORDER BY ts DESC LIMIT 5",
)
def last_five(spark, folder):
    return readers.last_rows(events(spark, folder), "ts").select("event_id", us("ts"))


@query(
    "latest_named_file",
    """WITH f AS (SELECT event_id, 'duel_' || strftime(date_trunc('day', ts), '%Y%m%d') || '.jsonl' AS source_file FROM events)
SELECT event_id, source_file FROM f WHERE source_file = (SELECT max(source_file) FROM f)""",
)
def latest_named_file(spark, folder):
    """Rows of the file whose name sorts last."""
    named = events(spark, folder).select(
        "event_id", F.concat(F.lit("/bronze/duel_"), F.date_format("ts", "yyyyMMdd"), F.lit(".jsonl")).alias("path")
    )
    newest = readers.latest_file(named, "path")
    return newest.select("event_id", F.regexp_extract("path", r"([^/]+)$", 1).alias("source_file"))


@query(
    "stop_rows_removed",
    f"""WITH {SILVER_SQL} SELECT event_id FROM silver WHERE coalesce(iot_statut_machine NOT IN ('Maintenance', 'Panne'), true)
  AND coalesce(lower(label_gmao) NOT LIKE '%alerte%', true)""",
)
def stop_rows_removed(spark, folder):
    """Rows outside stops and without an alert in their label; unknown values stay."""
    rows = silver(spark, folder).select("event_id", "iot_statut_machine", "label_gmao")
    return drop_rows_mentioning(rows.filter(~is_stop(F.col("iot_statut_machine"))), "label_gmao", "ALERTE").select("event_id")


@query(
    "train_test_split",
    """WITH c AS (SELECT quantile_cont(epoch_us(ts)::DOUBLE, 0.8) AS cut FROM events)
SELECT event_id, CASE WHEN epoch_us(ts) >= cut THEN 'test' ELSE 'train' END AS part FROM events, c""",
)
def train_test_split(spark, folder):
    rows = events(spark, folder).select("event_id", "ts")
    train, test = time_split(rows, "ts")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).select("event_id", "part")


@query("recency_window", "SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 10 DAY")
def recency_window(spark, folder):
    return recent(events(spark, folder), "ts", 10).select("event_id")


@query(
    "ordered_rows",
    "SELECT event_id, user_id, epoch_us(ts) AS ts_us FROM events ORDER BY user_id, ts, event_id",
)
def ordered_rows(spark, folder):
    return events(spark, folder).orderBy("user_id", "ts", "event_id").select("event_id", "user_id", us("ts"))


def fresh_folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "committed_export",
    """SELECT CAST(ts AS DATE) AS date, count(*) AS n_rows, count(DISTINCT event_id) AS n_events, sum(event_id)::BIGINT AS ids, '2024-01-20 11:59:30.000000' AS checkpoint
FROM events WHERE ts <= TIMESTAMP '2024-01-20 11:59:30' GROUP BY 1""",
)
def committed_export(spark, folder):
    """Three exports, one of them after a job that died between data and commit: every row once."""
    staging = events(spark, folder).select("event_id", F.col("ts").alias("sensor_timestamp"), F.col("ts").alias("time"))
    root = fresh_folder(spark, "export")
    export_committed(spark, staging, root, "2024-01-09 00:00:00")
    staging.filter("time > timestamp_ntz'2024-01-08 23:59:30'").withColumn("date", F.to_date("time")).write.partitionBy("date").parquet(
        f"{root}/readings/batch=died"
    )
    export_committed(spark, staging, root, "2024-01-20 12:00:00")
    checkpoint = export_committed(spark, staging, root, "2024-01-15 00:00:00")
    rows = read_committed(spark, root, "readings", staging.withColumn("date", F.to_date("time")).schema)
    per_day = rows.groupBy("date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_events"), F.sum("event_id").alias("ids")
    )
    return per_day.withColumn("checkpoint", F.lit(checkpoint))


@query(
    "tick_files",
    """WITH t AS (SELECT event_id, ts, dense_rank() OVER (ORDER BY ts) AS tick FROM events)
SELECT (tick - 1) // 50 AS chunk, count(*) AS n_rows, count(DISTINCT ts) AS n_ticks, sum(event_id)::BIGINT AS ids, epoch_us(min(ts)) AS first_us, 1 AS n_files FROM t GROUP BY 1""",
)
def tick_files(spark, folder):
    """Fifty instants a file, over the whole table."""
    place = fresh_folder(spark, "ticks")
    files = write_tick_files(events(spark, folder).select("event_id", "ts"), place, 50, "ts")
    return by_tick_file(spark, place, files, _per_chunk, fresh_folder(spark, "per-chunk"))


def _per_chunk(stored: DataFrame) -> DataFrame:
    named = stored.withColumn("file", F.col("_metadata.file_path"))
    return named.groupBy(F.col("chunk").cast("long").alias("chunk")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("ts").alias("n_ticks"),
        F.sum("event_id").alias("ids"),
        F.unix_micros(F.min("ts").cast("timestamp")).alias("first_us"),
        F.count_distinct("file").cast("int").alias("n_files"),
    )


@query(
    "free_record_fields",
    """SELECT epoch_us(ts) AS us, user_id::VARCHAR AS id_machine, unnest(['iot_temperature', 'k', 'new_sensor']) AS field,
  unnest([event_id::VARCHAR, json_extract_string(props, '$.k'), event_type]) AS value FROM events""",
)
def free_record_fields(spark, folder):
    """Records with fields no schema knows, written as tick lines and read back field by field."""
    record = F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("user_id").cast("string").alias("id_machine"),
        F.col("event_id").alias("iot_temperature"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("event_type").alias("new_sensor"),
    )
    lines = events(spark, folder).groupBy("ts").agg(F.to_json(F.collect_list(record)).alias("value"))
    place = fresh_folder(spark, "lines")
    lines.select("value").write.text(place)
    fields = readers.read_tick_fields(spark, place)
    return fields.select(F.unix_micros(F.col("timestamp").cast("timestamp")).alias("us"), "id_machine", "field", "value")
