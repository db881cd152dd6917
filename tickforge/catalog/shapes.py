"""Wide, long and per-tick shapes; messages; line protocol."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickforge.catalog import query
from tickforge.catalog.history import alert_maintenance
from tickforge.catalog.joins import nominal_points
from tickforge.catalog.silver import EPISODES_SQL, SENSOR_VIEW, SILVER_SQL, events, r6, silver, table, us
from tickforge.functions.text import base_name, run_id, run_timestamp
from tickforge.functions.timeexpr import compact_utc
from tickforge.operators.ordering import exact_quantiles
from tickforge.operators.reshape import (
    SERIES_WIDTH,
    assemble_rows,
    long_to_wide,
    messages_to_long,
    one_hot,
    series_per_machine,
    series_rows,
    tick_lines,
    wide_to_long,
)
from tickforge.session import checkpoint_dir
from tickforge.sources.readers import read_master_data
from tickforge.sources.sinks import alert_lines, maintenance_lines, nominal_lines, reading_lines

LONG_SQL = " UNION ALL ".join(
    f"""SELECT machine_id AS id_machine, '{c}' AS sensor, {c} AS value, "timestamp" AS sensor_timestamp FROM silver WHERE {c} IS NOT NULL"""
    for c in SENSOR_VIEW
)


@query(
    "long_from_wide",
    f"""WITH {SILVER_SQL}, l AS ({LONG_SQL}) SELECT id_machine, sensor, round(value, 6) AS value, epoch_us(sensor_timestamp) AS sensor_timestamp_us FROM l""",
)
def long_from_wide(spark, folder):
    long = wide_to_long(silver(spark, folder), SENSOR_VIEW)
    return long.select("id_machine", "sensor", r6("value"), us("sensor_timestamp"))


@query(
    "wide_from_long",
    f"""WITH {SILVER_SQL} SELECT machine_id, epoch_us("timestamp") AS timestamp_us, {', '.join(f'round({c}, 6) AS {c}' for c in SENSOR_VIEW)}
FROM silver""",
)
def wide_from_long(spark, folder):
    long = wide_to_long(silver(spark, folder), SENSOR_VIEW).withColumnRenamed("sensor_timestamp", "timestamp")
    wide = long_to_wide(long, SENSOR_VIEW)
    return wide.select("machine_id", us("timestamp"), *[r6(c) for c in SENSOR_VIEW])


KINDS = ["click", "error", "purchase", "signup", "view"]


@query(
    "assembled_rows",
    "SELECT user_id AS id_machine, epoch_us(date_trunc('day', ts)) AS timestamp_us, "
    + ", ".join(f"round(arg_max(value, event_id) FILTER (WHERE event_type = '{c}'), 6) AS {c}" for c in KINDS)
    + " FROM events GROUP BY user_id, date_trunc('day', ts)",
)
def assembled_rows(spark, folder):
    """Records in arrival order to one row per machine and day; the last value of a field wins."""
    rows = events(spark, folder).select(
        F.col("user_id").alias("id_machine"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("timestamp"),
        "event_id",
        *[F.when(F.col("event_type") == c, F.col("value")).alias(c) for c in KINDS],
    )
    wide = assemble_rows(rows, "event_id", KINDS)
    return wide.select("id_machine", us("timestamp"), *[r6(c) for c in KINDS])


TICK_FIELDS = ["iot_vitesse_rotation", "iot_courant_moteur"]


def _records_sql(source: int, fields: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT tick, {source} AS source, {i} AS place, machine_id, '{{"timestamp":"' || strftime(tick, '%Y-%m-%d %H:%M:%S') || '","id_machine":"' || machine_id || '","{c}":' || CAST({c} AS VARCHAR) || '}}' AS record
  FROM t WHERE {c} IS NOT NULL"""
        for i, c in enumerate(fields)
    )


@query(
    "records_per_tick",
    f"""WITH {SILVER_SQL}, t AS (SELECT *, date_trunc('hour', "timestamp") AS tick FROM silver),
r AS ({_records_sql(0, TICK_FIELDS)} UNION ALL {_records_sql(1, ['nb_pieces_intervalle'])})
SELECT epoch_us(tick) AS timestamp_us, count(*) AS n_records, '[' || string_agg(record, ', ' ORDER BY source, place, machine_id, record) || ']' AS line FROM r GROUP BY tick""",
)
def records_per_tick(spark, folder):
    """One line per hour: IoT records of all machines, then PLC records."""
    rows = silver(spark, folder).withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    lines = tick_lines(rows, rows, TICK_FIELDS, ["nb_pieces_intervalle"])
    return lines.select(us("timestamp"), "n_records", "line")


@query(
    "messages_to_long",
    """WITH m AS (SELECT event_id, 'M' || user_id AS machine, event_type, value, ts FROM events)
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'unknown' ELSE machine END AS id_machine,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS sensor,
  CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL ELSE value END AS value,
  epoch_us(date_trunc('second', ts)) AS sensor_timestamp_us FROM m WHERE event_id % 7 <> 0
UNION ALL SELECT event_id, 'unknown', NULL, NULL, NULL FROM m WHERE event_id % 7 = 0""",
)
def parsed_messages(spark, folder):
    """JSON messages, some broken, without sensor, machine or number, to long rows."""
    e = F.col("event_id")
    text = F.concat(
        F.lit('{"timestamp":"'),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.lit('"'),
        F.when(e % 11 == 0, "").otherwise(F.concat(F.lit(',"id_machine":"M'), F.col("user_id").cast("string"), F.lit('"'))),
        F.when(e % 13 == 0, "").otherwise(
            F.concat(F.lit(',"'), F.col("event_type"), F.lit('":'), F.when(e % 17 == 0, '"high"').otherwise(F.col("value").cast("string")))
        ),
        F.lit("}"),
    )
    messages = events(spark, folder).select("event_id", F.when(e % 7 == 0, "not json").otherwise(text).alias("value"))
    long = messages_to_long(messages)
    return long.select("event_id", "id_machine", "sensor", F.col("value_number").alias("value"), us("sensor_timestamp"))


def _line_sql(measurement: str, tags: list[str], fields: str, at: str, source: str) -> str:
    def esc(c):
        return f"replace(replace(replace(CAST({c} AS VARCHAR), ',', '\\,'), '=', '\\='), ' ', '\\ ')"

    tag_text = " || ".join(f"',{t}=' || {esc(t)}" for t in tags)
    return f"SELECT '{measurement}' || {tag_text} || ' ' || {fields} || ' ' || CAST(epoch_us({at}) * 1000 AS VARCHAR) AS line FROM {source}"


@query(
    "line_protocol",
    f"WITH {EPISODES_SQL} "
    + _line_sql("alerte", ["id_machine", "id_alerte"], "'fin_alerte=' || CAST(epoch_us(fin_alerte) * 1000 AS VARCHAR) || 'i'", "debut_alerte", "alerte")
    + " UNION ALL "
    + _line_sql("maintenance", ["id_machine", "id_panne"], "'fin_panne=' || CAST(epoch_us(fin_panne) * 1000 AS VARCHAR) || 'i'", "debut_panne", "maintenance")
    + " UNION ALL "
    + _line_sql(
        "sensor_data",
        ["id_machine", "sensor"],
        """'sensor_timestamp="' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '",value=' || CAST(value AS VARCHAR)""",
        "ts",
        "(SELECT 'A,b=' || user_id || ' x' AS id_machine, event_type AS sensor, ts, value FROM events)",
    ),
)
def episode_lines(spark, folder):
    alert, maintenance = alert_maintenance(spark, folder)
    readings = events(spark, folder).select(
        F.concat(F.lit("A,b="), F.col("user_id").cast("string"), F.lit(" x")).alias("id_machine"),
        F.col("event_type").alias("sensor"),
        "value",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("sensor_timestamp"),
        F.col("ts").alias("time"),
    )
    return alert_lines(alert).unionByName(maintenance_lines(maintenance)).unionByName(reading_lines(readings))


@query(
    "nominal_lines",
    f"WITH {SILVER_SQL}, "
    "regimes AS (SELECT regime_cadence, dense_rank() OVER (ORDER BY regime_cadence) AS id_regime_cadence FROM (SELECT DISTINCT regime_cadence FROM silver)), "
    "metals AS (SELECT type_metal, dense_rank() OVER (ORDER BY type_metal) AS id_type_metal FROM (SELECT DISTINCT type_metal FROM silver)), "
    "n AS (SELECT * FROM silver JOIN regimes USING (regime_cadence) JOIN metals USING (type_metal) "
    "WHERE event_id IN (SELECT event_id FROM events WHERE event_type = 'purchase') AND iot_vitesse_rotation IS NOT NULL) "
    + _line_sql(
        "nominale_values",
        ["machine_id", "statut_nominal"],
        """'vitesse_rotation_nominal=' || CAST(iot_vitesse_rotation AS VARCHAR) || ',courant_moteur_nominal=20.0,pression_hydraulique_nominal=50.0,temp_base_moteur=' || CAST(temp_base_moteur AS VARCHAR)
 || ',id_type_metal=' || id_type_metal || ',id_regime_cadence=' || id_regime_cadence || ',facteur_cadence=' || CAST(facteur_cadence AS VARCHAR) || ',temps_cycle_sec=' || CAST(temps_cycle_sec AS VARCHAR)""",
        '"timestamp"',
        "n",
    ),
)
def nominal_line_texts(spark, folder):
    """Nominal values as text; rows with a missing field are left out."""
    points, _ = nominal_points(spark, folder)
    rest = silver(spark, folder).select(
        "machine_id", "timestamp", "statut_nominal", "courant_moteur_nominal", "pression_hydraulique_nominal",
        "facteur_cadence", "temps_cycle_sec", "iot_vitesse_rotation",
    )
    rows = points.drop("vitesse_rotation_nominal").join(rest, ["machine_id", "timestamp"])
    return nominal_lines(rows.withColumnRenamed("iot_vitesse_rotation", "vitesse_rotation_nominal"))


@query(
    "run_name_fields",
    """WITH n AS (SELECT event_id, 'duel_' || user_id || '_' || strftime(ts, '%Y%m%d_%H%M%S') AS run_name FROM events)
SELECT event_id, run_name, sha256(run_name) AS run_id, epoch_us(strptime(regexp_extract(run_name, '([0-9]{8}_[0-9]{6})$', 1), '%Y%m%d_%H%M%S')) AS run_us FROM n""",
)
def run_name_fields(spark, folder):
    path = F.concat(F.lit("/data/bronze/duel_"), F.col("user_id").cast("string"), F.date_format("ts", "'_'yyyyMMdd'_'HHmmss'.jsonl'"))
    named = events(spark, folder).select("event_id", base_name(path).alias("run_name"))
    return named.withColumns({"run_id": run_id(F.col("run_name")), "run": run_timestamp(F.col("run_name"))}).select(
        "event_id", "run_name", "run_id", us("run")
    )


@query(
    "compact_window_names",
    """SELECT user_id, 'sensor_data_' || strftime(min(ts), '%Y%m%dT%H%M%SZ') || '_' || strftime(max(ts), '%Y%m%dT%H%M%SZ') AS window_name FROM events GROUP BY 1""",
)
def compact_window_names(spark, folder):
    name = F.concat_ws("_", F.lit("sensor_data"), compact_utc(F.min("ts")), compact_utc(F.max("ts")))
    return events(spark, folder).groupBy("user_id").agg(name.alias("window_name"))


@query(
    "one_hot_aligned",
    """SELECT event_id, (event_type = 'error')::INTEGER AS event_type_error, (event_type = 'purchase')::INTEGER AS event_type_purchase, 0 AS event_type_never FROM events""",
)
def one_hot_aligned(spark, folder):
    """Columns fixed by the training labels: unseen labels give zeros, absent ones a zero column."""
    rows = events(spark, folder).select("event_id", "event_type")
    return one_hot(rows, {"event_type": ["click", "error", "purchase", "never"]})


@query(
    "median_impute",
    f"""WITH {SILVER_SQL}, m AS (SELECT quantile_cont(iot_vitesse_rotation, 0.5) AS a, quantile_cont(iot_vibration_peak, 0.5) AS b FROM silver)
SELECT event_id, round(coalesce(iot_vitesse_rotation, a), 6) AS iot_vitesse_rotation, round(coalesce(iot_vibration_peak, b), 6) AS iot_vibration_peak FROM silver, m""",
)
def median_impute(spark, folder):
    rows = silver(spark, folder)
    names = ["iot_vitesse_rotation", "iot_vibration_peak"]
    middle = exact_quantiles(rows, {c: F.col(c) for c in names}, 0.5)
    fill = {c: F.coalesce(F.col(c), middle.select(c).scalar()) for c in names}
    return rows.select("event_id", *[r6(v, c) for c, v in fill.items()])


@query(
    "profile_values",
    """SELECT event_type, count(*) AS n, round(min(value), 6) AS low, round(max(value), 6) AS high, round(avg(value), 6) AS mean,
  round(stddev_samp(value), 6) AS spread, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75
FROM events GROUP BY 1""",
)
def profile_values(spark, folder):
    """Count, extremes, mean, deviation and quartiles per event type."""
    v = F.col("value")
    shares = (0.25, 0.5, 0.75)
    rows = events(spark, folder)
    base = rows.groupBy("event_type").agg(
        F.count(v).alias("n"), r6(F.min(v), "low"), r6(F.max(v), "high"), r6(F.avg(v), "mean"), r6(F.stddev_samp(v), "spread")
    )
    per_kind = {c: F.when(F.col("event_type") == c, v) for c in KINDS}
    for name, q in zip(("q25", "q50", "q75"), shares):
        flat = exact_quantiles(rows, per_kind, q).unpivot([], KINDS, "event_type", "_q")
        base = base.join(flat.select("event_type", r6("_q", name)), "event_type")
    return base


@query(
    "value_counts",
    "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC",
)
def value_counts(spark, folder):
    return events(spark, folder).groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


@query(
    "series_per_machine",
    "SELECT epoch_us(date_trunc('day', ts)) AS day_us, 'm' || user_id AS id_machine, max(value) AS value FROM events GROUP BY ALL HAVING max(value) IS NOT NULL",
)
def machine_series(spark, folder):
    """Largest value per day with a column for every machine found, in blocks of columns, read back as rows."""
    daily = events(spark, folder).groupBy(F.date_trunc("day", "ts").alias("time"), F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("id_machine")).agg(
        F.max("value").alias("value")
    )
    wide = series_per_machine(daily, "value", width=SERIES_WIDTH)
    return series_rows(wide, "value").select(us("time", "day_us"), "id_machine", "value")


@query(
    "master_data_fields",
    "SELECT c_custkey, c_name FROM customer",
)
def master_data_fields(spark, folder):
    """Two fields of a master-data dump with one object a line; only those fields are parsed."""
    place = f"{checkpoint_dir(spark)}/master-data-{uuid.uuid4().hex}"
    table(spark, folder, "customer").select(F.to_json(F.struct("*")).alias("value")).write.text(place)
    fields = read_master_data(spark, place, ["c_custkey", "c_name"])
    return fields.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name")
