"""Sensor-shaped views of the given ``events`` table, in Spark and in SQL.

user = machine, event type = status and label, value and props = readings.
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickforge.functions.timeexpr import epoch_us
from tickforge.session import use_utc

SENSOR_VIEW = [
    "iot_vitesse_rotation",
    "iot_courant_moteur",
    "iot_pression_hydraulique",
    "iot_temperature",
    "iot_vibration_peak",
    "iot_charge_moteur",
]


# Schemas and plans (no data) per session: the tables are read many times in one query,
# and each read without a schema costs a job.
_SCHEMAS: WeakKeyDictionary = WeakKeyDictionary()
_SILVER: WeakKeyDictionary = WeakKeyDictionary()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    known = _SCHEMAS.setdefault(spark, {})
    if path not in known:
        known[path] = use_utc(spark).read.parquet(path).schema
    return use_utc(spark).read.schema(known[path]).parquet(path)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def prop_k(props: str = "props") -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def us(column: str, name: str | None = None) -> Column:
    """Timestamp as epoch microseconds, the form both engines print alike."""
    return epoch_us(F.col(column)).alias(name or f"{column}_us")


def r6(column: Column | str, name: str | None = None) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    out = F.round(c.cast("double"), 6)
    return out.alias(name or column) if name or isinstance(column, str) else out


def mean6(column: str) -> Column:
    """Six digits of a mean. Means of two-digit readings often end exactly half-way; the
    small shift rounds those the same way in both engines."""
    return F.round(F.col(column) + F.lit(1e-9), 6).alias(column)


def silver(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (machine_id, timestamp) with readings, labels and nominal values."""
    plans = _SILVER.setdefault(use_utc(spark), {})
    if folder not in plans:
        plans[folder] = silver_of(events(spark, folder))
    return plans[folder]


def silver_of(rows: DataFrame) -> DataFrame:
    numbered = rows.withColumn("k", prop_k())
    return numbered.selectExpr(
        "event_id",
        "ts AS timestamp",
        "concat('MCH-', user_id) AS machine_id",
        "CASE user_id % 3 WHEN 0 THEN 'Presse' WHEN 1 THEN 'Fraiseuse' ELSE 'Tour' END AS type_machine",
        "if(k < 50, 'Atelier_A', 'Atelier_B') AS secteur",
        "CASE k % 3 WHEN 0 THEN 'Acier' WHEN 1 THEN 'Alu' ELSE 'Cuivre' END AS type_metal",
        "if(k % 7 = 0, 0D, (k % 5 + 1) * 10D) AS vitesse_rotation_nominal",
        "20D AS courant_moteur_nominal",
        "50D AS pression_hydraulique_nominal",
        "if(k % 10 = 0, 'Arrêt Opérateur', 'Production') AS statut_nominal",
        "40D + k % 3 AS temp_base_moteur",
        """CASE k % 4 WHEN 0 THEN 'Cadence_Nominale' WHEN 1 THEN 'Sur_Charge' WHEN 2 THEN 'Sous_Charge'
             ELSE 'Repos_Hebdo' END AS regime_cadence""",
        "CASE k % 4 WHEN 1 THEN 1.5D WHEN 2 THEN 0.5D ELSE 1D END AS facteur_cadence",
        """CASE WHEN event_type = 'error' THEN 'Panne' WHEN event_type = 'signup' THEN 'Maintenance'
             WHEN event_id % 37 = 0 THEN 'Arrêt Opérateur' WHEN event_id % 41 <> 0 THEN 'Production' END AS iot_statut_machine""",
        """CASE WHEN event_type = 'error' THEN if(k % 2 = 1, 'Alerte_P5', 'Alerte_P4')
             WHEN event_type = 'signup' THEN if(k % 2 = 1, 'Maintenance_Correctif_P8', 'Maintenance_Preventif_PLANIFIEE')
             WHEN event_id % 43 <> 0 THEN 'Sain' END AS label_gmao""",
        "if(event_id % 50 <> 0, value, null) AS iot_vitesse_rotation",
        "if(event_id % 31 <> 0, double(floor(value / 50)), null) AS iot_courant_moteur",
        "value * 2 + k AS iot_pression_hydraulique",
        "40D + k / 10D AS iot_temperature",
        "if(event_id % 29 >= 9, value / 5, null) AS iot_vibration_peak",
        "double(k) AS iot_charge_moteur",
        """user_id + (unix_micros(cast(ts AS timestamp)) - unix_micros(cast(timestamp_ntz'2024-01-01' AS timestamp))) / 86400e6D
             AS age_jours""",
        "10D + k % 5 AS temps_cycle_sec",
        "bigint(k % 4) AS nb_pieces_intervalle",
        "if(event_id % 19 = 0, 'bruit', null) AS observation_operateur",
    )


SILVER_SQL = """silver0 AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
silver AS (
  SELECT event_id, ts AS "timestamp", 'MCH-' || CAST(user_id AS VARCHAR) AS machine_id,
    CASE user_id % 3 WHEN 0 THEN 'Presse' WHEN 1 THEN 'Fraiseuse' ELSE 'Tour' END AS type_machine,
    CASE WHEN k < 50 THEN 'Atelier_A' ELSE 'Atelier_B' END AS secteur,
    CASE k % 3 WHEN 0 THEN 'Acier' WHEN 1 THEN 'Alu' ELSE 'Cuivre' END AS type_metal,
    CASE WHEN k % 7 = 0 THEN 0.0 ELSE (k % 5 + 1) * 10.0 END::DOUBLE AS vitesse_rotation_nominal,
    20.0::DOUBLE AS courant_moteur_nominal, 50.0::DOUBLE AS pression_hydraulique_nominal,
    CASE WHEN k % 10 = 0 THEN 'Arrêt Opérateur' ELSE 'Production' END AS statut_nominal,
    (40.0 + k % 3)::DOUBLE AS temp_base_moteur,
    CASE k % 4 WHEN 0 THEN 'Cadence_Nominale' WHEN 1 THEN 'Sur_Charge' WHEN 2 THEN 'Sous_Charge' ELSE 'Repos_Hebdo' END AS regime_cadence,
    CASE k % 4 WHEN 1 THEN 1.5 WHEN 2 THEN 0.5 ELSE 1.0 END::DOUBLE AS facteur_cadence,
    CASE WHEN event_type = 'error' THEN 'Panne' WHEN event_type = 'signup' THEN 'Maintenance'
         WHEN event_id % 37 = 0 THEN 'Arrêt Opérateur' WHEN event_id % 41 <> 0 THEN 'Production' END AS iot_statut_machine,
    CASE WHEN event_type = 'error' THEN CASE WHEN k % 2 = 1 THEN 'Alerte_P5' ELSE 'Alerte_P4' END
         WHEN event_type = 'signup' THEN CASE WHEN k % 2 = 1 THEN 'Maintenance_Correctif_P8' ELSE 'Maintenance_Preventif_PLANIFIEE' END
         WHEN event_id % 43 <> 0 THEN 'Sain' END AS label_gmao,
    CASE WHEN event_id % 50 <> 0 THEN value END AS iot_vitesse_rotation,
    CASE WHEN event_id % 31 <> 0 THEN floor(value / 50) END AS iot_courant_moteur,
    value * 2 + k AS iot_pression_hydraulique,
    40.0::DOUBLE + k / 10.0::DOUBLE AS iot_temperature,
    CASE WHEN event_id % 29 >= 9 THEN value / 5 END AS iot_vibration_peak,
    k::DOUBLE AS iot_charge_moteur,
    user_id + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 86400e6 AS age_jours,
    (10.0 + k % 5)::DOUBLE AS temps_cycle_sec,
    (k % 4)::BIGINT AS nb_pieces_intervalle,
    CASE WHEN event_id % 19 = 0 THEN 'bruit' END AS observation_operateur
  FROM silver0)"""

# Reference tables and episodes as SQL, on top of ``silver``.
REFERENCES_SQL = """type_alerte AS (
  SELECT label_gmao, dense_rank() OVER (ORDER BY label_gmao) AS id
  FROM (SELECT DISTINCT label_gmao FROM silver WHERE label_gmao LIKE 'Alerte%')),
type_maintenance AS (
  SELECT label_gmao, dense_rank() OVER (ORDER BY label_gmao) AS id
  FROM (SELECT DISTINCT label_gmao FROM silver WHERE label_gmao LIKE 'Maintenance%'))"""


def _episodes_sql(table_name: str, reference: str, prefix: str, start: str, end: str, id_name: str) -> str:
    return f"""{table_name}_rows AS (
  SELECT s.machine_id, s."timestamp", r.id FROM silver s JOIN {reference} r USING (label_gmao) WHERE s.label_gmao LIKE '{prefix}%'),
{table_name}_marks AS (
  SELECT *, CASE WHEN id = lag(id) OVER w THEN 0 ELSE 1 END AS st FROM {table_name}_rows
  WINDOW w AS (PARTITION BY machine_id ORDER BY "timestamp")),
{table_name}_runs AS (
  SELECT *, sum(st) OVER (PARTITION BY machine_id ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS run FROM {table_name}_marks),
{table_name} AS (
  SELECT min("timestamp") AS {start}, max("timestamp") AS {end}, any_value(id) AS {id_name}, machine_id AS id_machine
  FROM {table_name}_runs GROUP BY machine_id, run)"""


EPISODES_SQL = ",\n".join(
    [
        SILVER_SQL,
        REFERENCES_SQL,
        _episodes_sql("alerte", "type_alerte", "Alerte", "debut_alerte", "fin_alerte", "id_alerte"),
        _episodes_sql("maintenance", "type_maintenance", "Maintenance", "debut_panne", "fin_panne", "id_panne"),
    ]
)
