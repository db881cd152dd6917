"""Column vocabularies and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, statuses and labels of the sensor data model.
SENSORS = [
    "iot_vitesse_rotation",
    "iot_courant_moteur",
    "iot_pression_hydraulique",
    "iot_temperature",
    "iot_vibration_rms",
    "iot_vibration_peak",
    "iot_charge_moteur",
]
PUBLISHED_SENSORS = [
    "iot_vitesse_rotation",
    "iot_courant_moteur",
    "iot_pression_hydraulique",
    "iot_temperature",
    "iot_vibration_peak",
    "iot_charge_moteur",
]
NOISY_SENSORS = [
    "iot_courant_moteur",
    "iot_pression_hydraulique",
    "iot_temperature",
    "iot_vibration_rms",
    "iot_vibration_peak",
]
PLC_READINGS = ["id_type_metal", "id_status_production"]
STOP_STATUSES = ["Maintenance", "Panne"]
IDLE_STATUSES = ["Arrêt Opérateur", "Arrêt Sous-Charge"]
HEALTHY = "Sain"
CATEGORICAL = [
    "machine_id",
    "type_machine",
    "secteur",
    "type_metal",
    "statut_nominal",
    "regime_cadence",
    "iot_statut_machine",
    "label_gmao",
    "type_censure",
    "observation_operateur",
]
ALWAYS_KEPT = ["machine_id", "age_jours"]
NOT_FEATURES = [
    "RUL_jours",
    "timestamp",
    "time",
    "type_censure_futur_audit",
    "event_observe",
    "age_virtuel_jours",
]
NOMINAL_COLUMNS = [
    "timestamp",
    "secteur",
    "machine_id",
    "vitesse_rotation_nominal",
    "courant_moteur_nominal",
    "pression_hydraulique_nominal",
    "statut_nominal",
    "temp_base_moteur",
    "id_type_metal",
    "id_regime_cadence",
    "facteur_cadence",
    "temps_cycle_sec",
]
NOMINAL_TAGS = ["machine_id", "statut_nominal"]
NOMINAL_FIELDS = [
    "vitesse_rotation_nominal",
    "courant_moteur_nominal",
    "pression_hydraulique_nominal",
    "temp_base_moteur",
    "id_type_metal",
    "id_regime_cadence",
    "facteur_cadence",
    "temps_cycle_sec",
]
# (short name, measured column, nominal column)
NOMINAL_PAIRS = [
    ("vitesse", "iot_vitesse_rotation", "vitesse_rotation_nominal"),
    ("courant", "iot_courant_moteur", "courant_moteur_nominal"),
    ("pression", "iot_pression_hydraulique", "pression_hydraulique_nominal"),
    ("temp", "iot_temperature", "temp_base_moteur"),
]
# Columns of the wide table that never leave with the IoT stream.
NOT_PUBLISHED = [
    "age_jours",
    "age_virtuel_jours",
    "label_gmao",
    "RUL_jours",
    "secteur",
    "type_machine",
    "vitesse_rotation_nominal",
    "courant_moteur_nominal",
    "pression_hydraulique_nominal",
    "statut_nominal",
    "type_metal",
    "temp_base_moteur",
    "iot_statut_machine",
    "iot_vibration_rms",
]
# id column -> (reference table, label column)
PLC_DECODING = {
    "id_type_metal": ("type_metal", "type_metal"),
    "id_status_production": ("production_status", "iot_statut_machine"),
}

SILVER = T.StructType(
    [T.StructField("timestamp", T.TimestampNTZType()), T.StructField("machine_id", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("type_machine", "secteur", "type_metal")]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("vitesse_rotation_nominal", "courant_moteur_nominal", "pression_hydraulique_nominal")
    ]
    + [
        T.StructField("statut_nominal", T.StringType()),
        T.StructField("temp_base_moteur", T.DoubleType()),
        T.StructField("regime_cadence", T.StringType()),
        T.StructField("facteur_cadence", T.DoubleType()),
        T.StructField("iot_statut_machine", T.StringType()),
        T.StructField("label_gmao", T.StringType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in SENSORS]
    + [
        T.StructField("age_jours", T.DoubleType()),
        T.StructField("age_virtuel_jours", T.DoubleType()),
        T.StructField("temps_cycle_sec", T.DoubleType()),
        T.StructField("nb_pieces_intervalle", T.LongType()),
        T.StructField("nb_pieces_cumule", T.LongType()),
        T.StructField("observation_operateur", T.StringType()),
        T.StructField("RUL_jours", T.DoubleType()),
    ]
)

LONG_READING = T.StructType(
    [
        T.StructField("id_machine", T.StringType()),
        T.StructField("sensor", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("sensor_timestamp", T.TimestampNTZType()),
        T.StructField("time", T.TimestampNTZType()),
    ]
)

WIDE_READING = T.StructType(
    [T.StructField("timestamp", T.TimestampNTZType()), T.StructField("id_machine", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in PUBLISHED_SENSORS + PLC_READINGS]
)

ALERT_EPISODE = T.StructType(
    [
        T.StructField("debut_alerte", T.TimestampNTZType()),
        T.StructField("fin_alerte", T.TimestampNTZType()),
        T.StructField("id_machine", T.StringType()),
        T.StructField("id_alerte", T.LongType()),
    ]
)

MAINTENANCE_EPISODE = T.StructType(
    [
        T.StructField("debut_panne", T.TimestampNTZType()),
        T.StructField("fin_panne", T.TimestampNTZType()),
        T.StructField("machine_id", T.StringType()),
        T.StructField("id_panne", T.LongType()),
    ]
)

GAME_LOG = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("agent1_id", T.StringType()),
        T.StructField("agent2_id", T.StringType()),
        T.StructField("turn", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
    ]
    + [
        field
        for side in (1, 2)
        for field in (
            T.StructField(f"agent{side}_choice", T.StringType()),
            T.StructField(f"agent{side}_gain", T.ShortType()),
            T.StructField(f"agent{side}_cumulative_score", T.IntegerType()),
            T.StructField(f"agent{side}_justification", T.StringType()),
        )
    ]
)

# One array element of a tick line: every field is optional.
TICK_RECORD = T.StructType(
    [T.StructField("timestamp", T.StringType()), T.StructField("id_machine", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in PUBLISHED_SENSORS + PLC_READINGS]
)
