"""Context and prediction for the current state of each machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickforge.functions.timeexpr import days_between
from tickforge.operators.asof import asof_all, episode_side, open_id
from tickforge.operators.features import censoring_type, deviations
from tickforge.operators.reference import add_age, decode, decode_plc
from tickforge.plans.survival import median_life
from tickforge.plans.training import Bundle, add_risk
from tickforge.schemas import HEALTHY
from tickforge.sources.readers import look_back

NO_MODEL = (-1.0, 0.0)
NOMINAL_CONTEXT = [
    "statut_nominal",
    "vitesse_rotation_nominal",
    "courant_moteur_nominal",
    "pression_hydraulique_nominal",
    "temp_base_moteur",
    "id_type_metal",
    "id_regime_cadence",
]


def latest_nominal(nominal: DataFrame, as_of, days: float = 7) -> DataFrame:
    """Last known value of each nominal column per machine within the look-back."""
    window = look_back(nominal, "timestamp", as_of, days)
    fields = [c for c in NOMINAL_CONTEXT if c in nominal.columns]
    return window.groupBy("machine_id").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("timestamp"))).alias(c) for c in fields]
    )


def machine_context(
    state: DataFrame,
    lookups: dict[str, DataFrame],
    nominal: DataFrame,
    alerts: DataFrame,
    maintenance: DataFrame,
) -> DataFrame:
    """State rows with age, nominal values, decoded status, days since stop and label.

    ``state``: machine_id, timestamp, last_stop, one column per reading. Parts that are
    not known stay null. ``nominal``: one row per machine.
    """
    df = add_age(state, lookups["age_machine"])
    # The live reading decides the metal; the nominal value is the fallback.
    df = decode_plc(df, lookups)
    if "id_type_metal" in nominal.columns:
        nominal = decode(nominal, lookups["type_metal"], "id_type_metal", "type_metal", "_nominal_metal")
    if "id_regime_cadence" in nominal.columns:
        nominal = decode(nominal, lookups["regime_cadence"], "id_regime_cadence", "regime_cadence")
    df = df.join(nominal, "machine_id", "left")
    if "_nominal_metal" in df.columns:
        live = F.col("type_metal") if "type_metal" in df.columns else F.lit(None)
        df = df.withColumn("type_metal", F.coalesce(live, F.col("_nominal_metal"))).drop("_nominal_metal")
    since = F.coalesce(days_between(F.col("timestamp"), F.col("last_stop")), F.col("age_jours"))
    df = df.withColumn("jours_depuis_dernier_arret", since)
    sides = [
        episode_side(alerts.withColumnRenamed("id_machine", "machine_id"), "machine_id", "debut_alerte", "fin_alerte", "id_alerte"),
        episode_side(maintenance, "machine_id", "debut_panne", "fin_panne", "id_panne"),
    ]
    df = asof_all(df, "machine_id", "timestamp", sides)
    df = df.withColumns({i: open_id("timestamp", i) for i in ("id_alerte", "id_panne")})
    df = df.drop(*[c for s in sides for c in s.payload])
    df = decode(df, lookups["type_alerte"], "id_alerte", "label_gmao", "_alert")
    df = decode(df, lookups["type_maintenance"], "id_panne", "label_gmao", "_maintenance")
    label = F.when(F.col("timestamp").isNotNull(), F.coalesce("_alert", "_maintenance", F.lit(HEALTHY)))
    return df.withColumn("label_gmao", label).drop("_alert", "_maintenance")


def derived_features(df: DataFrame) -> DataFrame:
    """Censoring type where the label is known, and deviations (null when a side is missing)."""
    columns = df.columns
    out = deviations(columns)
    if "label_gmao" in columns:
        out["type_censure"] = F.when(F.col("label_gmao").isNotNull(), censoring_type(F.col("label_gmao")))
    return df.withColumns(out) if out else df


def predict(df: DataFrame, bundle: Bundle | None) -> DataFrame:
    """Adds ``risque`` and ``rul_jours_estime``; fixed values while there is no model."""
    if bundle is None:
        return df.withColumns({"rul_jours_estime": F.lit(NO_MODEL[0]), "risque": F.lit(NO_MODEL[1])})
    names = df.columns
    scored = add_risk(derived_features(df).withColumn("_row", F.struct(*names)), bundle)
    scored = scored.withColumn("rul_jours_estime", median_life(bundle.model, F.col("risque")))
    return scored.select("_row.*", "rul_jours_estime", "risque")


def score_machines(context: DataFrame, bundle: Bundle | None) -> DataFrame:
    """Prediction rows: time, id_machine, rul_jours_estime, risque."""
    return predict(context, bundle).select(
        F.current_timestamp().alias("time"), F.col("machine_id").alias("id_machine"), "rul_jours_estime", "risque"
    )
