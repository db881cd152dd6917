"""Ordered-history queries: episodes, cleaning, features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickforge.catalog import query
from tickforge.catalog.silver import EPISODES_SQL, SENSOR_VIEW, SILVER_SQL, events, mean6, r6, silver, us
from tickforge.operators.cleaning import fill_gaps, flag_stuck, remove_spikes
from tickforge.operators.episodes import alert_and_maintenance_episodes, build_episodes, episodes_by_kind, sector_history, split_by_prefix
from tickforge.operators.features import (
    build_features,
    censoring_type,
    days_to_next_stop_row,
    deviations,
    future_censoring,
    is_stop,
    is_training_row,
    recent_report,
    running_pieces,
    since_last_stop,
    steps_since_reset,
    trends,
)
from tickforge.operators.reference import alert_and_maintenance_references, drop_rows_mentioning
from tickforge.operators.timeline import Timeline

W = 'WINDOW w AS (PARTITION BY machine_id ORDER BY "timestamp")'


def line(spark: SparkSession, folder: str, *columns: str) -> Timeline:
    """Machine histories holding only the columns a query reads."""
    df = silver(spark, folder)
    if columns:
        df = df.select("event_id", "machine_id", "timestamp", *columns)
    return Timeline(df, ["machine_id"], ["timestamp", "event_id"])


def alert_maintenance(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = silver(spark, folder).select("event_id", "timestamp", "machine_id", "label_gmao")
    alerts, maintenances = alert_and_maintenance_references(rows)
    return alert_and_maintenance_episodes(rows, alerts, maintenances)


@query(
    "episodes_by_type",
    """WITH e AS (SELECT user_id, ts, event_type, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS st
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM e)
SELECT epoch_us(min(ts)) AS debut_us, epoch_us(max(ts)) AS fin_us, any_value(event_type) AS event_type, user_id AS id_machine
FROM r GROUP BY user_id, run""",
)
def episodes_by_type(spark, folder):
    df = build_episodes(events(spark, folder), "event_type", "event_type", "debut", "fin", "user_id", "ts")
    return df.select(us("debut"), us("fin"), "event_type", "id_machine")


@query(
    "alert_maintenance_episodes",
    f"""WITH {EPISODES_SQL}
SELECT 'alerte' AS kind, epoch_us(debut_alerte) AS debut_us, epoch_us(fin_alerte) AS fin_us, id_alerte AS id, id_machine FROM alerte
UNION ALL SELECT 'maintenance', epoch_us(debut_panne), epoch_us(fin_panne), id_panne, id_machine FROM maintenance""",
)
def alert_maintenance_episodes(spark, folder):
    alert, maintenance = alert_maintenance(spark, folder)
    a = alert.select(F.lit("alerte").alias("kind"), us("debut_alerte", "debut_us"), us("fin_alerte", "fin_us"), F.col("id_alerte").alias("id"), "id_machine")
    m = maintenance.select(F.lit("maintenance").alias("kind"), us("debut_panne", "debut_us"), us("fin_panne", "fin_us"), F.col("id_panne").alias("id"), "id_machine")
    return a.unionByName(m)



@query(
    "episodes_one_pass",
    f"""WITH {EPISODES_SQL}
SELECT 'alerte' AS kind, id_machine, id_alerte AS id, epoch_us(debut_alerte) AS start_us, epoch_us(fin_alerte) AS end_us FROM alerte
UNION ALL SELECT 'maintenance', id_machine, id_panne, epoch_us(debut_panne), epoch_us(fin_panne) FROM maintenance""",
)
def episodes_one_pass(spark, folder):
    """Both kinds of episodes from one scan of the labelled rows."""
    rows = silver(spark, folder).select("event_id", "timestamp", "machine_id", "label_gmao")
    alerts, maintenances = alert_and_maintenance_references(rows)
    found = episodes_by_kind(rows, alerts, maintenances)
    return found.select("kind", "id_machine", "id", us("start"), us("end"))


@query(
    "sector_history",
    f"""WITH {SILVER_SQL}, m AS (
  SELECT *, CASE WHEN secteur = lag(secteur) OVER w THEN 0 ELSE 1 END AS st FROM silver {W})
SELECT machine_id AS id_machine, secteur, epoch_us("timestamp") AS date_mise_en_service_us FROM m WHERE st = 1""",
)
def sector_runs(spark, folder):
    return sector_history(silver(spark, folder)).select("id_machine", "secteur", us("date_mise_en_service"))


@query(
    "label_split_counts",
    f"""WITH {SILVER_SQL}
SELECT CASE WHEN label_gmao LIKE 'Alerte%' THEN 'matching' ELSE 'rest' END AS part, count(*) AS n,
  count(label_gmao) AS n_labels FROM silver WHERE label_gmao IS NULL OR lower(label_gmao) NOT LIKE '%sain%' GROUP BY 1""",
)
def label_split_counts(spark, folder):
    rows = drop_rows_mentioning(silver(spark, folder).select("label_gmao"), "label_gmao", "Sain")
    hit, rest = split_by_prefix(rows, "label_gmao", "Alerte")
    parts = hit.withColumn("part", F.lit("matching")).unionByName(rest.withColumn("part", F.lit("rest")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count("label_gmao").alias("n_labels"))


STUCK_CTE = f"""{SILVER_SQL},
stuck0 AS (SELECT *, row_number() OVER w AS pos, lag(iot_courant_moteur) OVER w AS prev FROM silver {W}),
stuck1 AS (SELECT *, sum(CASE WHEN pos > 1 AND abs(iot_courant_moteur - prev) <= 1e-8 + 1e-5 * abs(prev) THEN 0 ELSE 1 END)
  OVER (PARTITION BY machine_id ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS run FROM stuck0),
stuck AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY machine_id, run) >= 8 AND iot_courant_moteur IS NOT NULL
  THEN 1 ELSE 0 END AS iot_courant_moteur_bloque_suspect FROM stuck1)"""


@query(
    "stuck_runs",
    f"WITH {STUCK_CTE} SELECT event_id, iot_courant_moteur_bloque_suspect FROM stuck",
)
def stuck_runs(spark, folder):
    marked = flag_stuck(line(spark, folder, "iot_courant_moteur"), ["iot_courant_moteur"])
    return marked.df.select("event_id", "iot_courant_moteur_bloque_suspect")


def spike_cte(source: str, c: str, out: str) -> str:
    frame = 'PARTITION BY machine_id ORDER BY "timestamp" ROWS BETWEEN 120 PRECEDING AND 120 FOLLOWING'
    return f"""{out}0 AS (SELECT *, CASE WHEN count({c}) OVER f >= 15 THEN quantile_cont({c}, 0.5) OVER f END AS med
  FROM {source} WINDOW f AS ({frame})),
{out}1 AS (SELECT *, abs({c} - med) AS d FROM {out}0),
{out}2 AS (SELECT *, CASE WHEN count(d) OVER f >= 15 THEN quantile_cont(d, 0.5) OVER f END AS mad FROM {out}1 WINDOW f AS ({frame})),
{out} AS (SELECT * EXCLUDE ({c}, med, d, mad),
  CASE WHEN coalesce(d / (nullif(mad, 0) * 1.4826) > 8, false) THEN 1 ELSE 0 END AS {c}_spike_suspect,
  CASE WHEN coalesce(d / (nullif(mad, 0) * 1.4826) > 8, false) THEN NULL ELSE {c} END AS {c} FROM {out}2)"""


def fill_cte(source: str, c: str, out: str) -> str:
    back = 'OVER (PARTITION BY machine_id ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)'
    ahead = 'OVER (PARTITION BY machine_id ORDER BY "timestamp" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)'
    return f"""{out}0 AS (SELECT *, row_number() OVER w AS fpos FROM {source} {W}),
{out}1 AS (SELECT *, max(CASE WHEN {c} IS NOT NULL THEN fpos END) {back} AS p0, min(CASE WHEN {c} IS NOT NULL THEN fpos END) {ahead} AS p1,
  last_value({c} IGNORE NULLS) {back} AS v0, first_value({c} IGNORE NULLS) {ahead} AS v1 FROM {out}0),
{out} AS (SELECT * EXCLUDE ({c}, fpos, p0, p1, v0, v1), CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}_etait_manquant,
  CASE WHEN {c} IS NOT NULL THEN {c}
       WHEN coalesce(fpos - p0 <= 3, false) OR coalesce(p1 - fpos <= 3, false) THEN
         CASE WHEN p0 IS NULL THEN v1 WHEN p1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * ((fpos - p0)::DOUBLE / (p1 - p0)) END END AS {c}
  FROM {out}1)"""


@query(
    "spike_mad",
    f"""WITH {SILVER_SQL}, {spike_cte('silver', 'iot_vitesse_rotation', 'sp')}
SELECT event_id, iot_vitesse_rotation_spike_suspect, round(iot_vitesse_rotation, 6) AS iot_vitesse_rotation FROM sp""",
)
def spike_mad(spark, folder):
    c = "iot_vitesse_rotation"
    cleaned = remove_spikes(line(spark, folder, c), [c]).df
    return cleaned.select("event_id", f"{c}_spike_suspect", r6(c))


@query(
    "gap_interpolation",
    f"""WITH {SILVER_SQL}, {fill_cte('silver', 'iot_vibration_peak', 'g')}
SELECT event_id, iot_vibration_peak_etait_manquant, round(iot_vibration_peak, 6) AS iot_vibration_peak FROM g""",
)
def gap_interpolation(spark, folder):
    c = "iot_vibration_peak"
    filled = fill_gaps(line(spark, folder, c), [c]).df
    return filled.select("event_id", f"{c}_etait_manquant", r6(c))


def trend_columns(c: str) -> str:
    frame = 'OVER (PARTITION BY machine_id ORDER BY "timestamp" ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)'
    return f"""round(CASE WHEN count({c}) {frame} >= 10 THEN avg({c}) {frame} END + 1e-9, 6) AS {c}_moy_glissante,
  round(CASE WHEN count({c}) {frame} >= 10 THEN stddev_samp({c}) {frame} END + 1e-9, 6) AS {c}_std_glissante"""


@query(
    "rolling_stats",
    f"""WITH {SILVER_SQL} SELECT event_id, {trend_columns('iot_vitesse_rotation')}, {trend_columns('iot_pression_hydraulique')} FROM silver""",
)
def rolling_stats(spark, folder):
    names = ["iot_vitesse_rotation", "iot_pression_hydraulique"]
    df = trends(line(spark, folder, *names), names).df
    return df.select("event_id", *[mean6(f"{c}_{s}_glissante") for c in names for s in ("moy", "std")])


@query(
    "recent_reports",
    f"""WITH {SILVER_SQL} SELECT event_id, CASE WHEN observation_operateur IS NULL THEN 0 ELSE 1 END AS signalement_present,
  max(CASE WHEN observation_operateur IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY machine_id ORDER BY "timestamp"
    ROWS BETWEEN 2879 PRECEDING AND CURRENT ROW) AS signalement_recent_24h,
  max(CASE WHEN observation_operateur IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY machine_id ORDER BY "timestamp"
    ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS signalement_recent_10 FROM silver""",
)
def recent_reports(spark, folder):
    rows = recent_report(line(spark, folder, "observation_operateur"))
    rows = rows.with_columns({"day": F.col("signalement_recent_24h")})
    df = recent_report(rows, rows=10).df
    return df.select("event_id", "signalement_present", F.col("day").alias("signalement_recent_24h"), F.col("signalement_recent_24h").alias("signalement_recent_10"))


LAST_STOP = """OVER (PARTITION BY machine_id ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query(
    "since_last_stop",
    f"""WITH {SILVER_SQL}, p AS (SELECT *, sum(nb_pieces_intervalle) {LAST_STOP} AS nb_pieces_cumule FROM silver)
SELECT event_id, nb_pieces_cumule::BIGINT AS nb_pieces_cumule,
  round(coalesce((epoch_us("timestamp") - epoch_us(last_value(CASE WHEN iot_statut_machine IN ('Maintenance', 'Panne') THEN "timestamp" END IGNORE NULLS) {LAST_STOP})) / 86400e6, age_jours), 6) AS jours_depuis_dernier_arret,
  (nb_pieces_cumule - coalesce(last_value(CASE WHEN iot_statut_machine IN ('Maintenance', 'Panne') THEN nb_pieces_cumule END IGNORE NULLS) {LAST_STOP}, 0))::BIGINT AS pieces_depuis_dernier_arret
FROM p""",
)
def days_and_pieces_since_stop(spark, folder):
    history = running_pieces(line(spark, folder, "nb_pieces_intervalle", "iot_statut_machine", "age_jours"))
    df = since_last_stop(history).df
    return df.select("event_id", "nb_pieces_cumule", r6("jours_depuis_dernier_arret"), "pieces_depuis_dernier_arret")


CENSOR = """CASE WHEN label_gmao LIKE '%Preventif%' THEN 'Preventif'
  WHEN label_gmao LIKE 'Alerte%' OR label_gmao LIKE '%Correctif%' THEN 'Correctif' ELSE 'Sain' END"""


@query(
    "future_censor",
    f"""WITH {SILVER_SQL}, c AS (SELECT *, {CENSOR} AS type_censure FROM silver)
SELECT event_id, type_censure, first_value(CASE WHEN iot_statut_machine IN ('Maintenance', 'Panne') THEN type_censure END IGNORE NULLS)
  OVER (PARTITION BY machine_id ORDER BY "timestamp" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS type_censure_futur_audit FROM c""",
)
def future_censor(spark, folder):
    rows = line(spark, folder, "label_gmao", "iot_statut_machine").with_columns(
        {"type_censure": censoring_type(F.col("label_gmao"))}
    )
    return future_censoring(rows).df.select("event_id", "type_censure", "type_censure_futur_audit")


@query(
    "censor_type",
    f"WITH {SILVER_SQL} SELECT {CENSOR} AS type_censure, count(*) AS n FROM silver GROUP BY 1",
)
def censor_type(spark, folder):
    df = silver(spark, folder).select(censoring_type(F.col("label_gmao")).alias("type_censure"))
    return df.groupBy("type_censure").agg(F.count(F.lit(1)).alias("n"))


def deviation_sql() -> str:
    pairs = [
        ("vitesse", "iot_vitesse_rotation", "vitesse_rotation_nominal"),
        ("courant", "iot_courant_moteur", "courant_moteur_nominal"),
        ("pression", "iot_pression_hydraulique", "pression_hydraulique_nominal"),
        ("temp", "iot_temperature", "temp_base_moteur"),
    ]
    return ", ".join(
        f"round({m} - {n}, 6) AS ecart_{s}, round(({m} - {n}) / nullif({n}, 0), 6) AS ecart_relatif_{s}" for s, m, n in pairs
    )


@query("deviation_ratios", f"WITH {SILVER_SQL} SELECT event_id, {deviation_sql()} FROM silver")
def deviation_ratios(spark, folder):
    df = silver(spark, folder)
    return df.select("event_id", *[r6(c, n) for n, c in deviations(df.columns).items()])


@query(
    "rul_from_stop_rows",
    f"""WITH {SILVER_SQL}, p AS (SELECT *, row_number() OVER w AS pos FROM silver {W})
SELECT event_id, round((min(CASE WHEN iot_statut_machine IN ('Maintenance', 'Panne') THEN pos END)
  OVER (PARTITION BY machine_id ORDER BY "timestamp" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - pos) * 30.0 / 86400.0, 6)::DOUBLE AS "RUL_jours" FROM p""",
)
def rul_from_stop_rows(spark, folder):
    df = days_to_next_stop_row(line(spark, folder, "iot_statut_machine")).df
    return df.select("event_id", r6("RUL_jours"))


@query(
    "steps_since_preventive",
    f"""WITH {SILVER_SQL}, g AS (SELECT *, sum(CASE WHEN label_gmao = 'Maintenance_Preventif_PLANIFIEE' THEN 1 ELSE 0 END) {LAST_STOP} AS era FROM silver)
SELECT event_id, sum(CASE WHEN coalesce(label_gmao, '') <> 'Maintenance_Preventif_PLANIFIEE' AND iot_statut_machine IN ('Production', 'Panne') THEN 1 ELSE 0 END)
  OVER (PARTITION BY machine_id, era ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING)::BIGINT AS steps FROM g""",
)
def steps_since_preventive(spark, folder):
    rows = line(spark, folder, "label_gmao", "iot_statut_machine")
    working = F.col("iot_statut_machine").isin("Production", "Panne")
    planned = F.col("label_gmao") == "Maintenance_Preventif_PLANIFIEE"
    return steps_since_reset(rows, working, planned, F.lit(1).cast("long"), "steps").df.select("event_id", "steps")


@query(
    "training_rows",
    f"""WITH {SILVER_SQL}, p AS (SELECT *, row_number() OVER w AS pos FROM silver {W}),
t AS (SELECT *, (min(CASE WHEN iot_statut_machine IN ('Maintenance', 'Panne') THEN pos END)
  OVER (PARTITION BY machine_id ORDER BY "timestamp" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - pos) AS steps FROM p)
SELECT event_id, iot_statut_machine FROM t WHERE steps IS NOT NULL
  AND coalesce(iot_statut_machine NOT IN ('Arrêt Opérateur', 'Arrêt Sous-Charge', 'Maintenance', 'Panne'), true)""",
)
def training_rows(spark, folder):
    df = days_to_next_stop_row(line(spark, folder, "iot_statut_machine")).df
    return df.filter(is_training_row()).filter(~is_stop(F.col("iot_statut_machine"))).select("event_id", "iot_statut_machine")


def feature_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Silver rows with target, pieces and every feature."""
    history = running_pieces(days_to_next_stop_row(line(spark, folder)))
    return build_features(history.df, ties=["event_id"])


def features_sql() -> str:
    """The whole chain in the order stuck, spikes, gaps, then the derived columns."""
    sensors = SENSOR_VIEW
    stops = "iot_statut_machine IN ('Maintenance', 'Panne')"
    parts = [
        SILVER_SQL,
        f"target0 AS (SELECT *, row_number() OVER w AS tpos, sum(nb_pieces_intervalle) {LAST_STOP} AS nb_pieces_cumule, {CENSOR} AS type_censure FROM silver {W})",
        f"""target AS (SELECT *, (min(CASE WHEN {stops} THEN tpos END) OVER f - tpos) * 30.0 / 86400.0 AS "RUL_jours",
  first_value(CASE WHEN {stops} THEN type_censure END IGNORE NULLS) OVER f AS type_censure_futur_audit
  FROM target0 WINDOW f AS (PARTITION BY machine_id ORDER BY "timestamp" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
        """valid AS (SELECT * FROM target WHERE "RUL_jours" IS NOT NULL AND coalesce(iot_statut_machine NOT IN ('Arrêt Opérateur', 'Arrêt Sous-Charge'), true))""",
    ]
    source = "valid"
    for i, c in enumerate(["iot_courant_moteur", "iot_pression_hydraulique", "iot_temperature", "iot_vibration_peak"]):
        parts.append(
            f"""k{i}a AS (SELECT *, row_number() OVER w AS kpos, lag({c}) OVER w AS kprev FROM {source} {W}),
k{i}b AS (SELECT *, sum(CASE WHEN kpos > 1 AND abs({c} - kprev) <= 1e-8 + 1e-5 * abs(kprev) THEN 0 ELSE 1 END)
  OVER (PARTITION BY machine_id ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS krun FROM k{i}a),
k{i} AS (SELECT * EXCLUDE (kpos, kprev, krun), CASE WHEN count(*) OVER (PARTITION BY machine_id, krun) >= 8 AND {c} IS NOT NULL
  THEN 1 ELSE 0 END AS {c}_bloque_suspect FROM k{i}b)"""
        )
        source = f"k{i}"
    for i, c in enumerate(sensors):
        parts.append(spike_cte(source, c, f"s{i}"))
        source = f"s{i}"
    for i, c in enumerate(sensors):
        parts.append(fill_cte(source, c, f"f{i}"))
        source = f"f{i}"
    columns = ["event_id", "type_censure_futur_audit"]
    columns += [f"{c}_bloque_suspect" for c in sensors if c not in ("iot_vitesse_rotation", "iot_charge_moteur")]
    columns += [f"{c}_spike_suspect" for c in sensors] + [f"{c}_etait_manquant" for c in sensors]
    columns += [f"round({c}, 6) AS {c}" for c in sensors]
    columns += [trend_columns(c) for c in sensors]
    columns.append(deviation_sql())
    columns.append(
        f"""round(coalesce((epoch_us("timestamp") - epoch_us(last_value(CASE WHEN {stops} THEN "timestamp" END IGNORE NULLS) {LAST_STOP})) / 86400e6, age_jours), 6) AS jours_depuis_dernier_arret,
  (nb_pieces_cumule - coalesce(last_value(CASE WHEN {stops} THEN nb_pieces_cumule END IGNORE NULLS) {LAST_STOP}, 0))::BIGINT AS pieces_depuis_dernier_arret,
  max(CASE WHEN observation_operateur IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY machine_id ORDER BY "timestamp" ROWS BETWEEN 2879 PRECEDING AND CURRENT ROW) AS signalement_recent_24h"""
    )
    return "WITH " + ",\n".join(parts) + "\nSELECT " + ",\n  ".join(columns) + f" FROM {source}"


@query("feature_frame", features_sql())
def feature_frame(spark, folder):
    df = feature_rows(spark, folder)
    flags = [c for c in df.columns if c.endswith(("_suspect", "_etait_manquant"))]
    means = [c for c in df.columns if c.endswith("_glissante")]
    doubles = SENSOR_VIEW + [c for c in df.columns if c.startswith("ecart_")]
    return df.select(
        "event_id",
        "type_censure_futur_audit",
        *flags,
        *[r6(c) for c in doubles],
        *[mean6(c) for c in means],
        r6("jours_depuis_dernier_arret"),
        "pieces_depuis_dernier_arret",
        "signalement_recent_24h",
    )
