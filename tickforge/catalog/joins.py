"""As-of joins, encoding, machine dimensions and the assembled training frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickforge.catalog import query
from tickforge.catalog.history import alert_maintenance
from tickforge.catalog.silver import EPISODES_SQL, REFERENCES_SQL, SILVER_SQL, events, r6, silver, table, us
from tickforge.functions.timeexpr import week_index
from tickforge.operators.asof import asof_join
from tickforge.operators.episodes import sector_history
from tickforge.operators.ordering import rank_all
from tickforge.operators.quality import constraint_report
from tickforge.operators.reference import (
    add_age,
    alert_and_maintenance_references,
    decode,
    encode,
    extend_keys,
    machine_ages,
    machine_types,
    number_labels,
)
from tickforge.operators.reshape import wide_to_long
from tickforge.plans.assembly import (
    add_machine_context,
    add_maintenance_label,
    add_nominal_values,
    add_remaining_life,
    correlate_alerts,
    nominal_for_training,
    training_frame,
)
from tickforge.plans.dashboards import typed_machines
from tickforge.plans.gold import LABEL_TABLES
from tickforge.schemas import PUBLISHED_SENSORS

ALERT_ASOF = """al AS (SELECT s.event_id, s.machine_id, s."timestamp",
  CASE WHEN s."timestamp" < a.fin_alerte THEN a.id_alerte END AS id_alerte
  FROM silver s ASOF LEFT JOIN alerte a ON s.machine_id = a.id_machine AND s."timestamp" >= a.debut_alerte)"""


@query("asof_active_episode", f"WITH {EPISODES_SQL}, {ALERT_ASOF} SELECT event_id, id_alerte FROM al")
def asof_active_episode(spark, folder):
    readings = silver(spark, folder).select("event_id", F.col("machine_id").alias("id_machine"), "timestamp")
    alert, _ = alert_maintenance(spark, folder)
    return correlate_alerts(readings, alert).select("event_id", "id_alerte")


@query(
    "episode_match_counts",
    f"""WITH {EPISODES_SQL}, {ALERT_ASOF} SELECT machine_id AS id_machine, count(*) AS n_rows, count(id_alerte) AS n_matched
FROM al GROUP BY 1""",
)
def episode_match_counts(spark, folder):
    readings = silver(spark, folder).select(F.col("machine_id").alias("id_machine"), "timestamp")
    alert, _ = alert_maintenance(spark, folder)
    joined = correlate_alerts(readings, alert)
    return joined.groupBy("id_machine").agg(F.count(F.lit(1)).alias("n_rows"), F.count("id_alerte").alias("n_matched"))


NOMINAL_SQL = """regimes AS (SELECT regime_cadence, dense_rank() OVER (ORDER BY regime_cadence) AS id FROM (SELECT DISTINCT regime_cadence FROM silver)),
metals AS (SELECT type_metal, dense_rank() OVER (ORDER BY type_metal) AS id FROM (SELECT DISTINCT type_metal FROM silver)),
nominal AS (SELECT s.*, r.id AS id_regime_cadence, m.id AS id_type_metal FROM silver s JOIN regimes r USING (regime_cadence) JOIN metals m USING (type_metal)
  WHERE event_id IN (SELECT event_id FROM events WHERE event_type = 'purchase'))"""


def nominal_points(spark, folder) -> tuple[DataFrame, DataFrame]:
    """(nominal values taken at purchase events, with metal and regime ids; regime table)."""
    raw = events(spark, folder).filter("event_type = 'purchase'").select("event_id")
    rows = silver(spark, folder)
    regimes = number_labels(rows, "regime_cadence")
    metals = number_labels(rows, "type_metal")
    points = encode(encode(rows.join(raw, "event_id", "left_semi"), regimes, "regime_cadence", "id_regime_cadence"), metals, "type_metal", "id_type_metal")
    names = ["machine_id", "timestamp", "vitesse_rotation_nominal", "temp_base_moteur", "id_regime_cadence", "id_type_metal"]
    return points.select(*names), regimes


@query(
    "asof_nominal_enrich",
    f"""WITH {SILVER_SQL}, {NOMINAL_SQL}
SELECT s.event_id, n.vitesse_rotation_nominal, n.temp_base_moteur, n.regime_cadence FROM silver s
ASOF LEFT JOIN nominal n ON s.machine_id = n.machine_id AND s."timestamp" >= n."timestamp\"""",
)
def asof_nominal_enrich(spark, folder):
    nominal, regimes = nominal_points(spark, folder)
    wide = silver(spark, folder).select("event_id", "machine_id", "timestamp")
    return add_nominal_values(wide, nominal, {"regime_cadence": regimes}).select(
        "event_id", "vitesse_rotation_nominal", "temp_base_moteur", "regime_cadence"
    )


@query(
    "asof_forward_next_start",
    f"""WITH {EPISODES_SQL} SELECT s.event_id, epoch_us(m.debut_panne) AS next_us FROM silver s
ASOF LEFT JOIN maintenance m ON s.machine_id = m.id_machine AND s."timestamp" <= m.debut_panne""",
)
def asof_forward_next_start(spark, folder):
    _, maintenance = alert_maintenance(spark, folder)
    starts = maintenance.select(F.col("id_machine").alias("machine_id"), F.col("debut_panne").alias("next"))
    wide = silver(spark, folder).select("event_id", "machine_id", "timestamp")
    return asof_join(wide, starts, "machine_id", "timestamp", "next", ["next"], "forward").select("event_id", us("next"))


LABELLED = f"""{ALERT_ASOF},
ml AS (SELECT a.event_id, a.machine_id, a."timestamp", a.id_alerte, CASE WHEN a."timestamp" < m.fin_panne THEN m.id_panne END AS id_panne
  FROM al a ASOF LEFT JOIN maintenance m ON a.machine_id = m.id_machine AND a."timestamp" >= m.debut_panne),
lab AS (SELECT ml.event_id, ml.machine_id, ml."timestamp", coalesce(ta.label_gmao, tm.label_gmao, 'Sain') AS label_gmao FROM ml
  LEFT JOIN type_alerte ta ON ml.id_alerte = ta.id LEFT JOIN type_maintenance tm ON ml.id_panne = tm.id)"""


def episode_lookups(spark, folder) -> dict[str, DataFrame]:
    alerts, maintenances = alert_and_maintenance_references(silver(spark, folder).select("label_gmao"))
    return {"type_alerte": alerts, "type_maintenance": maintenances}


@query("label_with_priority", f"WITH {EPISODES_SQL}, {LABELLED} SELECT event_id, label_gmao FROM lab")
def label_with_priority(spark, folder):
    readings = silver(spark, folder).select("event_id", F.col("machine_id").alias("id_machine"), "timestamp")
    alert, maintenance = alert_maintenance(spark, folder)
    wide = correlate_alerts(readings, alert).withColumnRenamed("id_machine", "machine_id")
    maintenance = maintenance.withColumnRenamed("id_machine", "machine_id")
    return add_maintenance_label(wide, maintenance, episode_lookups(spark, folder)).select("event_id", "label_gmao")


@query(
    "rul_from_episodes",
    f"""WITH {EPISODES_SQL}, n AS (SELECT s.event_id, s."timestamp", m.debut_panne, max(s."timestamp") OVER (PARTITION BY s.machine_id) AS last_at
  FROM silver s ASOF LEFT JOIN maintenance m ON s.machine_id = m.id_machine AND s."timestamp" <= m.debut_panne)
SELECT event_id, round((epoch_us(coalesce(debut_panne, last_at)) - epoch_us("timestamp")) / 86400e6, 6) AS "RUL_jours" FROM n""",
)
def rul_from_episodes(spark, folder):
    _, maintenance = alert_maintenance(spark, folder)
    wide = silver(spark, folder).select("event_id", "machine_id", "timestamp")
    joined = add_remaining_life(wide, maintenance.withColumnRenamed("id_machine", "machine_id"))
    return joined.select("event_id", r6("RUL_jours"))


@query(
    "active_at_latest_row",
    f"""WITH {EPISODES_SQL}, {LABELLED} SELECT machine_id, epoch_us(max("timestamp")) AS last_us, arg_max(label_gmao, "timestamp") AS label_gmao FROM lab GROUP BY 1""",
)
def active_at_latest_row(spark, folder):
    """Label of every machine at its newest row: the point-in-time form of the label."""
    newest = silver(spark, folder).groupBy(F.col("machine_id").alias("id_machine")).agg(F.max("timestamp").alias("timestamp"))
    alert, maintenance = alert_maintenance(spark, folder)
    wide = correlate_alerts(newest, alert).withColumnRenamed("id_machine", "machine_id")
    labelled = add_maintenance_label(wide, maintenance.withColumnRenamed("id_machine", "machine_id"), episode_lookups(spark, folder))
    return labelled.select("machine_id", us("timestamp", "last_us"), "label_gmao")


def _reference_sql(name: str, column: str) -> str:
    return f"""SELECT '{name}' AS table_name, {column} AS label, dense_rank() OVER (ORDER BY {column}) AS id
  FROM (SELECT DISTINCT {column} FROM silver WHERE {column} IS NOT NULL)"""


@query(
    "reference_ids",
    f"WITH {SILVER_SQL}, {REFERENCES_SQL} "
    + " UNION ALL ".join(_reference_sql(t, c) for t, c in LABEL_TABLES.items())
    + " UNION ALL SELECT 'type_alerte', label_gmao, id FROM type_alerte UNION ALL SELECT 'type_maintenance', label_gmao, id FROM type_maintenance",
)
def reference_ids(spark, folder):
    rows = silver(spark, folder)
    parts = [
        number_labels(rows, c).select(F.lit(t).alias("table_name"), F.col(c).alias("label"), "id") for t, c in LABEL_TABLES.items()
    ]
    for t, df in episode_lookups(spark, folder).items():
        parts.append(df.select(F.lit(t).alias("table_name"), F.col("label_gmao").alias("label"), "id"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "encode_decode_labels",
    f"""WITH {SILVER_SQL}, {NOMINAL_SQL}
SELECT s.event_id, m.id AS id_type_metal, d.type_metal AS decoded FROM silver s LEFT JOIN metals m USING (type_metal)
LEFT JOIN metals d ON d.id = CAST(round_even(m.id + 0.5, 0) AS BIGINT)""",
)
def encode_decode_labels(spark, folder):
    rows = silver(spark, folder).select("event_id", "type_metal")
    metals = number_labels(rows, "type_metal")
    coded = encode(rows, metals, "type_metal", "id_type_metal").drop("type_metal")
    shifted = coded.withColumn("near", F.col("id_type_metal") + 0.5)  # a float id half-way between two
    return decode(shifted, metals, "near", "type_metal", "decoded").select("event_id", "id_type_metal", "decoded")


@query(
    "first_row_per_machine",
    f"""WITH {SILVER_SQL}, t AS (SELECT type_machine, dense_rank() OVER (ORDER BY type_machine) AS id FROM (SELECT DISTINCT type_machine FROM silver)),
a AS (SELECT machine_id, arg_min(age_jours, "timestamp") AS age, min("timestamp") AS t0, arg_min(type_machine, "timestamp") AS type_machine FROM silver GROUP BY 1)
SELECT machine_id AS id_machine, round(age, 6) AS age_machine_jours, epoch_us(t0) AS premier_us, t.id AS id_type_machine FROM a JOIN t USING (type_machine)""",
)
def first_row_per_machine(spark, folder):
    rows = silver(spark, folder).select("machine_id", "timestamp", "age_jours", "type_machine")
    types = machine_types(rows, number_labels(rows, "type_machine"))
    return machine_ages(rows).join(types, "id_machine").select(
        "id_machine", r6("age_machine_jours"), us("premier_timestamp", "premier_us"), "id_type_machine"
    )


@query(
    "age_at_row",
    f"""WITH {SILVER_SQL}, a AS (SELECT machine_id, arg_min(age_jours, "timestamp") AS age, min("timestamp") AS t0 FROM silver GROUP BY 1)
SELECT event_id, round(age + (epoch_us("timestamp") - epoch_us(t0)) / 86400e6, 6) AS age_jours FROM silver JOIN a USING (machine_id)""",
)
def age_at_row(spark, folder):
    rows = silver(spark, folder).select("event_id", "machine_id", "timestamp", "age_jours")
    return add_age(rows.drop("age_jours"), machine_ages(rows)).select("event_id", r6("age_jours"))


@query(
    "weekly_regime",
    f"""WITH {SILVER_SQL}, w AS (SELECT machine_id, floor(floor((epoch_us("timestamp") - epoch_us(TIMESTAMP '2024-01-01')) / 86400e6) / 7)::BIGINT AS semaine, event_id, regime_cadence, "timestamp" FROM silver),
f AS (SELECT machine_id, semaine, arg_min(regime_cadence, "timestamp") AS regime FROM w WHERE regime_cadence <> 'Repos_Hebdo' GROUP BY 1, 2)
SELECT event_id, semaine, regime, CASE regime WHEN 'Sur_Charge' THEN 1.5 WHEN 'Sous_Charge' THEN 0.5 ELSE 1.0 END::DOUBLE AS facteur
FROM w LEFT JOIN f USING (machine_id, semaine)""",
)
def weekly_regime(spark, folder):
    """Regime of the machine's week and its factor; weeks without one keep factor 1."""
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    rows = silver(spark, folder).select(
        "event_id", "machine_id", "timestamp", "regime_cadence", week_index(F.col("timestamp"), start).alias("semaine")
    )
    weeks = rows.filter("regime_cadence <> 'Repos_Hebdo'").groupBy("machine_id", "semaine").agg(
        F.min_by("regime_cadence", "timestamp").alias("regime")
    )
    factor = F.create_map(F.lit("Sur_Charge"), F.lit(1.5), F.lit("Sous_Charge"), F.lit(0.5))
    joined = rows.join(weeks, ["machine_id", "semaine"], "left")
    return joined.select("event_id", "semaine", "regime", F.coalesce(F.try_element_at(factor, "regime"), F.lit(1.0)).alias("facteur"))


def training_inputs(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame, dict[str, DataFrame], DataFrame]:
    """(long readings, maintenance episodes, nominal points, lookups, alert episodes)."""
    rows = silver(spark, folder)
    statuses = number_labels(rows, "iot_statut_machine")
    metals = number_labels(rows, "type_metal")
    coded = encode(encode(rows, statuses, "iot_statut_machine", "id_status_production"), metals, "type_metal", "id_type_metal")
    readings = PUBLISHED_SENSORS + ["id_type_metal", "id_status_production"]
    long = wide_to_long(coded, readings).withColumnRenamed("sensor_timestamp", "timestamp")
    alert, maintenance = alert_maintenance(spark, folder)
    nominal, regimes = nominal_points(spark, folder)
    lookups = {
        **episode_lookups(spark, folder),
        "type_metal": metals,
        "production_status": statuses,
        "regime_cadence": regimes,
        "age_machine": machine_ages(rows),
    }
    return long, maintenance.withColumnRenamed("id_machine", "machine_id"), nominal, lookups, alert


@query(
    "assembled_training_frame",
    f"""WITH {EPISODES_SQL}, {NOMINAL_SQL}, {LABELLED},
bounds AS (SELECT min("timestamp") - INTERVAL 1 DAY AS lo, max("timestamp") AS hi FROM silver),
nb AS (SELECT n.* FROM nominal n, bounds WHERE n."timestamp" BETWEEN lo AND hi),
j AS (SELECT s.machine_id, s."timestamp", s.type_metal, s.iot_statut_machine, s.iot_vitesse_rotation, s.iot_vibration_peak, n.regime_cadence, n.vitesse_rotation_nominal
  FROM silver s ASOF LEFT JOIN nb n ON s.machine_id = n.machine_id AND s."timestamp" >= n."timestamp"),
a AS (SELECT machine_id, arg_min(age_jours, "timestamp") AS age, min("timestamp") AS t0, max("timestamp") AS last_at FROM silver GROUP BY 1),
k AS (SELECT j.*, lab.label_gmao, age + (epoch_us(j."timestamp") - epoch_us(t0)) / 86400e6 AS age_jours, last_at
  FROM j JOIN lab USING (machine_id, "timestamp") JOIN a USING (machine_id))
SELECT k.machine_id, epoch_us(k."timestamp") AS timestamp_us, type_metal, iot_statut_machine, round(iot_vitesse_rotation, 6) AS iot_vitesse_rotation,
  round(iot_vibration_peak, 6) AS iot_vibration_peak, regime_cadence, vitesse_rotation_nominal, label_gmao, round(age_jours, 6) AS age_jours,
  round((epoch_us(coalesce(m.debut_panne, last_at)) - epoch_us(k."timestamp")) / 86400e6, 6) AS "RUL_jours"
FROM k ASOF LEFT JOIN maintenance m ON k.machine_id = m.id_machine AND k."timestamp" <= m.debut_panne""",
)
def assembled_training_frame(spark, folder):
    """Pivot, decode, nominal values, age, label and target in one plan."""
    df = training_frame(*training_inputs(spark, folder))
    return df.select(
        "machine_id",
        us("timestamp"),
        "type_metal",
        "iot_statut_machine",
        r6("iot_vitesse_rotation"),
        r6("iot_vibration_peak"),
        "regime_cadence",
        "vitesse_rotation_nominal",
        "label_gmao",
        r6("age_jours"),
        r6("RUL_jours"),
    )


@query(
    "machine_context",
    f"WITH {SILVER_SQL} SELECT event_id, secteur, type_machine FROM silver",
)
def machine_context(spark, folder):
    """Type and sector found again from the dimension and the sector history."""
    rows = silver(spark, folder)
    types = number_labels(rows, "type_machine")
    wide = rows.select("event_id", "machine_id", "timestamp")
    joined = add_machine_context(wide, typed_machines(machine_types(rows, types), types), sector_history(rows))
    return joined.select("event_id", "secteur", "type_machine")


@query(
    "nominal_training_bounds",
    """WITH r AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events WHERE event_type = 'click' AND user_id >= 10)
SELECT event_id, epoch_us(ts) AS timestamp_us FROM events, r WHERE event_type = 'purchase' AND ts BETWEEN lo - INTERVAL 1 DAY AND hi""",
)
def nominal_training_bounds(spark, folder):
    rows = events(spark, folder).select("event_id", F.col("ts").alias("timestamp"), "event_type", "user_id")
    readings = rows.filter("event_type = 'click' AND user_id >= 10")
    kept = nominal_for_training(rows.filter("event_type = 'purchase'"), readings)
    return kept.select("event_id", us("timestamp"))


@query(
    "surrogate_keys",
    """WITH known AS (SELECT c_name AS agent_id, row_number() OVER (ORDER BY c_name) AS agent_key FROM customer WHERE c_custkey % 3 = 0),
fresh AS (SELECT c_name AS agent_id FROM customer UNION SELECT s_name FROM supplier EXCEPT SELECT agent_id FROM known)
SELECT agent_id, agent_key::INTEGER AS agent_key FROM known UNION ALL
SELECT agent_id, ((SELECT max(agent_key) FROM known) + row_number() OVER (ORDER BY agent_id))::INTEGER FROM fresh""",
)
def surrogate_keys(spark, folder):
    """Known keys stay; new names are numbered after the largest key in name order."""
    customers = table(spark, folder, "customer").select(F.col("c_name").alias("agent_id"), "c_custkey")
    known = rank_all(customers.filter("c_custkey % 3 = 0").select("agent_id"), "agent_id", "agent_key")
    seen = customers.select("agent_id").unionByName(table(spark, folder, "supplier").select(F.col("s_name").alias("agent_id")))
    return extend_keys(known, seen, "agent_id", "agent_key")


@query(
    "constraint_report",
    """SELECT 'orders' AS table_name, 'unique:o_orderkey' AS rule, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'orders', 'not_null:o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders
UNION ALL SELECT 'orders', 'max_length:o_orderpriority', count(*) FILTER (WHERE length(o_orderpriority) > 8) FROM orders
UNION ALL SELECT 'orders', 'reference:o_custkey', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)""",
)
def orders_constraints(spark, folder):
    """Key, null, length and reference rules; references are checked against some customers only,
    so that violations exist."""
    customers = table(spark, folder, "customer").filter("c_nationkey < 20")
    return constraint_report(
        "orders", table(spark, folder, "orders"), ["o_orderkey"], ["o_custkey"], {"o_orderpriority": 8}, {"o_custkey": (customers, "c_custkey")}
    )
