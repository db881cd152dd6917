"""Downtime, maintenance and prediction dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickforge.catalog import query
from tickforge.catalog.history import alert_maintenance
from tickforge.catalog.joins import episode_lookups
from tickforge.catalog.silver import EPISODES_SQL, events, mean6, prop_k, r6, silver, us
from tickforge.operators.episodes import sector_history
from tickforge.operators.reference import machine_ages, machine_types, number_labels
from tickforge.plans import dashboards as D

# The dashboard window: ten days inside the data.
BEGIN, END = "2024-01-06 00:00:00", "2024-01-16 00:00:00"
SPAN = 10 * 86400.0


def window():
    return F.lit(BEGIN).cast("timestamp_ntz"), F.lit(END).cast("timestamp_ntz")


def _chosen(table: str, start: str, end: str) -> str:
    return f"""chosen AS (SELECT *, (epoch_us({end}) - epoch_us({start})) / 1e6 AS s FROM {table}
  WHERE {start} >= TIMESTAMP '{BEGIN}' AND {start} <= TIMESTAMP '{END}')"""


ALERTS = f"{EPISODES_SQL}, {_chosen('alerte', 'debut_alerte', 'fin_alerte')}"
MAINTENANCE = f"{EPISODES_SQL}, {_chosen('maintenance', 'debut_panne', 'fin_panne')}"
FIGURES = f"count(*) AS nb_pannes, round(sum(s), 6) AS temps_arret_secondes, round(sum(s) / {SPAN} * 100, 6) AS temps_arret_pct"
MACHINES = """machines AS (SELECT machine_id AS id_machine, arg_min(type_machine, "timestamp") AS type_machine FROM silver GROUP BY 1)"""
SECTORS = """sectors AS (SELECT machine_id AS id_machine, arg_max(secteur, "timestamp") AS secteur FROM silver GROUP BY 1)"""


def alerts(spark, folder) -> DataFrame:
    return alert_maintenance(spark, folder)[0]


def machines(spark, folder) -> DataFrame:
    """All machines with their types."""
    rows = silver(spark, folder).select("machine_id", "timestamp", "type_machine")
    types = number_labels(rows, "type_machine")
    return D.typed_machines(machine_types(rows, types), types)


@query("downtime_by_machine", f"WITH {ALERTS} SELECT id_machine, {FIGURES} FROM chosen GROUP BY 1")
def downtime_by_machine(spark, folder):
    df = D.downtime(alerts(spark, folder), ["id_machine"], *window())
    out = df.select("id_machine", "nb_pannes", r6("temps_arret_secondes"), r6("temps_arret_pct"))
    return D.by_largest(out, "temps_arret_pct")


@query(
    "downtime_clipped",
    f"""WITH {EPISODES_SQL}, c AS (SELECT id_machine, (epoch_us(least(fin_alerte, TIMESTAMP '{END}')) - epoch_us(debut_alerte)) / 1e6 AS s FROM alerte
  WHERE debut_alerte >= TIMESTAMP '{BEGIN}' AND debut_alerte <= TIMESTAMP '{END}')
SELECT id_machine, {FIGURES} FROM c GROUP BY 1""",
)
def downtime_clipped(spark, folder):
    df = D.downtime(alerts(spark, folder), ["id_machine"], *window(), clip=True)
    return df.select("id_machine", "nb_pannes", r6("temps_arret_secondes"), r6("temps_arret_pct"))


@query(
    "downtime_by_type",
    f"""WITH {ALERTS}, {MACHINES}, d AS (SELECT id_machine, count(*) AS n, sum(s) AS s FROM chosen GROUP BY 1)
SELECT type_machine, sum(n)::BIGINT AS nb_pannes, round(sum(s), 6) AS temps_arret_secondes FROM d FULL JOIN machines USING (id_machine) GROUP BY 1""",
)
def downtime_by_type(spark, folder):
    per_machine = D.downtime(alerts(spark, folder), ["id_machine"], *window())
    df = D.downtime_by_type(per_machine, machines(spark, folder))
    return df.select("type_machine", "nb_pannes", r6("temps_arret_secondes"))


@query("downtime_by_alert", f"WITH {ALERTS} SELECT id_machine, id_alerte, {FIGURES} FROM chosen GROUP BY 1, 2")
def downtime_by_alert(spark, folder):
    df = D.downtime(alerts(spark, folder), ["id_machine", "id_alerte"], *window())
    return df.select("id_machine", "id_alerte", "nb_pannes", r6("temps_arret_secondes"), r6("temps_arret_pct"))


def _matrix_sql(by: str, join: str, ctes: str) -> str:
    return f"""WITH {ALERTS}, {MACHINES}, {ctes}
d AS (SELECT id_machine || '|' || id_alerte AS combo_key, count(*) AS n, sum(s) AS s, sum(s) / {SPAN} * 100 AS pct FROM chosen GROUP BY id_machine, id_alerte),
side AS (SELECT m.id_machine || '|' || ta.id AS combo_key, {by}, ta.label_gmao FROM machines m CROSS JOIN type_alerte ta {join})
SELECT {by}, label_gmao, sum(n)::BIGINT AS nb_pannes, round(sum(s), 6) AS temps_arret_secondes, round(sum(pct), 6) AS temps_arret_pct
FROM d FULL JOIN side USING (combo_key) GROUP BY ALL"""


@query("downtime_matrix", _matrix_sql("type_machine", "", ""))
def downtime_matrix(spark, folder):
    stats = D.downtime(alerts(spark, folder), ["id_machine", "id_alerte"], *window())
    df = D.downtime_matrix(stats, machines(spark, folder), episode_lookups(spark, folder)["type_alerte"])
    return df.select("type_machine", "label_gmao", "nb_pannes", r6("temps_arret_secondes"), r6("temps_arret_pct"))


@query("downtime_matrix_by_sector", _matrix_sql("type_machine, secteur", "JOIN sectors sec ON sec.id_machine = m.id_machine", f"{SECTORS},"))
def downtime_matrix_by_sector(spark, folder):
    stats = D.downtime(alerts(spark, folder), ["id_machine", "id_alerte"], *window())
    sectors = D.latest_sector(sector_history(silver(spark, folder).select("machine_id", "timestamp", "secteur")))
    df = D.downtime_matrix(stats, machines(spark, folder), episode_lookups(spark, folder)["type_alerte"], sectors)
    return df.select("type_machine", "secteur", "label_gmao", "nb_pannes", r6("temps_arret_secondes"), r6("temps_arret_pct"))


@query(
    "failure_share",
    f"WITH {ALERTS} SELECT id_machine, count(*) AS nb_pannes, round(count(*) / (SELECT count(*)::DOUBLE FROM chosen), 6) AS part FROM chosen GROUP BY 1",
)
def failure_share(spark, folder):
    df = D.share_of_failures(alerts(spark, folder), ["id_machine"], *window())
    return df.select("id_machine", "nb_pannes", r6("part"))


@query("current_sector", f"WITH {EPISODES_SQL}, {SECTORS} SELECT id_machine, secteur FROM sectors")
def current_sector(spark, folder):
    return D.latest_sector(sector_history(silver(spark, folder).select("machine_id", "timestamp", "secteur")))


STATS = "count(*) AS nb_maintenances, round(sum(s), 6) AS total_duration_seconds, round(avg(s) + 1e-9, 6) AS avg_duration_seconds"


@query("maintenance_stats", f"WITH {MAINTENANCE} SELECT id_machine, {STATS} FROM chosen GROUP BY 1")
def maintenance_stats(spark, folder):
    df = D.maintenance_stats(alert_maintenance(spark, folder)[1], ["id_machine"], *window())
    return D.by_largest(df.select("id_machine", "nb_maintenances", r6("total_duration_seconds"), mean6("avg_duration_seconds")), "nb_maintenances")


@query(
    "maintenance_by_label",
    f"""WITH {MAINTENANCE}, d AS (SELECT id_panne, {STATS} FROM chosen WHERE id_panne = 1 GROUP BY 1)
SELECT coalesce(d.id_panne, t.id) AS id_panne, nb_maintenances, total_duration_seconds, avg_duration_seconds, label_gmao
FROM d FULL JOIN type_maintenance t ON d.id_panne = t.id""",
)
def maintenance_by_label(spark, folder):
    """Per type with its label; a type without episodes in the window is listed too."""
    episodes = alert_maintenance(spark, folder)[1].filter("id_panne = 1")
    stats = D.maintenance_stats(episodes, ["id_panne"], *window())
    df = D.maintenance_by_label(stats, episode_lookups(spark, folder)["type_maintenance"])
    return df.select("id_panne", "nb_maintenances", r6("total_duration_seconds"), mean6("avg_duration_seconds"), "label_gmao")


@query(
    "age_vs_failure",
    f"""WITH {ALERTS}, d AS (SELECT id_machine, count(*) AS n, sum(s) / {SPAN} * 100 AS pct FROM chosen GROUP BY 1),
a AS (SELECT machine_id AS id_machine, arg_min(age_jours, "timestamp") AS age FROM silver GROUP BY 1)
SELECT id_machine, round(age, 6) AS age_machine_jours, n AS nb_pannes, round(pct, 6) AS temps_arret_pct FROM a FULL JOIN d USING (id_machine)""",
)
def age_vs_failure(spark, folder):
    ages = machine_ages(silver(spark, folder).select("machine_id", "timestamp", "age_jours"))
    df = D.age_against_failures(D.downtime(alerts(spark, folder), ["id_machine"], *window()), ages)
    return D.by_largest(df.select("id_machine", r6("age_machine_jours"), "nb_pannes", r6("temps_arret_pct")), "age_machine_jours")


def predictions(spark, folder) -> DataFrame:
    """A prediction per event: value as remaining life, a property as risk."""
    return events(spark, folder).select(
        F.col("ts").alias("time"), F.col("user_id").alias("id_machine"), (F.col("value") / 10).alias("rul_jours_estime"), (prop_k() / 100).alias("risque")
    )


PREDICTIONS = "p AS (SELECT ts, user_id AS id_machine, value / 10 AS rul, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) / 100 AS risque FROM events)"


@query(
    "latest_prediction",
    f"""WITH {PREDICTIONS} SELECT id_machine, epoch_us(ts) AS derniere_us, round(rul, 6) AS rul_jours_estime, round(risque, 6) AS risque
FROM p QUALIFY row_number() OVER (PARTITION BY id_machine ORDER BY ts DESC) = 1""",
)
def latest_prediction(spark, folder):
    df = D.latest_predictions(predictions(spark, folder)).orderBy("rul_jours_estime")
    return df.select("id_machine", us("derniere_prediction", "derniere_us"), r6("rul_jours_estime"), r6("risque"))


@query(
    "rul_band",
    f"""WITH {PREDICTIONS}, l AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY id_machine ORDER BY ts DESC) = 1)
SELECT CASE WHEN rul < 2 THEN 'red' WHEN rul < 7 THEN 'orange' ELSE 'green' END AS band, count(*) AS n FROM l GROUP BY 1""",
)
def rul_band(spark, folder):
    newest = D.latest_predictions(predictions(spark, folder))
    return newest.groupBy(D.life_band(F.col("rul_jours_estime")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "prediction_history",
    f"""WITH {PREDICTIONS} SELECT epoch_us(ts) AS time_us, id_machine, round(risque, 6) AS risque FROM p
WHERE ts >= TIMESTAMP '{BEGIN}' AND ts <= TIMESTAMP '{END}'""",
)
def prediction_history(spark, folder):
    df = D.prediction_history(predictions(spark, folder), "risque", *window())
    return df.select(us("time"), "id_machine", r6("risque"))
