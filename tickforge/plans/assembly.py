"""From long readings and episodes to the wide training frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickforge.functions.timeexpr import days_between
from tickforge.operators.asof import Side, active_episode, asof_all, episode_side, open_id
from tickforge.operators.reference import add_age, decode, decode_plc
from tickforge.operators.reshape import long_to_wide
from tickforge.schemas import HEALTHY


def correlate_alerts(readings: DataFrame, alerts: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Readings with ``id_alerte`` while an alert of their machine is open, else null."""
    left = readings.withColumn("id_machine", F.col("id_machine").cast("string"))
    right = alerts.withColumn("id_machine", F.col("id_machine").cast("string"))
    return active_episode(
        left, right, "id_machine", "timestamp", "debut_alerte", "fin_alerte", "id_alerte", block_rows=block_rows
    )


def _nominal_side(nominal: DataFrame, lookups: dict[str, DataFrame]) -> Side | None:
    if "id_regime_cadence" in nominal.columns:
        nominal = decode(nominal, lookups["regime_cadence"], "id_regime_cadence", "regime_cadence")
    payload = [c for c in nominal.columns if c not in ("machine_id", "timestamp", "id_type_metal")]
    return Side(nominal, "timestamp", payload) if payload else None


def add_nominal_values(
    wide: DataFrame, nominal: DataFrame, lookups: dict[str, DataFrame], block_rows: int | None = None
) -> DataFrame:
    """Latest nominal values of the machine at or before each row."""
    side = _nominal_side(nominal, lookups)
    return asof_all(wide, "machine_id", "timestamp", [side], block_rows=block_rows) if side else wide


def _maintenance(episodes: DataFrame) -> DataFrame:
    return episodes.select(
        F.col("machine_id").cast("string").alias("machine_id"), "debut_panne", "fin_panne", F.col("id_panne").cast("long").alias("id_panne")
    )


def label_from_ids(df: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """``label_gmao`` from the ids of open episodes: alert first, then maintenance, else healthy."""
    df = df.withColumn("_open", F.col("id_panne").isNotNull())
    df = decode(df, lookups["type_maintenance"], "id_panne", "label_gmao", "_maintenance")
    if "id_alerte" in df.columns:
        df = decode(df, lookups["type_alerte"], "id_alerte", "label_gmao", "_alert")
    else:
        df = df.withColumn("_alert", F.lit(None).cast("string"))
    label = F.when(F.col("_alert").isNotNull(), F.col("_alert")).when(F.col("_open"), F.col("_maintenance"))
    return df.withColumn("label_gmao", label.otherwise(HEALTHY)).drop("_alert", "_maintenance", "_open")


def add_maintenance_label(
    wide: DataFrame, maintenance: DataFrame, lookups: dict[str, DataFrame], block_rows: int | None = None
) -> DataFrame:
    """``label_gmao`` of each row; ``id_alerte`` is used when the rows carry it."""
    spans = _maintenance(maintenance)
    df = active_episode(
        wide, spans, "machine_id", "timestamp", "debut_panne", "fin_panne", "id_panne", block_rows=block_rows
    )
    return label_from_ids(df, lookups)


def _remaining_days(maintenance: DataFrame) -> Column:
    """Days to the next start, else to the machine's last row; null without any episode."""
    any_episode = maintenance.agg(F.count(F.lit(1)) > 0).scalar()
    to_stop = days_between(F.col("_next"), F.col("timestamp"))
    to_end = days_between(F.col("_last_at"), F.col("timestamp"))
    return F.when(any_episode, F.coalesce(to_stop, to_end))


def _starts(maintenance: DataFrame) -> Side:
    starts = maintenance.select(F.col("machine_id").cast("string").alias("machine_id"), F.col("debut_panne").alias("_next"))
    return Side(starts, "_next", ["_next"], "forward")


def add_remaining_life(wide: DataFrame, maintenance: DataFrame, block_rows: int | None = None) -> DataFrame:
    """``RUL_jours``: days to the machine's next maintenance start, else to its last row."""
    joined = asof_all(wide, "machine_id", "timestamp", [_starts(maintenance)], "_last_at", block_rows)
    return joined.withColumn("RUL_jours", _remaining_days(maintenance)).drop("_next", "_last_at")


def nominal_for_training(nominal: DataFrame, readings: DataFrame, margin_days: float = 1) -> DataFrame:
    """Nominal rows from one day before the first reading to the last one."""
    low = readings.agg(F.min("timestamp") - F.make_dt_interval(secs=F.lit(margin_days * 86400.0))).scalar()
    high = readings.agg(F.max("timestamp")).scalar()
    return nominal.filter((F.col("timestamp") >= low) & (F.col("timestamp") <= high))


def training_frame(
    readings: DataFrame,
    maintenance: DataFrame,
    nominal: DataFrame,
    lookups: dict[str, DataFrame],
    alerts: DataFrame | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Wide rows with decoded readings, nominal values, age, label and target.

    ``readings`` either carry ``id_alerte`` already or ``alerts`` are given; the id is
    constant within a tick, so matching alerts after the pivot gives the same rows from
    fewer of them. Nominal values, both kinds of open episode and the next start come
    from one scan of each machine's history.
    """
    wide = long_to_wide(readings)
    wide = wide.withColumn("machine_id", F.col("machine_id").cast("string"))
    spans = _maintenance(maintenance)
    sides = [episode_side(spans, "machine_id", "debut_panne", "fin_panne", "id_panne"), _starts(maintenance)]
    nominal_side = _nominal_side(nominal_for_training(nominal, readings), lookups)
    if nominal_side:
        sides.append(nominal_side)
    ids = ["id_panne"]
    if alerts is not None:
        named = alerts.withColumn("machine_id", F.col("id_machine").cast("string"))
        sides.append(episode_side(named, "machine_id", "debut_alerte", "fin_alerte", "id_alerte"))
        ids.append("id_alerte")
    # Large machines are found in the stored readings, before the pivot.
    counted = readings.withColumnRenamed("id_machine", "machine_id")
    df = asof_all(wide, "machine_id", "timestamp", sides, "_last_at", block_rows, counted)
    df = df.withColumns({i: open_id("timestamp", i) for i in ids}).drop(*[f"_{p}_{i}" for i in ids for p in ("end", "id")])
    df = df.withColumn("RUL_jours", _remaining_days(maintenance)).drop("_next", "_last_at")
    df = decode_plc(df, lookups)
    df = add_age(df, lookups["age_machine"])
    return label_from_ids(df, lookups)


def add_machine_context(
    wide: DataFrame, machines: DataFrame, history: DataFrame, block_rows: int | None = None
) -> DataFrame:
    """Optional features: machine type, and the sector the machine was in at each row.

    ``machines``: id_machine, type_machine. ``history``: id_machine, secteur,
    date_mise_en_service.
    """
    stays = history.select(F.col("id_machine").alias("machine_id"), "secteur", "date_mise_en_service")
    side = Side(stays, "date_mise_en_service", ["secteur"], "backward", "secteur")
    placed = asof_all(wide, "machine_id", "timestamp", [side], block_rows=block_rows)
    types = machines.select(F.col("id_machine").alias("machine_id"), "type_machine")
    return placed.join(types, "machine_id", "left")
