"""Runs of equal values per machine turned into episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickforge.functions import has_prefix
from tickforge.functions.timeexpr import seconds_between
from tickforge.operators.quality import require_columns
from tickforge.operators.timeline import Timeline


def mark_runs(
    df: DataFrame,
    value: str,
    machine: str = "machine_id",
    at: str = "timestamp",
    ties: list[str] | None = None,
    max_gap_seconds: float | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Adds ``run``, a per-machine run number that grows when ``value`` changes.

    A null never equals the value before it, so each null row is its own run. There is
    no largest gap between rows of a run unless ``max_gap_seconds`` is given.
    """
    line = Timeline(df, [machine], [at, *(ties or [])], block_rows)
    line = line.previous_row({"_before": F.col(value), "_before_at": F.col(at)})
    same = F.coalesce(F.col(value) == F.col("_before"), F.lit(False))
    if max_gap_seconds is not None:
        same = same & (seconds_between(F.col(at), F.col("_before_at")) <= max_gap_seconds)
    line = line.running_sum({"run": F.when(same, 0).otherwise(1)})
    return line.drop("_before", "_before_at").df


def build_episodes(
    df: DataFrame,
    id_column: str,
    id_output: str,
    start: str,
    end: str,
    machine: str = "machine_id",
    at: str = "timestamp",
    ties: list[str] | None = None,
    max_gap_seconds: float | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """One row per run: start, end, id, machine. The end is the run's last instant."""
    require_columns(df, [id_column, machine, at])
    slim = df.select(machine, at, id_column, *[c for c in ties or [] if c not in (machine, at, id_column)])
    runs = mark_runs(slim, id_column, machine, at, ties, max_gap_seconds, block_rows)
    return runs.groupBy(machine, "run").agg(
        F.min(at).alias(start),
        F.max(at).alias(end),
        F.first(id_column).alias("_id"),
    ).select(start, end, F.col("_id").alias(id_output), F.col(machine).alias("id_machine"))


def sector_history(
    df: DataFrame,
    machine: str = "machine_id",
    sector: str = "secteur",
    at: str = "timestamp",
    ties: list[str] | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Start date of each stay of a machine in a sector."""
    stays = build_episodes(
        df, sector, sector, "date_mise_en_service", "_end", machine, at, ties, block_rows=block_rows
    )
    return stays.select("id_machine", sector, "date_mise_en_service")


def split_by_prefix(df: DataFrame, column: str, prefix: str) -> tuple[DataFrame, DataFrame]:
    """(matching rows, the rest); nulls are in the rest."""
    hit = has_prefix(F.col(column), prefix)
    return df.filter(hit), df.filter(~hit)


def attach_label_ids(
    df: DataFrame, alerts: DataFrame, maintenances: DataFrame, label: str = "label_gmao"
) -> tuple[DataFrame, DataFrame]:
    """Alert rows with ``id_alerte`` and maintenance rows with ``id_maintenance``.

    Rows of neither kind, or whose label is not in its reference table, are dropped.
    """
    alert_rows, rest = split_by_prefix(df, label, "Alerte")
    maintenance_rows, _ = split_by_prefix(rest, label, "Maintenance")
    alert_ids = alerts.select(F.col(label).alias("label_alerte"), F.col("id").alias("id_alerte"))
    maintenance_ids = maintenances.select(F.col(label).alias("label_maintenance"), F.col("id").alias("id_maintenance"))
    return (
        alert_rows.withColumnRenamed(label, "label_alerte").join(alert_ids, "label_alerte"),
        maintenance_rows.withColumnRenamed(label, "label_maintenance").join(maintenance_ids, "label_maintenance"),
    )


def alert_and_maintenance_episodes(
    df: DataFrame,
    alerts: DataFrame,
    maintenances: DataFrame,
    ties: list[str] | None = None,
    block_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(alert episodes, maintenance episodes) from labelled rows."""
    alert_rows, maintenance_rows = attach_label_ids(df, alerts, maintenances)
    alert = build_episodes(
        alert_rows, "id_alerte", "id_alerte", "debut_alerte", "fin_alerte", ties=ties, block_rows=block_rows
    )
    maintenance = build_episodes(
        maintenance_rows, "id_maintenance", "id_panne", "debut_panne", "fin_panne", ties=ties, block_rows=block_rows
    )
    return alert, maintenance


def episodes_by_kind(
    df: DataFrame,
    alerts: DataFrame,
    maintenances: DataFrame,
    label: str = "label_gmao",
    ties: list[str] | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """(kind, start, end, id, id_machine): alert and maintenance episodes of one pass over the labelled rows.

    A run breaks only at rows of its own kind, as if the other kind's rows were not there.
    """
    ids = alerts.select(label, "id", F.lit("alerte").alias("kind")).filter(has_prefix(F.col(label), "Alerte"))
    ids = ids.unionByName(maintenances.select(label, "id", F.lit("maintenance").alias("kind")).filter(has_prefix(F.col(label), "Maintenance")))
    rows = df.join(ids, label).withColumn("_who", F.concat_ws("|", "kind", "machine_id"))
    runs = build_episodes(rows, "id", "id", "start", "end", "_who", ties=ties, block_rows=block_rows)
    kind = F.substring_index("id_machine", "|", 1)
    machine = F.expr("substring(id_machine, instr(id_machine, '|') + 1)")
    return runs.select(kind.alias("kind"), "start", "end", "id", machine.alias("id_machine"))
