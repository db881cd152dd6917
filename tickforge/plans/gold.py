"""Builds all reference, dimension and episode tables from one silver table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickforge.operators.episodes import episodes_by_kind, sector_history
from tickforge.operators.reference import (
    alert_and_maintenance_references,
    encode,
    machine_ages,
    machine_types,
    number_labels,
)
from tickforge.operators.reshape import tick_lines
from tickforge.schemas import NOMINAL_COLUMNS, NOT_PUBLISHED, PUBLISHED_SENSORS
from tickforge.sources.sinks import ensure_table, exists, split_past_present, write_cold_storage, write_tick_lines

LABEL_TABLES = {
    "type_metal": "type_metal",
    "type_machine": "type_machine",
    "regime_cadence": "regime_cadence",
    "production_status": "iot_statut_machine",
}


def nominal_values(silver: DataFrame, metals: DataFrame, regimes: DataFrame) -> DataFrame:
    """Nominal columns with metal and regime as ids."""
    df = encode(silver, metals, "type_metal", "id_type_metal")
    return encode(df, regimes, "regime_cadence", "id_regime_cadence").select(*NOMINAL_COLUMNS)


def iot_and_plc(silver: DataFrame, metals: DataFrame, statuses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(IoT rows, PLC rows) as published: machine labels dropped, PLC labels as ids."""
    iot = silver.drop(*NOT_PUBLISHED)
    plc = silver.select("machine_id", "timestamp", "iot_statut_machine", "type_metal")
    plc = encode(plc, metals, "type_metal", "id_type_metal").drop("type_metal")
    plc = encode(plc, statuses, "iot_statut_machine", "id_status_production").drop("iot_statut_machine")
    return iot, plc


class GoldTables:
    """Tables under one folder, each built on first use and read back after that.

    A table that needs another one asks for it here, which builds it when absent. Two
    tables of one computation each check their own folder.
    """

    def __init__(self, spark: SparkSession, folder: str, silver: DataFrame, ties: list[str] | None = None):
        self.spark, self.folder, self.silver, self.ties = spark, folder, silver, ties
        self._builders: dict[str, Callable[[], DataFrame]] = {
            **{t: (lambda c=c: number_labels(silver, c)) for t, c in LABEL_TABLES.items()},
            "age_machine": lambda: machine_ages(silver),
            "machine_secteur_historique": lambda: sector_history(silver, ties=ties),
            "type_alerte": lambda: alert_and_maintenance_references(silver)[0],
            "type_maintenance": lambda: alert_and_maintenance_references(silver)[1],
            "machine": lambda: machine_types(silver, self["type_machine"]),
            "nominale_values": lambda: nominal_values(silver, self["type_metal"], self["regime_cadence"]),
            "alerte": lambda: self._episodes("alerte", "debut_alerte", "fin_alerte", "id_alerte"),
            "maintenance": lambda: self._episodes("maintenance", "debut_panne", "fin_panne", "id_panne"),
        }

    def _episodes(self, kind: str, start: str, end: str, id_name: str) -> DataFrame:
        """Episodes of one kind. Both kinds come from one pass over the silver table, written by kind on first use."""

        place = f"{self.folder}/episodes"
        if not exists(self.spark, place):
            both = episodes_by_kind(self.silver, self["type_alerte"], self["type_maintenance"], ties=self.ties)
            both.write.mode("errorifexists").partitionBy("kind").parquet(place)
        rows = self.spark.read.parquet(place).filter(F.col("kind") == kind)
        return rows.select(F.col("start").alias(start), F.col("end").alias(end), F.col("id").alias(id_name), "id_machine")

    def __getitem__(self, name: str) -> DataFrame:
        return ensure_table(self.spark, f"{self.folder}/{name}", self._builders[name])

    def names(self) -> list[str]:
        """Level 0 tables first, then those that need them."""
        return list(self._builders)

    def build_all(self) -> dict[str, DataFrame]:
        """All tables in order. Each reads only its own columns of the silver table, which is
        cheaper than caching all of it."""
        return {name: self[name] for name in self.names()}

    def replay_lines(self) -> DataFrame:
        iot, plc = iot_and_plc(self.silver, self["type_metal"], self["production_status"])
        return tick_lines(iot, plc, [c for c in PUBLISHED_SENSORS if c in iot.columns])

    def split_storage(self, cutoff: Column, cold_path: str, replay_path: str) -> int:
        """Readings before the cutoff to daily cold storage, the rest to a replay file.

        The replay file is never overwritten. Returns the number of days stored.
        """
        iot, plc = iot_and_plc(self.silver, self["type_metal"], self["production_status"])
        past_iot, now_iot = split_past_present(iot, cutoff)
        past_plc, now_plc = split_past_present(plc, cutoff)
        lines = tick_lines(now_iot, now_plc, [c for c in PUBLISHED_SENSORS if c in iot.columns])
        write_tick_lines(lines.select(F.col("timestamp"), "line"), replay_path)
        return write_cold_storage(past_iot, past_plc, cold_path)
