"""Periodic scoring of all machines seen on the stream."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickforge.plans.scoring import latest_nominal, machine_context, score_machines
from tickforge.plans.training import Bundle, load_bundle
from tickforge.schemas import STOP_STATUSES
from tickforge.streaming.state import keyed_state, state_of, stop_status_ids

log = logging.getLogger(__name__)


@dataclass
class References:
    lookups: dict[str, DataFrame]
    nominal: DataFrame
    alerts: DataFrame
    maintenance: DataFrame
    bundle: Bundle | None


class Refreshed:
    """Loads references again after ``seconds``; keeps the previous copy when that fails."""

    def __init__(self, load: Callable[[], References], seconds: float = 300):
        self._load, self._seconds = load, seconds
        self._value: References | None = None
        self._at = 0.0

    def get(self) -> References:
        if self._value is None:
            self._value, self._at = self._load(), time.monotonic()
        elif time.monotonic() - self._at >= self._seconds:
            try:
                self._value = self._load()
            except Exception:  # any source may be down for a while
                log.exception("references not reloaded; previous copy kept")
            self._at = time.monotonic()
        return self._value


def score_state(state: DataFrame, refs: References) -> DataFrame:
    newest = state.agg(F.max("timestamp")).scalar()
    nominal = latest_nominal(refs.nominal, newest)
    context = machine_context(state, refs.lookups, nominal, refs.alerts, refs.maintenance)
    return score_machines(context, refs.bundle)


def bundle_loader(spark: SparkSession, path: str) -> Callable[[], Bundle | None]:
    return lambda: load_bundle(spark, path)


def start_scoring(
    long: DataFrame,
    references: Refreshed,
    path: str,
    checkpoint: str,
    every: str | None = "60 seconds",
) -> StreamingQuery:
    """Writes one prediction per machine and tick to a Parquet table, one partition ``batch`` a tick.

    A tick that runs again after a failure replaces its partition, so no prediction repeats. Each tick takes one version
    of all references, the stop statuses among them: a changed lookup counts from the next tick on, for readings
    that came before it as well.
    """
    state = keyed_state(long)

    def tick(batch: DataFrame, number: int) -> None:
        refs = references.get()
        stops = stop_status_ids(refs.lookups["production_status"], STOP_STATUSES)
        machines = state_of(batch, F.array(*[F.lit(i).cast("long") for i in stops]).cast("array<bigint>"))
        scored = score_state(machines, refs).withColumn("batch", F.lit(number).cast("long"))
        scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    # Complete mode hands every known machine to each tick, changed or not.
    writer = state.writeStream.outputMode("complete").foreachBatch(tick).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
