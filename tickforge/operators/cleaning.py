"""Stuck, spiking and missing sensor values."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickforge.functions import is_close
from tickforge.operators.timeline import Timeline
from tickforge.schemas import NOISY_SENSORS, SENSORS

STUCK_ROWS = 8
SPIKE_SCORE = 8.0
SPIKE_ROWS = 241
SPIKE_MIN = 15
MAD_TO_SIGMA = 1.4826
FILL_ROWS = 3


def flag_stuck(line: Timeline, sensors: list[str], least: int = STUCK_ROWS) -> Timeline:
    """``<sensor>_bloque_suspect``: 1 on every row of a run of ``least`` close values.

    A run is long enough when the equal steps just before and just after the row add up,
    and both can be read from ``least - 1`` neighbours; no whole run is ever gathered.
    """
    line = line.previous_row({f"_p_{c}": F.col(c) for c in sensors})
    line = line.with_columns({f"_same_{c}": is_close(F.col(c), F.col(f"_p_{c}")) for c in sensors})
    line = line.position("_pos")
    reach = least - 1
    frames: dict[str, tuple[Column, int, int]] = {"_ahead": (F.count(F.lit(1)), -1, reach)}
    for c in sensors:
        broken = F.when(~F.col(f"_same_{c}"), F.col("_pos"))
        frames[f"_b_{c}"] = (F.max(broken), reach - 1, 0)
        frames[f"_f_{c}"] = (F.min(broken), -1, reach)
    line = line.frames(frames)
    flags = {}
    for c in sensors:
        back = F.coalesce(F.col("_pos") - F.col(f"_b_{c}"), F.lit(reach))
        ahead = F.coalesce(F.col(f"_f_{c}") - F.col("_pos") - 1, F.col("_ahead"))
        long_run = (back + ahead + 1 >= least) & F.col(c).isNotNull()
        flags[f"{c}_bloque_suspect"] = F.coalesce(long_run, F.lit(False)).cast("int")
    line = line.with_columns(flags)
    return line.drop("_pos", "_ahead", *[p + c for c in sensors for p in ("_p_", "_same_", "_b_", "_f_")])


def remove_spikes(
    line: Timeline,
    sensors: list[str],
    score: float = SPIKE_SCORE,
    rows: int = SPIKE_ROWS,
    least: int = SPIKE_MIN,
) -> Timeline:
    """Values far from the rolling median become null and get ``<sensor>_spike_suspect``.

    Distance is in rolling median absolute deviations, over ``rows`` centred rows of
    which ``least`` must hold a value; a zero deviation never flags.

    NaN counts as missing. A median over a row frame is evaluated anew for every row by
    Spark's window operator, so the two chained medians run on Arrow blocks for every size
    of table. Each value depends on at most two half frames on either side.
    """
    half = rows // 2

    def add(table: pa.Table) -> dict:
        return {
            f"{c}_spike_suspect": pa.array(spike_marks(_numbers(table.column(c)), half, least, score).astype(np.int32))
            for c in sensors
        }

    fields = [T.StructField(f"{c}_spike_suspect", T.IntegerType()) for c in sensors]
    line = without_nan(line, sensors).map_blocks(add, fields, reach=2 * half)
    return line.with_columns({c: F.when(F.col(f"{c}_spike_suspect") == 0, F.col(c)) for c in sensors})


def without_nan(line: Timeline, sensors: list[str]) -> Timeline:
    """NaN readings become null, so that every step treats them as missing."""
    kinds = {f.name: f.dataType for f in line.df.schema.fields}
    real = [c for c in sensors if isinstance(kinds[c], (T.DoubleType, T.FloatType))]
    return line.with_columns({c: F.nanvl(F.col(c), F.lit(None)) for c in real}) if real else line


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def centred_medians(values: np.ndarray, half: int, least: int, chunk: int = 2048) -> np.ndarray:
    """Median of the values at most ``half`` places away; NaN where fewer than ``least`` are known.

    Frames are sorted some rows at a time, missing values last, and the middle is picked. Of a short
    history every frame holds all values: they are sorted once.
    """
    out = np.full(len(values), np.nan)
    if not len(values):
        return out
    if len(values) <= half + 1:
        ordered = np.sort(values[~np.isnan(values)])
        if len(ordered) >= max(1, least):
            out[:] = (ordered[(len(ordered) - 1) // 2] + ordered[len(ordered) // 2]) / 2
        return out
    half = min(half, len(values) - 1)  # nothing lies further away
    edge = np.full(half, np.nan)
    frames = np.lib.stride_tricks.sliding_window_view(np.concatenate([edge, values, edge]), 2 * half + 1)
    for first in range(0, len(values), chunk):
        ordered = np.sort(frames[first : first + chunk], axis=1)
        known = (2 * half + 1) - np.isnan(ordered).sum(axis=1)
        row = np.flatnonzero(known >= max(1, least))
        low, high = ordered[row, (known[row] - 1) // 2], ordered[row, known[row] // 2]
        out[first + row] = (low + high) / 2
    return out


def spike_marks(values: np.ndarray, half: int, least: int, score: float) -> np.ndarray:
    """True where a value lies more than ``score`` deviations from the median around it."""
    distance = np.abs(values - centred_medians(values, half, least))
    unit = MAD_TO_SIGMA * centred_medians(distance, half, least)
    return np.where(unit > 0, distance, 0.0) > score * np.where(unit > 0, unit, 1.0)


def fill_gaps(line: Timeline, sensors: list[str], limit: int = FILL_ROWS) -> Timeline:
    """Linear interpolation by row position, at most ``limit`` rows from a known value.

    Before the first and after the last known value the nearest one is repeated, again
    at most ``limit`` rows. ``<sensor>_etait_manquant`` says which values were missing.
    """
    line = line.position("_pos")
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(c).alias("v"))) for c in sensors}
    line = line.last_valid({f"_a_{c}": v for c, v in known.items()})
    line = line.next_valid({f"_z_{c}": v for c, v in known.items()})
    out = {}
    for c in sensors:
        p0, v0 = F.col(f"_a_{c}.p"), F.col(f"_a_{c}.v")
        p1, v1 = F.col(f"_z_{c}.p"), F.col(f"_z_{c}.v")
        at = F.col("_pos")
        near = F.coalesce(at - p0 <= limit, F.lit(False)) | F.coalesce(p1 - at <= limit, F.lit(False))
        between = v0 + (v1 - v0) * ((at - p0) / (p1 - p0))
        out[f"{c}_etait_manquant"] = F.col(c).isNull().cast("int")
        out[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(
            near, F.when(p0.isNull(), v1).when(p1.isNull(), v0).otherwise(between)
        )
    line = line.with_columns(out)
    return line.drop("_pos", *[p + c for c in sensors for p in ("_a_", "_z_")])


def clean_timeline(line: Timeline) -> Timeline:
    """Stuck flags on noisy sensors, then spikes, then gaps; absent sensors are skipped."""
    columns = line.df.columns
    present = [c for c in SENSORS if c in columns]
    line = without_nan(line, present)
    line = flag_stuck(line, [c for c in NOISY_SENSORS if c in columns])
    line = remove_spikes(line, present)
    return fill_gaps(line, present)


def clean_sensors(
    df: DataFrame,
    machine: str = "machine_id",
    at: str = "timestamp",
    ties: list[str] | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    return clean_timeline(Timeline(df, [machine], [at, *(ties or [])], block_rows)).df
