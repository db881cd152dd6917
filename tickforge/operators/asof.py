"""As-of joins: each left row meets the nearest right row of its key in time.

All sides are unioned and scanned once in time order, so the work is linear, one shuffle
serves any number of right sides, and a busy key is cut into blocks like any other
timeline. No inequality join is planned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tickforge.operators.timeline import Timeline


@dataclass
class Side:
    """A right side: its rows, time column, columns to bring along and direction.

    ``backward`` takes the latest row with ``on <= left time``, ``forward`` the first with
    ``on >= left time``. Several rows at one instant: the one with the largest ``tie``
    wins backward, the smallest forward.
    """

    rows: DataFrame
    on: str
    payload: list[str]
    direction: str = "backward"
    tie: str | None = None

    def __post_init__(self) -> None:
        if self.direction not in ("backward", "forward"):
            raise ValueError(f"unknown direction: {self.direction}")


def asof_all(
    left: DataFrame,
    by: str,
    left_on: str,
    sides: list[Side],
    key_max: str | None = None,
    block_rows: int | None = None,
    plan_on: DataFrame | None = None,
) -> DataFrame:
    """Left rows with the payload columns of the nearest row of every side.

    The left row count never changes. ``key_max`` adds the key's latest left time under
    that name, from the same scan. ``plan_on`` may stand in for the left rows when large
    keys are counted; right sides are taken to be the smaller ones then.
    """
    kind, instant = left.schema[by].dataType, left.schema[left_on].dataType
    # At one instant: backward sides, then left rows, then forward sides.
    both = left.select(
        F.col(by).alias("_by"),
        F.col(left_on).alias("_at"),
        F.lit(1).alias("_side"),
        F.struct(*[F.col(c) for c in left.columns]).alias("_left"),
    )
    for i, side in enumerate(sides):
        rights = side.rows.filter(F.col(by).isNotNull() & F.col(side.on).isNotNull()).select(
            F.col(by).cast(kind).alias("_by"),
            F.col(side.on).cast(instant).alias("_at"),
            F.lit(0 if side.direction == "backward" else 2).alias("_side"),
            (F.col(side.tie) if side.tie else F.lit(0)).alias(f"_tie{i}"),
            F.struct(*[F.col(c) for c in side.payload]).alias(f"_right{i}"),
        )
        both = both.unionByName(rights, allowMissingColumns=True)
    order = ["_at", "_side", *[f"_tie{i}" for i in range(len(sides))]]
    if plan_on is not None:
        plan_on = plan_on.select(F.col(by).cast(kind).alias("_by"), F.col(left_on).cast(instant).alias("_at"))
    line = Timeline(both, ["_by"], order, block_rows, plan_on)
    before = {f"_near{i}": F.col(f"_right{i}") for i, s in enumerate(sides) if s.direction == "backward"}
    after = {f"_near{i}": F.col(f"_right{i}") for i, s in enumerate(sides) if s.direction == "forward"}
    if before:
        line = line.last_valid(before)
    if after:
        line = line.next_valid(after)
    if key_max:
        line = line.key_max({"_last": F.when(F.col("_left").isNotNull(), F.col("_at"))})
    known = F.col("_by").isNotNull() & F.col("_at").isNotNull()
    brought = [
        F.when(known, F.col(f"_near{i}").getField(c)).alias(c) for i, s in enumerate(sides) for c in s.payload
    ]
    last = [F.col("_last").alias(key_max)] if key_max else []
    return line.df.filter(F.col("_left").isNotNull()).select("_left.*", *brought, *last)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_on: str,
    right_on: str,
    payload: list[str],
    direction: str = "backward",
    tie: str | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Left rows with the ``payload`` columns of the nearest right row."""
    return asof_all(left, by, left_on, [Side(right, right_on, payload, direction, tie)], block_rows=block_rows)


def episode_side(episodes: DataFrame, by: str, start: str, end: str, id_column: str) -> Side:
    """Episodes as a right side; turn the result into an id with ``open_id``."""
    spans = episodes.select(
        F.col(by), F.col(start).alias(f"_start_{id_column}"), F.col(end).alias(f"_end_{id_column}"), F.col(id_column).cast("long").alias(f"_id_{id_column}")
    )
    return Side(spans, f"_start_{id_column}", [f"_end_{id_column}", f"_id_{id_column}"], "backward", f"_id_{id_column}")


def open_id(at: str, id_column: str) -> Column:
    """Id of the latest-started episode while ``start <= at < end``."""
    return F.when(F.col(at) < F.col(f"_end_{id_column}"), F.col(f"_id_{id_column}"))


def active_episode(
    readings: DataFrame,
    episodes: DataFrame,
    by: str,
    at: str,
    start: str,
    end: str,
    id_column: str,
    block_rows: int | None = None,
) -> DataFrame:
    """Readings with the id of the latest-started episode while it is open.

    The instant of the end is outside. Only the latest-started episode counts, so an
    older one still open behind a closed one is not seen. Row count and columns of
    ``readings`` are kept.
    """
    side = episode_side(episodes, by, start, end, id_column)
    joined = asof_all(readings, by, at, [side], block_rows=block_rows)
    return joined.withColumn(id_column, open_id(at, id_column)).drop(*side.payload)
