"""Features of a machine's history: censoring type, time since stop, deviations, trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickforge.functions import has_prefix, mentions, safe_ratio
from tickforge.functions.timeexpr import days_between
from tickforge.operators.cleaning import clean_timeline
from tickforge.operators.timeline import Timeline
from tickforge.schemas import HEALTHY, IDLE_STATUSES, NOMINAL_PAIRS, SENSORS, STOP_STATUSES

TREND_ROWS = 60
TREND_MIN = 10
REPORT_ROWS = 24 * 3600 // 30  # a day of 30-second rows


def censoring_type(label: Column) -> Column:
    """Preventif, Correctif or Sain from the label; a null label is Sain."""
    return (
        F.when(mentions(label, "Preventif"), "Preventif")
        .when(has_prefix(label, "Alerte") | mentions(label, "Correctif"), "Correctif")
        .otherwise(HEALTHY)
    )


def is_stop(status: Column) -> Column:
    return F.coalesce(status.isin(*STOP_STATUSES), F.lit(False))


def future_censoring(line: Timeline, status: str = "iot_statut_machine") -> Timeline:
    """Censoring type of the next stop row, the row itself included."""
    at_stop = F.when(is_stop(F.col(status)), F.col("type_censure"))
    return line.next_valid({"type_censure_futur_audit": at_stop})


def is_training_row(target: str = "RUL_jours", status: str = "iot_statut_machine") -> Column:
    """Target known and the machine not idle; an unknown status stays."""
    return F.col(target).isNotNull() & ~F.coalesce(F.col(status).isin(*IDLE_STATUSES), F.lit(False))


def since_last_stop(line: Timeline, at: str = "timestamp", status: str = "iot_statut_machine") -> Timeline:
    """Days since the last stop row, or the age where no stop is known yet; pieces too."""
    stop = is_stop(F.col(status))
    known = {"_stop_at": F.when(stop, F.col(at))}
    pieces = "nb_pieces_cumule" in line.df.columns
    if pieces:
        known["_stop_pieces"] = F.when(stop, F.col("nb_pieces_cumule"))
    line = line.last_valid(known)
    days = days_between(F.col(at), F.col("_stop_at"))
    if "age_jours" in line.df.columns:
        days = F.coalesce(days, F.col("age_jours"))
    out = {"jours_depuis_dernier_arret": days}
    if pieces:
        out["pieces_depuis_dernier_arret"] = F.col("nb_pieces_cumule") - F.coalesce("_stop_pieces", F.lit(0))
    return line.with_columns(out).drop(*known)


def deviations(available: list[str]) -> dict[str, Column]:
    """Measured minus nominal, and the same relative to nominal."""
    out = {}
    for name, measured, nominal in NOMINAL_PAIRS:
        if measured in available and nominal in available:
            gap = F.col(measured) - F.col(nominal)
            out[f"ecart_{name}"] = gap
            out[f"ecart_relatif_{name}"] = safe_ratio(gap, F.col(nominal))
    return out


def trends(line: Timeline, sensors: list[str], rows: int = TREND_ROWS, least: int = TREND_MIN) -> Timeline:
    """Trailing mean and sample deviation over ``rows`` rows with enough values."""
    frames = {}
    for c in sensors:
        frames[f"_n_{c}"] = (F.count(c), rows - 1, 0)
        frames[f"_m_{c}"] = (F.avg(c), rows - 1, 0)
        frames[f"_s_{c}"] = (F.stddev_samp(c), rows - 1, 0)
    line = line.frames(frames)
    out = {}
    for c in sensors:
        enough = F.col(f"_n_{c}") >= least
        out[f"{c}_moy_glissante"] = F.when(enough, F.col(f"_m_{c}"))
        out[f"{c}_std_glissante"] = F.when(enough, F.col(f"_s_{c}"))
    return line.with_columns(out).drop(*frames)


def recent_report(line: Timeline, column: str = "observation_operateur", rows: int = REPORT_ROWS) -> Timeline:
    """Was there an operator report on this row, and within the trailing ``rows`` rows?

    The trailing maximum is read off the position of the last report, so the cost does
    not depend on the length of the frame.
    """
    present = F.col(column).isNotNull()
    line = line.position("_pos").last_valid({"_report": F.when(present, F.col("_pos"))})
    recent = F.coalesce(F.col("_pos") - F.col("_report") < rows, F.lit(False))
    return line.with_columns(
        {"signalement_present": present.cast("int"), "signalement_recent_24h": recent.cast("int")}
    ).drop("_pos", "_report")


def build_features(
    df: DataFrame,
    machine: str = "machine_id",
    at: str = "timestamp",
    ties: list[str] | None = None,
    block_rows: int | None = None,
    plan_on: DataFrame | None = None,
) -> DataFrame:
    """All features of training rows, in one chain over one ordered history."""
    typed = df.withColumn("type_censure", censoring_type(F.col("label_gmao")))
    line = Timeline(typed, [machine], [at, *(ties or [])], block_rows, plan_on)
    line = future_censoring(line)  # reads stop rows that the next step may drop
    line = line.filter(is_training_row())
    line = clean_timeline(line)
    line = since_last_stop(line, at)
    columns = line.df.columns
    line = line.with_columns(deviations(columns))
    line = trends(line, [c for c in SENSORS if c in columns])
    if "observation_operateur" in columns:
        line = recent_report(line)
    return line.df


def days_to_next_stop_row(
    line: Timeline, seconds_per_row: float = 30.0, status: str = "iot_statut_machine", name: str = "RUL_jours"
) -> Timeline:
    """Target from stop rows: rows to the next stop row, in days; null after the last one."""
    line = line.position("_pos").next_valid({"_next": F.when(is_stop(F.col(status)), F.col("_pos"))})
    days = (F.col("_next") - F.col("_pos")) * seconds_per_row / 86400.0
    return line.with_columns({name: days}).drop("_pos", "_next")


def running_pieces(line: Timeline, count: str = "nb_pieces_intervalle", name: str = "nb_pieces_cumule") -> Timeline:
    """Pieces produced so far."""
    return line.running_sum({name: F.col(count)})


def steps_since_reset(
    line: Timeline, grows: Column, resets: Column, step: Column, name: str
) -> Timeline:
    """Running sum of ``step`` on growing rows that restarts at 0 on every reset row.

    The sum since the last reset is the total so far minus the total at that reset.
    """
    grown = F.when(F.coalesce(grows, F.lit(False)) & ~F.coalesce(resets, F.lit(False)), step).otherwise(0)
    line = line.running_sum({"_total": grown})
    line = line.last_valid({"_at_reset": F.when(F.coalesce(resets, F.lit(False)), F.col("_total"))})
    return line.with_columns({name: F.col("_total") - F.coalesce("_at_reset", F.lit(0))}).drop("_total", "_at_reset")
