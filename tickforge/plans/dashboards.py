"""Dashboard queries over episodes, dimensions and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickforge.functions.timeexpr import seconds_between

RED_DAYS, ORANGE_DAYS = 2, 7


def in_range(start: str, begin: Column, end: Column) -> Column:
    """Episodes are chosen by their start, both ends included."""
    return (F.col(start) >= begin) & (F.col(start) <= end)


def downtime(
    episodes: DataFrame,
    by: list[str],
    begin: Column,
    end: Column,
    start: str = "debut_alerte",
    stop: str = "fin_alerte",
    clip: bool = False,
) -> DataFrame:
    """Episode count, total seconds and share of the window, per group.

    Episodes are not cut at the window's end, so a share may pass 100 unless ``clip``.
    """
    last = F.least(F.col(stop), end) if clip else F.col(stop)
    chosen = episodes.filter(in_range(start, begin, end)).withColumn("_s", seconds_between(last, F.col(start)))
    span = seconds_between(end, begin)
    return chosen.groupBy(*by).agg(
        F.count(F.lit(1)).alias("nb_pannes"),
        F.sum("_s").alias("temps_arret_secondes"),
        (F.sum("_s") / span * 100).alias("temps_arret_pct"),
    )


def share_of_failures(episodes: DataFrame, by: list[str], begin: Column, end: Column, start: str = "debut_alerte") -> DataFrame:
    """Episode count per group and its share of all episodes."""
    counts = episodes.filter(in_range(start, begin, end)).groupBy(*by).agg(F.count(F.lit(1)).alias("nb_pannes"))
    total = counts.agg(F.sum("nb_pannes")).scalar()
    return counts.withColumn("part", F.col("nb_pannes") / total)


def typed_machines(machines: DataFrame, types: DataFrame) -> DataFrame:
    """(id_machine, type_machine)."""
    return machines.join(types.select(F.col("id").alias("id_type_machine"), "type_machine"), "id_type_machine").select(
        "id_machine", "type_machine"
    )


def downtime_by_type(per_machine: DataFrame, machines: DataFrame) -> DataFrame:
    """Machine figures outer-joined to machine types and summed again per type."""
    both = per_machine.join(machines, "id_machine", "full")
    return both.groupBy("type_machine").agg(
        F.sum("nb_pannes").alias("nb_pannes"), F.sum("temps_arret_secondes").alias("temps_arret_secondes")
    )


def latest_sector(history: DataFrame) -> DataFrame:
    """Current sector of each machine."""
    return history.groupBy("id_machine").agg(F.max_by("secteur", "date_mise_en_service").alias("secteur"))


def downtime_matrix(
    per_machine_alert: DataFrame, machines: DataFrame, alert_types: DataFrame, sectors: DataFrame | None = None
) -> DataFrame:
    """Downtime per machine type (and sector) and alert label, empty pairs included.

    Pairs without an episode only matter per group, so groups are paired with labels
    after machines have been reduced to their distinct types and sectors.
    """
    by = ["type_machine"] + (["secteur"] if sectors is not None else [])
    groups = machines.join(sectors, "id_machine") if sectors is not None else machines
    labels = alert_types.select(F.col("id").alias("id_alerte"), "label_gmao")
    matched = per_machine_alert.join(groups, "id_machine", "left").join(labels, "id_alerte", "left")
    # A pair unknown on the reference side has neither type nor label.
    known = F.col("type_machine").isNotNull() & F.col("label_gmao").isNotNull()
    matched = matched.withColumns({c: F.when(known, F.col(c)) for c in [*by, "label_gmao"]})
    # The few alert labels travel as one array; no join pairs them with the groups.
    names = labels.agg(F.collect_set("label_gmao")).scalar()
    empty = groups.select(*by).distinct().withColumn("label_gmao", F.explode(names))
    rows = matched.select(*by, "label_gmao", "nb_pannes", "temps_arret_secondes", "temps_arret_pct")
    return (
        rows.unionByName(empty, allowMissingColumns=True)
        .groupBy(*by, "label_gmao")
        .agg(*[F.sum(c).alias(c) for c in ("nb_pannes", "temps_arret_secondes", "temps_arret_pct")])
    )


def maintenance_stats(
    episodes: DataFrame, by: list[str], begin: Column, end: Column, start: str = "debut_panne", stop: str = "fin_panne"
) -> DataFrame:
    """Count, total and mean duration of maintenance per group."""
    chosen = episodes.filter(in_range(start, begin, end)).withColumn(
        "_s", seconds_between(F.col(stop), F.col(start))
    )
    return chosen.groupBy(*by).agg(
        F.count(F.lit(1)).alias("nb_maintenances"),
        F.sum("_s").alias("total_duration_seconds"),
        F.avg("_s").alias("avg_duration_seconds"),
    )


def maintenance_by_label(stats: DataFrame, types: DataFrame) -> DataFrame:
    """Per-type figures with their label; types never seen are listed too."""
    return stats.join(types.select(F.col("id").alias("id_panne"), "label_gmao"), "id_panne", "full")


def age_against_failures(per_machine: DataFrame, ages: DataFrame) -> DataFrame:
    """Age next to failure figures; either side may be missing."""
    return ages.select("id_machine", "age_machine_jours").join(per_machine, "id_machine", "full")


def latest_predictions(predictions: DataFrame, at: str = "time") -> DataFrame:
    """Newest prediction of each machine."""
    kept = [c for c in predictions.columns if c not in ("id_machine", at)]
    newest = predictions.groupBy("id_machine").agg(
        F.max(at).alias("derniere_prediction"), F.max_by(F.struct(*kept), at).alias("_p")
    )
    return newest.select("id_machine", "derniere_prediction", *[F.col("_p").getField(c).alias(c) for c in kept])


def prediction_history(predictions: DataFrame, value: str, begin: Column, end: Column, at: str = "time") -> DataFrame:
    """One series per machine, in time order."""
    return predictions.filter(in_range(at, begin, end)).select(at, "id_machine", value).orderBy(at, "id_machine")


def life_band(days: Column) -> Column:
    """red below 2 days, orange below 7, else green."""
    return F.when(days < RED_DAYS, "red").when(days < ORANGE_DAYS, "orange").when(days.isNotNull(), "green")


def by_largest(df: DataFrame, column: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(column))


def whole_range(df: DataFrame, at: str) -> tuple[Column, Column]:
    """First and last instant of a table as scalar subqueries."""
    return df.agg(F.min(at)).scalar(), df.agg(F.max(at)).scalar()
