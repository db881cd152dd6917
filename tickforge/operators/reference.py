"""Reference tables, encoding and decoding, machine dimensions, surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickforge.functions import half_even_long, mentions
from tickforge.functions.timeexpr import days_between
from tickforge.operators.episodes import split_by_prefix
from tickforge.operators.ordering import SMALL_ROWS, rank_all, rank_written
from tickforge.operators.quality import require_columns
from tickforge.operators.timeline import SPREAD, note_rows, surely_small
from tickforge.schemas import HEALTHY, PLC_DECODING
from tickforge.session import checkpoint_dir

BROADCAST_ROWS = 100_000


def unique_label_table(df: DataFrame, label: str) -> DataFrame:
    """(label, id): distinct non-null labels numbered from 1 in alphabetical order."""
    if not df.columns:
        raise ValueError("the table has no column")
    if label not in df.columns:
        raise ValueError(f"the table has no column {label}")
    if df.isEmpty():
        raise ValueError("the table has no row")
    return number_labels(df, label)


def number_labels(df: DataFrame, label: str, small_rows: int | None = None) -> DataFrame:
    """As above without the checks on content.

    Over large tables the labels are found once, written to the checkpoint folder and
    counted; a table of at most ``BROADCAST_ROWS`` labels is then marked for broadcast, so
    that joining it never shuffles the rows by label.
    """
    limit = small_rows if small_rows is not None else SMALL_ROWS
    labels = df.select(label).filter(F.col(label).isNotNull()).distinct()
    if surely_small(labels, SPREAD * limit):  # a row has one label
        return rank_written(labels, label, "id", True)
    checkpoint_dir(df.sparkSession)
    labels = labels.checkpoint()
    n = labels.count()
    note_rows(labels, n)
    ranked = rank_written(labels, label, "id", n <= limit)
    return F.broadcast(ranked) if n <= BROADCAST_ROWS else ranked


def drop_rows_mentioning(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose text does not contain ``text``, whatever the case; nulls stay."""
    return df.filter(~mentions(F.col(column), text, ignore_case=True))


def alert_and_maintenance_references(df: DataFrame, label: str = "label_gmao") -> tuple[DataFrame, DataFrame]:
    """(alert labels, maintenance labels) with ids, healthy rows left out."""
    labels = drop_rows_mentioning(df.select(label), label, HEALTHY)
    alerts, maintenances = split_by_prefix(labels, label, "Alerte")
    return number_labels(alerts, label), number_labels(maintenances, label)


def encode(df: DataFrame, lookup: DataFrame, label: str, id_column: str, how: str = "left") -> DataFrame:
    """Replaces nothing: adds ``id_column`` for ``label``. Spark broadcasts by measured size."""
    return df.join(lookup.select(F.col(label), F.col("id").alias(id_column)), label, how)


def decode(df: DataFrame, lookup: DataFrame, id_column: str, label: str, label_output: str | None = None) -> DataFrame:
    """Label in place of a possibly float id; unknown ids give null."""
    if id_column not in df.columns:
        return df
    out = label_output or label
    ids = lookup.select(F.col("id").cast("long").alias("_id"), F.col(label).alias(out))
    return df.withColumn("_id", half_even_long(F.col(id_column))).drop(id_column).join(ids, "_id", "left").drop("_id")


def decode_plc(df: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    for id_column, (table, label) in PLC_DECODING.items():
        if id_column in df.columns:
            df = decode(df, lookups[table], id_column, label)
    return df


def machine_ages(
    df: DataFrame, machine: str = "machine_id", age: str = "age_jours", at: str = "timestamp"
) -> DataFrame:
    """First known age and first timestamp of each machine."""
    require_columns(df, [machine, age, at])
    return df.groupBy(F.col(machine).alias("id_machine")).agg(
        F.min_by(age, F.when(F.col(age).isNotNull(), F.col(at))).alias("age_machine_jours"),
        F.min(at).alias("premier_timestamp"),
    )


def machine_types(
    df: DataFrame,
    types: DataFrame,
    machine: str = "machine_id",
    kind: str = "type_machine",
    at: str = "timestamp",
) -> DataFrame:
    """First known type of each machine as its id; machines of unknown type are dropped."""
    require_columns(df, [machine, kind, at])
    require_columns(types, [kind, "id"])
    first = df.groupBy(F.col(machine).alias("id_machine")).agg(
        F.min_by(kind, F.when(F.col(kind).isNotNull(), F.col(at))).alias(kind)
    )
    return first.join(types.select(kind, F.col("id").alias("id_type_machine")), kind).select(
        "id_machine", "id_type_machine"
    )


def add_age(df: DataFrame, ages: DataFrame, machine: str = "machine_id", at: str = "timestamp") -> DataFrame:
    """Age in days at each row: age at first sight plus elapsed days."""
    ages = ages.select(
        F.col("id_machine").cast("string").alias(machine),
        F.col("age_machine_jours").cast("double").alias("_age"),
        F.col("premier_timestamp").alias("_since"),
    )
    joined = df.join(ages, machine, "left")
    return joined.withColumn("age_jours", F.col("_age") + days_between(F.col(at), F.col("_since"))).drop(
        "_age", "_since"
    )


def extend_keys(known: DataFrame, seen: DataFrame, natural: str, key: str, small_rows: int | None = None) -> DataFrame:
    """Known (natural, key) pairs plus new ones numbered after the largest key.

    New ids are numbered in order of their natural key.
    """
    new = seen.select(F.col(natural)).filter(F.col(natural).isNotNull()).distinct().join(known, natural, "left_anti")
    numbered = rank_all(new, natural, "_rank", small_rows)
    top = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("_top"))
    # One-row table.
    fresh = numbered.join(F.broadcast(top)).select(
        natural, (F.col("_top") + F.col("_rank")).cast("int").alias(key)
    )
    return known.select(natural, F.col(key).cast("int").alias(key)).unionByName(fresh)
