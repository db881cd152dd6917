"""Wide, long and per-tick shapes of sensor readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickforge.operators.quality import require_columns
from tickforge.operators.reference import number_labels
from tickforge.schemas import PLC_READINGS, PUBLISHED_SENSORS

KNOWN_READINGS = PUBLISHED_SENSORS + PLC_READINGS


def wide_to_long(df: DataFrame, columns: list[str], machine: str = "machine_id", at: str = "timestamp") -> DataFrame:
    """One row per non-null reading: id_machine, sensor, value, sensor_timestamp."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.select(
            F.col(machine).alias("id_machine"),
            F.lit("").alias("sensor"),
            F.lit(0.0).alias("value"),
            F.col(at).alias("sensor_timestamp"),
        ).limit(0)
    slim = df.select(machine, at, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in present])
    long = slim.unpivot([machine, at], present, "sensor", "value").filter(F.col("value").isNotNull())
    return long.select(
        F.col(machine).alias("id_machine"), "sensor", "value", F.col(at).alias("sensor_timestamp")
    )


def long_to_wide(
    df: DataFrame, readings: list[str] | None = None, machine: str = "id_machine", at: str = "timestamp"
) -> DataFrame:
    """One row per (machine, instant) with a column per reading; wide input passes through.

    Without ``readings`` every sensor found in the data gets a column, after the known ones;
    a stream cannot be searched beforehand and has the known ones only. Of several values of
    one reading and instant the last to arrive (column ``time``, where there is one) counts, then the
    largest. Other columns are constant within a tick and keep their largest value.
    """
    if "sensor" not in df.columns or "value" not in df.columns:
        return df.withColumnRenamed(machine, "machine_id")
    names = readings or found_readings(df)
    constants = [c for c in df.columns if c not in (machine, at, "sensor", "value")]
    arrival = F.struct(*[c for c in ("time",) if c in df.columns], "value")
    known = F.col("value").isNotNull()
    pivoted = [F.max_by("value", F.when((F.col("sensor") == n) & known, arrival)).alias(n) for n in names]
    kept = [F.max(c).alias(c) for c in constants]
    return df.groupBy(F.col(machine).alias("machine_id"), at).agg(*pivoted, *kept)


def found_readings(df: DataFrame) -> list[str]:
    """The known readings, then all others that occur, in order of name."""
    if df.isStreaming:
        return KNOWN_READINGS
    seen = {r[0] for r in df.select("sensor").distinct().collect()} - {None}
    return [*KNOWN_READINGS, *sorted(seen.difference(KNOWN_READINGS))]


def assemble_rows(
    df: DataFrame, sequence: str, readings: list[str] | None = None, machine: str = "id_machine", at: str = "timestamp"
) -> DataFrame:
    """Wide rows from records in arrival order: the last value of each field wins."""
    names = readings or KNOWN_READINGS
    fields = [F.max_by(n, F.when(F.col(n).isNotNull(), F.col(sequence))).alias(n) for n in names]
    return df.groupBy(at, machine).agg(*fields)



def records(df: DataFrame, columns: list[str], machine: str = "machine_id", at: str = "timestamp") -> DataFrame:
    """One JSON object per non-null reading: (timestamp, place, machine, record).

    ``place`` is the position of the field in ``columns``: records of a tick are listed
    field by field.
    """
    require_columns(df, [at, machine, *columns])
    objects = [
        F.struct(
            F.lit(i).alias("place"),
            F.when(
                F.col(c).isNotNull(),
                F.to_json(
                    F.struct(
                        F.col(at).cast("string").alias("timestamp"),
                        F.col(machine).alias("id_machine"),
                        F.col(c).alias(c),
                    )
                ),
            ).alias("record"),
        )
        for i, c in enumerate(columns)
    ]
    exploded = df.select(F.col(at).alias("timestamp"), F.col(machine).alias("machine"), F.inline(F.array(*objects)))
    return exploded.filter(F.col("record").isNotNull())


def tick_lines(
    iot: DataFrame,
    plc: DataFrame | None = None,
    sensors: list[str] | None = None,
    plc_readings: list[str] | None = None,
) -> DataFrame:
    """(timestamp, n_records, line): the JSON array of all records of one instant.

    IoT records come before PLC ones; an instant known to one source only still has a
    line. A line is one text by definition, so its size is that of one instant.
    """
    parts = records(iot, sensors or PUBLISHED_SENSORS).withColumn("source", F.lit(0))
    if plc is not None:
        parts = parts.unionByName(records(plc, plc_readings or PLC_READINGS).withColumn("source", F.lit(1)))
    listed = parts.groupBy("timestamp").agg(
        F.array_sort(F.collect_list(F.struct("source", "place", "machine", "record"))).alias("r")
    )
    return listed.select(
        "timestamp",
        F.size("r").cast("long").alias("n_records"),
        F.concat(F.lit("["), F.concat_ws(", ", F.col("r.record")), F.lit("]")).alias("line"),
    )


def messages_to_long(df: DataFrame, payload: str = "value") -> DataFrame:
    """Long rows from single-measure JSON texts.

    The sensor is the field that is neither the timestamp nor the machine; with several
    such fields the last one wins. Malformed texts, texts without a sensor and values
    that are not numbers give rows with a null ``sensor`` or ``value``, so that they can
    be counted before they are dropped.
    """
    fields = F.from_json(F.col(payload).cast("string"), T.MapType(T.StringType(), T.StringType()))
    measures = F.map_entries(F.map_filter(F.col("_m"), lambda k, _: ~k.isin("timestamp", "id_machine")))
    parsed = df.withColumn("_m", fields).withColumn("_s", F.try_element_at(measures, F.lit(-1)))
    return (
        parsed.withColumn("id_machine", F.coalesce(F.col("_m").getItem("id_machine"), F.lit("unknown")))
        .withColumn("sensor", F.col("_s.key"))
        .withColumn("value_number", F.expr("nanvl(try_cast(_s.value AS double), null)"))
        .withColumn("sensor_timestamp", F.expr("try_cast(_m['timestamp'] AS timestamp_ntz)"))
        .withColumn("accepted", F.col("sensor").isNotNull() & F.col("value_number").isNotNull())
        .drop("_m", "_s")
    )


def two_sided_rows(df: DataFrame, keep: list[str], pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Two rows per input row, one from each side.

    ``pairs`` maps an output column to its (side 1, side 2) columns; the second row
    swaps every pair.
    """
    views = [F.struct(*[F.col(cols[side]).alias(n) for n, cols in pairs.items()]) for side in (0, 1)]
    return df.select(*keep, F.inline(F.array(*views)))


def one_hot(df: DataFrame, dictionary: dict[str, list], drop_first: bool = True) -> DataFrame:
    """0/1 columns ``<column>_<value>`` for the values fixed at training.

    The first value is the reference and has no column; unknown and null values are all
    zeros, so train and test always have the same columns.
    """
    flags = {}
    for column, values in dictionary.items():
        for v in values[1:] if drop_first else values:
            flags[f"{column}_{v}"] = F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("int")
    return df.withColumns(flags).drop(*dictionary) if flags else df.drop(*dictionary)


#: Columns of one series table.
SERIES_WIDTH = 500


def series_per_machine(
    df: DataFrame,
    value: str,
    machines: list[str] | None = None,
    machine: str = "id_machine",
    at: str = "time",
    width: int | None = None,
) -> DataFrame:
    """One column per machine (named ones, by default all that occur) and one row per instant.

    A table can hold some thousand columns, the data any number of machines. With ``width`` the machines are
    numbered in order of name and dealt to blocks of that many: one row per instant and block (instants at which
    none of the block has a row are left out), with the column ``block``, the block's ``machines`` in order and
    their values ``s0``, ``s1``, ... in the same order. All blocks come from one pass; a null name gets no column.
    """
    if width is None:
        grouped = df.groupBy(at)
        columns = grouped.pivot(machine) if machines is None else grouped.pivot(machine, machines)
        return columns.agg(F.first(value, ignorenulls=True))
    if machines is None:
        numbers = number_labels(df, machine).select(machine, (F.col("id") - 1).alias("_n"))
    else:
        named = df.sparkSession.createDataFrame(list(enumerate(machines)), "_n long, _name string")
        numbers = named.select(F.col("_name").alias(machine), "_n")
    numbers = numbers.select(machine, F.floor(F.col("_n") / width).alias("block"), (F.col("_n") % width).cast("int").alias("_place"))
    names = numbers.groupBy("block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_place", machine))), lambda x: x[machine]).alias("machines")
    )
    placed = df.select(at, machine, F.col(value).alias("_value")).join(numbers, machine)
    values = placed.groupBy("block", at).pivot("_place", list(range(width))).agg(F.first("_value", ignorenulls=True))
    renamed = values.select(at, "block", *[F.col(str(i)).alias(f"s{i}") for i in range(width)])
    return renamed.join(names, "block").select(at, "block", "machines", *[f"s{i}" for i in range(width)])


def series_rows(blocks: DataFrame, value: str, machine: str = "id_machine", at: str = "time") -> DataFrame:
    """Known values of the blocks of ``series_per_machine`` as rows."""
    width = sum(c not in (at, "block", "machines") for c in blocks.columns)
    pairs = F.arrays_zip(F.col("machines").alias("machine"), F.array(*[f"s{i}" for i in range(width)]).alias("value"))
    cells = blocks.select(at, F.explode(F.filter(pairs, lambda x: x["value"].isNotNull())).alias("_cell"))
    return cells.select(at, F.col("_cell.machine").alias(machine), F.col("_cell.value").alias(value))
