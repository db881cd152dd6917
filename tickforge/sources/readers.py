"""Batch sources. Every read has an explicit schema; absent tables give typed empty frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from tickforge.functions.timeexpr import from_epoch_ns
from tickforge.schemas import ALERT_EPISODE, GAME_LOG, LONG_READING, MAINTENANCE_EPISODE, SILVER, TICK_RECORD


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or an empty frame of the same schema when it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def read_silver_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide silver rows; columns are found by header name and NaN becomes null."""
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in SILVER.fields}
    schema = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
    df = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
    numeric = [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numeric}) if numeric else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def read_readings(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Readings of several Parquet files or folders with ``timestamp`` as the event time."""
    if not paths:
        return empty(spark, LONG_READING).withColumnRenamed("sensor_timestamp", "timestamp")
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    if "sensor_timestamp" in df.columns:
        df = df.withColumnRenamed("sensor_timestamp", "timestamp")
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def read_tick_lines(spark: SparkSession, path: str) -> DataFrame:
    """Records of tick lines, one row each; blank lines are skipped."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", T.ArrayType(TICK_RECORD)).alias("r"))
    return parsed.select(F.inline("r"))


def read_tick_fields(spark: SparkSession, path: str) -> DataFrame:
    """(timestamp, id_machine, field, value): every field of every record of tick lines, known or not.

    Records are read as variants, so a new sensor needs no new schema. ``value`` is the field's JSON text without the quotes
    of a string; null fields and lines that are no JSON give no rows.
    """
    lines = spark.read.text(path).select(F.try_parse_json("value").alias("line")).filter(F.col("line").isNotNull())
    record = lines.lateralJoin(spark.tvf.variant_explode(F.col("line").outer())).select(F.col("value").alias("record"))
    fields = record.lateralJoin(spark.tvf.variant_explode(F.col("record").outer()))
    named = fields.select(
        F.try_variant_get("record", "$.timestamp", "string").cast("timestamp_ntz").alias("timestamp"),
        F.try_variant_get("record", "$.id_machine", "string").alias("id_machine"),
        F.col("key").alias("field"),
        F.col("value").cast("string").alias("value"),
    )
    return named.filter(~F.col("field").isin("timestamp", "id_machine") & F.col("value").isNotNull())


def read_game_log(spark: SparkSession, path: str) -> DataFrame:
    """Game log lines with the file they came from; blank lines are skipped by the reader."""
    df = spark.read.schema(GAME_LOG).json(path)
    return df.select("*", F.col("_metadata.file_path").alias("source_file")).filter(F.col("match_id").isNotNull())


def latest_file(df: DataFrame, file: str = "source_file") -> DataFrame:
    """Rows of the file whose base name sorts last."""
    name = F.regexp_extract(file, r"([^/]+)$", 1)
    newest = df.agg(F.max(name)).scalar()
    return df.filter(name == newest)


def unprocessed(runs: DataFrame, done: DataFrame, key: str = "run_id") -> DataFrame:
    """Runs without an output yet."""
    return runs.join(done.select(key).distinct(), key, "left_anti")


def alert_episodes(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, ALERT_EPISODE)


def maintenance_episodes(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, MAINTENANCE_EPISODE)


def episodes_from_points(points: DataFrame, start: str, end: str, id_column: str) -> DataFrame:
    """Episode rows from stored points whose end is an epoch-nanosecond field."""
    return points.withColumns(
        {
            start: F.col("time").cast("timestamp_ntz"),
            end: from_epoch_ns(F.col(end)),
            id_column: F.col(id_column).cast("long"),
        }
    ).drop("time")


def read_lookups(spark: SparkSession, folder: str, tables: list[str]) -> dict[str, DataFrame]:
    """Reference tables by name."""
    return {t: spark.read.parquet(f"{folder}/{t}") for t in tables}


def read_jdbc_lookup(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A reference table in a relational database (needs its driver on the classpath)."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()


def read_master_data(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Projected fields of a master-data dump, one JSON object per line."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return spark.read.schema(schema).json(path)


def time_bounded(df: DataFrame, at: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Rows between optional inclusive bounds; literal bounds reach the Parquet scan."""
    if start is not None:
        df = df.filter(F.col(at) >= start)
    if end is not None:
        df = df.filter(F.col(at) <= end)
    return df


def look_back(df: DataFrame, at: str, as_of: Column, days: float = 7) -> DataFrame:
    """Rows of the last ``days`` before ``as_of``, nothing later."""
    return time_bounded(df, at, as_of - F.make_dt_interval(secs=F.lit(days * 86400.0)), as_of)


def within_days_of_newest(df: DataFrame, at: str, days: float) -> DataFrame:
    """Rows at most ``days`` older than the newest row, whatever the clock says."""
    newest = df.agg(F.max(at)).scalar()
    return df.filter(F.col(at) >= newest - F.make_dt_interval(secs=F.lit(days * 86400.0)))


# Fixed value: the form of window file names.
WINDOW_NAME = r"^sensor_data_(\d{8}T\d{6}Z)_(\d{8}T\d{6}Z)\.parquet$"


def window_end(file_name: Column) -> Column:
    """End instant in a window file name; an error on any other name."""
    digits = F.regexp_extract(file_name, WINDOW_NAME, 2)
    problem = F.concat(F.lit("unexpected file name: "), file_name)
    return F.when(digits == "", F.raise_error(problem).cast("timestamp_ntz")).otherwise(
        F.to_timestamp(digits, "yyyyMMdd'T'HHmmss'Z'").cast("timestamp_ntz")
    )


def files_in_window(files: DataFrame, days: float, name: str = "file_name") -> DataFrame:
    """File names whose window ends at most ``days`` before the newest end."""
    ends = files.withColumn("_end", window_end(F.col(name)))
    newest = ends.agg(F.max("_end")).scalar()
    return ends.filter(F.col("_end") >= newest - F.make_dt_interval(secs=F.lit(days * 86400.0))).drop("_end")


def read_recent_days(spark: SparkSession, path: str, days: float, partition: str = "date") -> DataFrame:
    """Date-partitioned readings of the retro window.

    The newest partition is found from the partition listing; the cutoff is then a literal, so only
    the partitions of the window are scanned.
    """
    df = spark.read.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [x.getPath().getName() for x in listed if x.isDirectory()]
    found = [n.partition("=")[2] for n in names if n.startswith(f"{partition}=") and "__HIVE" not in n]
    if not found:
        return df
    return df.filter(F.col(partition) >= F.date_sub(F.lit(max(found)).cast("date"), int(days)))


def tables(spark: SparkSession) -> list[str]:
    return [t.name for t in spark.catalog.listTables()]


def last_rows(df: DataFrame, at: str, n: int = 5) -> DataFrame:
    """The ``n`` newest rows."""
    return df.orderBy(F.desc(at)).limit(n)
