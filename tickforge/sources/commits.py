"""Several tables that change together: all of a batch becomes visible, or nothing.

Every table of a batch is written to a folder of its own (``<root>/<table>/batch=<name>``), then one row per finished
item goes to the commit table in a single append. Readers keep the batches that the commit table names. A job that
dies before the commit leaves folders nobody reads; its work is done again under a new name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tickforge.sources.readers import read_or_empty
from tickforge.sources.sinks import EPOCH, pending_rows

COMMIT = T.StructType([T.StructField(c, T.StringType()) for c in ("batch", "kind", "item")])


def commits(spark: SparkSession, root: str, kind: str | None = None) -> DataFrame:
    """(batch, kind, item) of all finished items."""
    rows = read_or_empty(spark, f"{root}/commits", COMMIT)
    return rows if kind is None else rows.filter(F.col("kind") == kind)


def write_batch(spark: SparkSession, root: str, tables: dict[str, DataFrame], items: DataFrame, partition_by: dict[str, list[str]] | None = None) -> str:
    """Writes all ``tables``, then commits them with ``items`` (kind, item). Returns the batch's name."""
    batch = f"b{uuid.uuid4().hex}"
    for name, rows in tables.items():
        writer = rows.write.mode("errorifexists").option("compression", "zstd")
        by = (partition_by or {}).get(name)
        (writer.partitionBy(*by) if by else writer).parquet(f"{root}/{name}/batch={batch}")
    done = items.select(F.lit(batch).alias("batch"), F.col("kind").cast("string").alias("kind"), F.col("item").cast("string").alias("item"))
    done.coalesce(1).write.mode("append").parquet(f"{root}/commits")
    return batch


def read_committed(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """Rows of all committed batches, an empty frame before the first one.

    The join prunes the folders of other batches at run time; the commit table has some rows a batch.
    """
    stored = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    rows = read_or_empty(spark, f"{root}/{table}", stored)
    return rows.join(commits(spark, root).select("batch").distinct(), "batch", "left_semi").select(*schema.names)


def export_committed(
    spark: SparkSession, staging: DataFrame, root: str, now: str, at: str = "time", day_of: str = "sensor_timestamp", margin_seconds: float = 30
) -> str:
    """Pending rows by day and the new checkpoint in one commit; returns the checkpoint.

    Rows count as exported once the commit names their batch: a job killed at any point neither loses nor repeats one.
    """
    start = commits(spark, root, "checkpoint").agg(F.max("item")).first()[0] or EPOCH
    instant: Column = F.lit(now).cast("timestamp_ntz")
    rows = pending_rows(staging, F.lit(start).cast("timestamp_ntz"), instant, at, margin_seconds)
    cutoff = instant - F.make_dt_interval(secs=F.lit(float(margin_seconds)))
    # Six digits always, so that the greatest text is the latest instant; an older clock never moves it back.
    text = F.date_format(F.greatest(cutoff, F.lit(start).cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    items = spark.range(1).select(F.lit("checkpoint").alias("kind"), text.alias("item"))
    write_batch(spark, root, {"readings": rows.withColumn("date", F.to_date(day_of))}, items, {"readings": ["date"]})
    return commits(spark, root, "checkpoint").agg(F.max("item")).first()[0]
